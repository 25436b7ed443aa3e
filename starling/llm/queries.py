"""One query per operator, over whole tables, and the pipeline; SQL counterparts where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.llm import (
    bpe_index, decontaminate, host_reputation, merkle_levels, pii_bootstrap, rule_ledger, ssq_packing, suffix_merge, toxicity_gru,
    turn_repair, viterbi_counts, vp_simhash, zstd_quality,
)
from starling.sources.files import read_table

# fixed values: the url rules of the stated contract
URL_RULES = tuple(
    host_reputation.Rule(action, text)
    for action, text in (
        ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
    )
)
# the page of a document names it in its url, like /en/1234.html
PAGE_NUMBER = r"/([0-9]{1,18})(?:\.html)?/?$"


def vocabulary() -> ssq_packing.Vocabulary:
    import public_tokenizers

    path = public_tokenizers.path
    return ssq_packing.Vocabulary(path("byte_bpe_50k.tiktoken"), path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``url, good``: a page is good as the document in its url is labelled; null without a label."""
    # one row per document: pages are not multiplied by repeated labels
    good = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("good"))
    number = F.regexp_extract(host_reputation.path_of(), PAGE_NUMBER, 1).try_cast("long")
    return pages.select("url", number.alias("number")).join(good, F.col("number") == F.col("doc_id"), "left").select("url", "good")


def op1_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    pages, labels = read_table(spark, folder, "pages").select("page_id", "url"), read_table(spark, folder, "labels")
    return host_reputation.judge(pages, outcomes(pages, labels), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "host_outcomes")


def op2_rule_ledger(spark: SparkSession, folder: str) -> DataFrame:
    entries = rule_ledger.ledger(rule_ledger.measure(read_table(spark, folder, "documents")))
    base = F.col("failures").bitwiseAND(F.lit(rule_ledger.mask_of("base")).cast("long")) != 0
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), rule_ledger.passes("v2").alias("kept"), "failures",
    )


def ledger_ablations(spark: SparkSession, folder: str) -> DataFrame:
    return rule_ledger.ablations(rule_ledger.ledger(rule_ledger.measure(read_table(spark, folder, "documents"))))


def op3_simhash_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op4_zstd_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    return zstd_quality.classify(documents, zstd_quality.fit(documents, read_table(spark, folder, "labels")))


def op5_toxicity_gru(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    return toxicity_gru.classify(documents, toxicity_gru.fit(documents, read_table(spark, folder, "labels")))


def op6_ssq_packing(spark: SparkSession, folder: str) -> DataFrame:
    return ssq_packing.pack(read_table(spark, folder, "documents"), vocabulary())


def op7_viterbi_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return viterbi_counts.count_tokens(read_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_pii_bootstrap(spark: SparkSession, folder: str) -> DataFrame:
    return pii_bootstrap.personal_data(read_table(spark, folder, "documents"))


def op9_vp_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return vp_simhash.near_duplicates(read_table(spark, folder, "documents"))


def op10_suffix_merge(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_merge.removed(read_table(spark, folder, "documents"), with_bytes=False)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the remainder of their key's checksum: dropped, emptied, cut, repeated or given to the user."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    harm = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), harm.alias("harm"))
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("harm") == 4, "user").otherwise(F.col("role"))
    times = F.array_repeat(F.lit(0), F.when(F.col("harm") == 3, 2).otherwise(1))
    rows = rows.filter("harm <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("times"))
    return rows.select("conv_id", "turn", "role", "text", F.explode("times")).drop("col")


def op11_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = read_table(spark, folder, "conversations")
    found = turn_repair.findings(damaged(conversations)).withColumnRenamed("conv_id", "found")
    every = conversations.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("found")), "left")
    counts = (F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


def op12_merkle_levels(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    rows = merkle_levels.manifest(documents, {"text": F.translate("text", "\n", "")}, tampered)
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_bpe_index(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = bpe_index.encode(read_table(spark, folder, "documents"), path, with_text=True)
    return rows.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_host_reputation, op2_rule_ledger, op3_simhash_decontamination, op4_zstd_quality, op5_toxicity_gru, op6_ssq_packing,
        op7_viterbi_counts, op8_pii_bootstrap, op9_vp_simhash, op10_suffix_merge, op11_turn_repair, op12_merkle_levels, op13_bpe_index,
        ledger_ablations, pipeline,
    )
}
