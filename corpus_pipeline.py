"""From raw documents to packed sequences: five stages, each over all its predecessor kept.

A stage takes ``(spark, docs, sf_dir)``. All but the last return documents with the columns
they came with; the last returns the packed pieces. ``run`` writes what each stage returns
into the shared folder and reads it again for the next; only the pieces stay there.

The stages are operators of ``starling.llm``: without that subpackage this module cannot be
imported, and the entry file leaves it out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.llm import decontaminate, pii_bootstrap, ssq_packing, vp_simhash, zstd_quality
from starling.llm import text as T
from starling.llm.queries import vocabulary
from starling.session import scratch
from starling.sources.files import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier takes for good ones."""
    model = zstd_quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return docs.filter(zstd_quality.score_udf(model)(F.coalesce(F.col("text"), F.lit(""))) >= 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: shingles of four words, four differing bits at most."""
    return vp_simhash.one_of_each(docs, vp_simhash.Config(shingle=4, bits=4))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii_bootstrap.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return ssq_packing.pack(docs, vocabulary())


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("personal_data", personal_data), ("packing", packing),
]

# compression, SimHash links and tokenizers are beyond SQL: the tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    with scratch(spark) as keep:
        for _, stage in STAGES[:-1]:
            docs = keep(stage(spark, docs, sf_dir))
        return T.staged(STAGES[-1][1](spark, docs, sf_dir), "pieces")
