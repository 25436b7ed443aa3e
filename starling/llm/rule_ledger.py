"""Quality rules as a bitmask ledger.

``measure`` reads every text once; equal lines, words and windows are equal by their bytes. ``ledger`` evaluates every rule once and stores a bit
per failed rule beside the measurements. Policies are versioned sets of bits: changing
one needs no second look at the texts, and ablations are counts over distinct masks.

Null text counts as empty: all measurements are 0, and the rule on few words fails. Null
and repeated ids, and repeated rows, stay as they are: one row out per row in. An empty
table gives an empty ledger. Other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.llm import text as T

WINDOW = 8  # a power of two
MEASURES = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_exclaim n_bars".split()

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Rule:
    """Fails where ``failed`` is true; its bit never changes once given out."""

    name: str
    bit: int
    failed: str


RULES = (
    Rule("few_words", 0, "n_words < 20"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > 3 * n_words"),
    Rule("shouting", 3, "10 * n_exclaim > 5 * n_words"),
    Rule("repeated_lines", 4, "n_lines > 3 and 10 * n_dup_lines > 3 * n_lines"),
    Rule("short_words", 5, "word_chars < 2 * n_words"),
    Rule("long_words", 6, "word_chars > 15 * n_words"),
)

# versioned policies: the rules that reject
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "v2": ("few_words", "repeated_words", "symbols", "shouting", "repeated_lines", "short_words", "long_words"),
}


def measured(texts: list[bytes]) -> dict[str, np.ndarray]:
    buffer = T.Buffer(texts)
    data, count = buffer.bytes, buffer.count
    inside = ~buffer.space
    rolling = T.RollingHash(data)

    line_ends = np.flatnonzero(data == 10)
    line_starts = np.concatenate(([0], line_ends[:-1] + 1))
    marks = np.concatenate(([0], np.cumsum(inside)))
    with_word = marks[line_ends] > marks[line_starts]
    line_starts, line_ends = line_starts[with_word], line_ends[with_word]
    line_docs = np.searchsorted(buffer.doc_starts, line_starts, side="right") - 1
    lines = T.equal_ranges(data, rolling, line_starts, line_ends)
    again = T.later_copies(lines * count + line_docs)

    words = T.equal_ranges(data, rolling, buffer.starts, buffer.ends)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    spans = len(words) - WINDOW + 1
    if spans > 0:
        # numbers of runs of 2, 4, 8 words: two runs have one number if and only if their halves have
        runs, size = words, 1
        while size < WINDOW:
            runs = T.numbered(runs[:-size] * len(words) + runs[size:])
            size *= 2
        whole = np.flatnonzero(buffer.docs[:spans] == buffer.docs[WINDOW - 1 :])
        found = whole[T.repeats(runs[whole] * count + buffer.docs[whole])]
        covered[found] += 1
        covered[found + WINDOW] -= 1
    in_window = np.cumsum(covered)[:-1] > 0

    per_doc = lambda docs: np.bincount(docs, minlength=count).astype(np.int64)
    return {
        "n_words": per_doc(buffer.docs),
        "word_chars": buffer.per_doc(inside & ((data & 0xC0) != 0x80)),
        "n_symbols": buffer.per_doc(_SYMBOL[data]),
        "n_dup_lines": per_doc(line_docs[again]),
        "n_repeat_words": per_doc(buffer.docs[in_window]),
        "n_lines": per_doc(line_docs),
        "n_exclaim": buffer.per_doc(data == 33),
        "n_bars": buffer.per_doc(data == 124),
    }


def measure(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the measurements of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), T.byte_texts(batch.column(1))
            for i, j in T.slices(texts):
                found = measured(texts[i:j])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), *(pa.array(found[m], pa.int64()) for m in MEASURES)], names=["doc_id", *MEASURES]
                )

    source = documents.select("doc_id", T.text_or_empty().alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))


def ledger(measurements: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measurements with ``failures``: bit i is set where the rule of bit i fails."""
    bits = [F.when(F.expr(r.failed), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in rules]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    return measurements.withColumn("failures", mask)


def mask_of(policy: str, rules: tuple[Rule, ...] = RULES) -> int:
    return sum(1 << r.bit for r in rules if r.name in POLICIES[policy])


def passes(policy: str, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(F.lit(mask_of(policy)).cast("long")) == 0


def ablations(entries: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per policy and rule: texts that fail it, that fail it alone, and that pass without it.

    Works on one row per distinct mask, of which there are at most 2**rules.
    """
    masks = entries.groupBy("failures").agg(F.count("*").alias("n"))
    rows = [
        (policy, r.name, mask_of(policy, rules), 1 << r.bit) for policy in POLICIES for r in rules if r.name in POLICIES[policy]
    ]
    wanted = entries.sparkSession.createDataFrame(rows, "policy string, rule string, policy_mask long, bit long")
    hit = F.col("failures").bitwiseAND(F.col("policy_mask"))
    total = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).cast("long")
    # at most 2**rules masks against a stated list of rules
    return masks.crossJoin(F.broadcast(wanted)).groupBy("policy", "rule").agg(
        total(F.col("failures").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(hit == F.col("bit")).alias("n_only"),
        total(hit.bitwiseAND(F.bitwise_not("bit")) == 0).alias("n_kept_without"),
        total(hit == 0).alias("n_kept"),
    )
