"""Quality from compression: which dictionary, of good or of bad text, packs a text smaller.

Two dictionaries are trained on a bounded sample of labelled texts (``Config``). Each text
is cut into blocks of ``block`` bytes, all of which are compressed with either dictionary.
The difference of the sizes per byte of text goes through a logistic curve, fitted on sampled
texts that the dictionaries have not seen and weighted by the shares of the labels. Empty and null texts have difference 0 and so
the score of an undecided text. Rows come out as they came in, repeated and null ids
included. Without labels of both kinds, every text scores 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.llm import text as T


@dataclass(frozen=True)
class Config:
    """``rows`` bounds the sampled labels per class, ``longest`` the length of a sampled text in characters."""

    rows: int = 1500
    longest: int = 20_000
    dictionary: int = 112 << 10
    block: int = 768
    level: int = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    shift: float
    config: Config


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learnt from: crc32 of the id as text leaves remainder 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def agreed(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, label`` of the learnable rows; ids with contradicting labels are left out."""
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("other"))
        .filter("label = other").select("doc_id", F.col("label").cast("int").alias("label"))
    )


def sample(documents: DataFrame, labels: DataFrame, label: str, rows: int, longest: int) -> pd.DataFrame:
    """At most ``rows`` learnable labelled texts per class, in the order of a hash of the id.

    Only the chosen ids travel to the documents, and one text of each comes back: the least one.
    """
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    # twice the rows, because some ids have no text of a usable length; the bound makes the broadcast safe
    known = agreed(labels, label)
    picked = [known.filter(F.col("label") == k).orderBy(*order).limit(2 * rows) for k in (0, 1)]
    texts = documents.select("doc_id", T.text_or_empty().alias("text")).filter(F.length("text").between(1, longest))
    chosen = texts.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")
    # one text per id before anything is collected: a repeated id brings one row to the driver, however many it has
    found = chosen.groupBy("doc_id", "label").agg(F.min("text").alias("text")).toPandas()
    found["rank"] = pd.util.hash_array(found["doc_id"].to_numpy(dtype="int64")) if len(found) else []
    found = found.sort_values(["rank", "text"])
    return found.groupby("label", group_keys=False).head(rows)[["text", "label"]].reset_index(drop=True)


def _dictionary(texts: list[bytes], size: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: the texts themselves serve as dictionary
        return b"\n".join(texts)[-size:] or b"\n" * 8


class Sizer:
    """Bytes saved by the good dictionary against the bad one, per byte of text."""

    def __init__(self, model: Model):
        self.block = model.config.block
        self.good, self.bad = (self._compressor(d, model.config) for d in (model.good, model.bad))

    @staticmethod
    def _compressor(dictionary: bytes, config: Config) -> zstandard.ZstdCompressor:
        # no frame fields: they are the same for every block
        bare = zstandard.ZstdCompressionParameters.from_level(
            config.level, dict_size=len(dictionary), source_size=config.block, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            write_content_size=0, write_dict_id=0, write_checksum=0,
        )
        return zstandard.ZstdCompressor(compression_params=bare, dict_data=zstandard.ZstdCompressionDict(dictionary))

    def __call__(self, data: bytes) -> float:
        saved = 0
        for i in range(0, len(data), self.block):
            part = data[i : i + self.block]
            saved += len(self.bad.compress(part)) - len(self.good.compress(part))
        return saved / (len(data) + 16)


def _logistic(x: np.ndarray, y: np.ndarray, share: float, ridge: float = 1e-5, steps: int = 60) -> tuple[float, float]:
    """Damped Newton steps for a slope and a shift; label 1 has the weight ``share``."""
    weights = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum()))
    scale = float(np.abs(x).mean()) or 1.0
    design = np.column_stack([x / scale, np.ones_like(x)])
    beta = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weights * (p - y)) + ridge * beta
        hessian = (design * (weights * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta - step * min(1.0, 2 / max(np.abs(step).max(), 1e-12))
    return float(beta[0] / scale), float(beta[1])


def fit(documents: DataFrame, labels: DataFrame, config: Config = Config()) -> Model:
    rows = sample(documents, labels, "quality", config.rows, config.longest)
    texts, y = [t.encode() for t in rows["text"]], rows["label"].to_numpy()
    if len(set(y.tolist())) < 2:
        return Model(b"\n" * 8, b"\n" * 8, 0.0, 0.0, config)
    share = agreed(labels, "quality").agg(F.avg("label")).first()[0]
    # alternate texts of each class train the dictionaries, the others the curve
    turn = rows.groupby("label").cumcount().to_numpy() % 2 == 0
    blocks = lambda k: [t[i : i + config.block] for t, label, use in zip(texts, y, turn) if label == k and use for i in range(0, len(t), config.block)]
    model = Model(_dictionary(blocks(1), config.dictionary), _dictionary(blocks(0), config.dictionary), 0.0, 0.0, config)
    rest = ~turn if len(set(y[~turn].tolist())) == 2 else turn
    size = Sizer(model)
    slope, shift = _logistic(np.array([size(t) for t, use in zip(texts, rest) if use]), y[rest].astype(float), share)
    return Model(model.good, model.bad, slope, shift, config)


def score_udf(model: Model):
    """A column function: text to the calibrated chance of label 1."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        size = Sizer(model)
        for texts in batches:
            x = np.array([size((t or "").encode()) for t in texts], dtype=float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(model.slope * x + model.shift, -30, 30))))

    return score


def classify(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    scored = documents.select("doc_id", held_out().alias("held_out"), score_udf(model)(T.text_or_empty()).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
