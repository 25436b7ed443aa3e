"""Toxicity from a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as a hashed word vector and the mean of its hashed character n-gram vectors.
Overlapping windows of words run through one recurrent layer in each direction; attention
pools the states of a window into one value. Every window of a text is scored, whatever its
length, and the text's score is the highest of them.

Training (on the driver, bounded by ``Config.rows`` and ``Config.longest``) alternates
between finding each text's highest window and fitting those. Scoring runs in the tasks on
whole Arrow batches. Texts without a word, null ones included, score 0. One row out per row
in, whatever the ids; without labels of both kinds every score is 0. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm import text as T
from starling.llm.zstd_quality import held_out, sample

GRAMS = (3, 4, 5)
# words are runs of ASCII letters and digits and of all bytes beyond ASCII
SEPARATOR = np.ones(256, dtype=bool)
SEPARATOR[np.r_[48:58, 65:91, 97:123, 128:256]] = False
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[SEPARATOR] = 32


@dataclass(frozen=True)
class Config:
    rows: int = 1200  # labelled texts per class
    longest: int = 12_000  # characters of a training text
    window: int = 32
    stride: int = 24
    hidden: int = 8
    word_size: int = 8
    char_size: int = 8
    word_buckets: int = 1 << 14
    char_buckets: int = 1 << 16
    updates: int = 450  # least number of updates, in whole passes
    batch: int = 64
    rate: float = 0.02
    texts_per_feature: int = 3  # training texts that a word or n-gram must occur in to have a vector
    seed: int = 11
    at_once: int = 3000  # windows per scoring pass


@dataclass
class Words:
    """Distinct words of some texts, and the windows over them."""

    word: np.ndarray  # bucket per distinct word
    grams: np.ndarray  # buckets of all n-grams, word after word
    counts: np.ndarray  # n-grams per distinct word
    tokens: np.ndarray  # distinct word per token
    first: np.ndarray  # first token per window
    size: np.ndarray  # tokens per window
    doc: np.ndarray  # text per window


def read(texts: list[bytes], config: Config) -> Words:
    buffer = T.Buffer(texts, SEPARATOR)
    data = FOLD[buffer.bytes]
    # a blank in front, so that the first word has a border as well
    data = np.concatenate((np.array([32], np.uint8), data))
    starts, ends = buffer.starts + 1, buffer.ends + 1
    rolling = T.RollingHash(data)
    hashes, index, tokens = np.unique(rolling.of(starts, ends), return_index=True, return_inverse=True)
    starts, ends = starts[index], ends[index]
    parts, owners = [], []
    for n in GRAMS:
        number = np.maximum(ends - starts + 3 - n, 0)
        owner = np.repeat(np.arange(len(starts), dtype=np.int32), number)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number) + starts[owner] - 1
        parts.append(((rolling.of(at, at + n) >> np.uint64(7)) % np.uint64(config.char_buckets)).astype(np.int32))
        owners.append(owner)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    grams = np.concatenate(parts)

    lengths = np.bincount(buffer.docs, minlength=buffer.count)
    number = np.where(lengths > 0, np.maximum(np.ceil((lengths - config.window) / config.stride), 0) + 1, 0).astype(np.int64)
    doc = np.repeat(np.arange(buffer.count), number)
    within = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    offset = np.cumsum(lengths) - lengths
    return Words(
        ((hashes >> np.uint64(11)) % np.uint64(config.word_buckets)).astype(np.int64), grams[order],
        np.bincount(owner, minlength=len(starts)), tokens.reshape(-1), offset[doc] + within * config.stride,
        np.minimum(lengths[doc] - within * config.stride, config.window), doc,
    )


def read_in_parts(texts: list[bytes], config: Config) -> Words:
    """The same for many texts, read part by part; a word is distinct within its part."""
    parts = [(i, read(texts[i:j], config)) for i, j in T.slices(texts, 512 << 10)]
    joined = lambda field: [getattr(w, field) for _, w in parts]
    before = lambda field: np.cumsum([0, *map(len, joined(field))])[:-1]
    word, token = before("word"), before("tokens")
    return Words(
        np.concatenate(joined("word")), np.concatenate(joined("grams")), np.concatenate(joined("counts")),
        np.concatenate([w.tokens + n for (_, w), n in zip(parts, word)]), np.concatenate([w.first + n for (_, w), n in zip(parts, token)]),
        np.concatenate(joined("size")), np.concatenate([w.doc + i for i, w in parts]),
    )


def _gate(x: np.ndarray) -> np.ndarray:
    return np.clip(0.2 * x + 0.5, 0, 1)


@dataclass
class Network:
    config: Config
    w: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.w:
            return
        c, draw = self.config, np.random.default_rng(self.config.seed)
        normal = lambda scale, *shape: (draw.standard_normal(shape) * scale).astype(np.float32)
        size, h = c.word_size + c.char_size, c.hidden
        self.w = {
            "word": normal(0.1, c.word_buckets, c.word_size), "char": normal(0.1, c.char_buckets, c.char_size),
            "v": normal(0.5, h), "out": normal(0.5, 2 * h), "bias": np.zeros(1, np.float32),
            "attend": normal(0.3, 2 * h, h), "attend_bias": np.zeros(h, np.float32),
        }
        for d in "fb":
            self.w |= {f"in_{d}": normal(size**-0.5, size, 3 * h), f"add_{d}": np.zeros(3 * h, np.float32), f"state_{d}": normal(h**-0.5, h, 3 * h)}

    def vectors(self, words: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Input vector per distinct word; every word has an n-gram of three."""
        sums = np.add.reduceat(self.w["char"][grams], np.cumsum(counts) - counts, axis=0) if len(counts) else self.w["char"][:0]
        return np.concatenate((self.w["word"][words], sums / counts[:, None]), axis=1).astype(np.float32)

    def run(self, ids: np.ndarray, mask: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, dict]:
        """Logit per window for word numbers ``ids`` (time, window); and what backpropagation needs."""
        time, n = ids.shape
        h = self.config.hidden
        states = np.empty((time, n, 2 * h), np.float32)
        kept: dict = {}
        for d, steps, at in (("f", range(time), 0), ("b", range(time - 1, -1, -1), h)):
            inputs = x @ self.w[f"in_{d}"] + self.w[f"add_{d}"]
            recur, state, trail = self.w[f"state_{d}"], np.zeros((n, h), np.float32), []
            for t in steps:
                a, b = inputs[ids[t]], state @ recur
                gates = _gate(a[:, : 2 * h] + b[:, : 2 * h])
                z, r = gates[:, :h], gates[:, h:]
                new = np.tanh(a[:, 2 * h :] + r * b[:, 2 * h :])
                trail.append((state, z, r, new, b[:, 2 * h :]))
                state = np.where(mask[t][:, None], new + z * (state - new), state)
                states[t, :, at : at + h] = state
            kept[d] = trail if self.keep else None
        u = np.tanh(states @ self.w["attend"] + self.w["attend_bias"])
        energy = np.where(mask, u @ self.w["v"], -1e9)
        energy = np.exp(energy - energy.max(axis=0))
        weight = energy * mask
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        kept |= {"states": states, "u": u, "weight": weight, "pooled": pooled}
        return pooled @ self.w["out"] + self.w["bias"][0], kept

    keep = False

    def gradients(self, ids: np.ndarray, mask: np.ndarray, x: np.ndarray, kept: dict, dlogit: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        w, h = self.w, self.config.hidden
        states, u, weight = kept["states"], kept["u"], kept["weight"]
        g = {"out": kept["pooled"].T @ dlogit, "bias": np.array([dlogit.sum()], np.float32)}
        dpooled = dlogit[:, None] * w["out"]
        dstates = weight[:, :, None] * dpooled
        dweight = np.einsum("tnh,nh->tn", states, dpooled)
        denergy = weight * (dweight - (weight * dweight).sum(axis=0))
        g["v"] = np.einsum("tn,tnh->h", denergy, u)
        du = denergy[:, :, None] * w["v"] * (1 - u * u)
        g["attend"] = np.einsum("tnh,tnk->hk", states, du)
        g["attend_bias"] = du.sum(axis=(0, 1))
        dstates = dstates + du @ w["attend"].T
        dx = np.zeros_like(x)
        for d, steps, at in (("f", range(len(ids)), 0), ("b", range(len(ids) - 1, -1, -1), h)):
            recur, gin = w[f"state_{d}"], np.zeros((len(x), 3 * h), np.float32)
            drecur, dh = np.zeros_like(recur), np.zeros((ids.shape[1], h), np.float32)
            for t, (before, z, r, new, q) in reversed(list(zip(steps, kept[d]))):
                dh = dh + dstates[t, :, at : at + h]
                live = mask[t][:, None]
                down = np.where(live, dh, 0)
                dnew = down * (1 - z) * (1 - new * new)
                dz = down * (before - new) * 0.2 * ((z > 0) & (z < 1))
                dr = dnew * q * 0.2 * ((r > 0) & (r < 1))
                back = np.concatenate((dz, dr, dnew * r), axis=1)
                drecur += before.T @ back
                np.add.at(gin, ids[t], np.concatenate((dz, dr, dnew), axis=1))
                dh = np.where(live, down * z, dh) + back @ recur.T
            g |= {f"state_{d}": drecur, f"in_{d}": x.T @ gin, f"add_{d}": gin.sum(axis=0)}
            dx += gin @ w[f"in_{d}"].T
        return g, dx

    def scores(self, words: Words, count: int) -> np.ndarray:
        """Highest window per text; 0 without words."""
        return _highest(self.window_scores(words), words.doc, count)

    def window_scores(self, words: Words) -> np.ndarray:
        if not len(words.first):
            return np.zeros(0)
        x = self.vectors(words.word, words.grams, words.counts)
        x = np.concatenate((x, np.zeros((1, x.shape[1]), np.float32)))
        parts = np.array_split(np.arange(len(words.first)), -(-len(words.first) // self.config.at_once))
        logit = np.concatenate([self.run(*_laid_out(words, p, self.config, len(x) - 1), x)[0] for p in parts])
        return 1 / (1 + np.exp(-logit))


def _highest(scores: np.ndarray, docs: np.ndarray, count: int) -> np.ndarray:
    out = np.zeros(count)
    np.maximum.at(out, docs, scores)
    return out


def _laid_out(words: Words, chosen: np.ndarray, config: Config, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and mask of some windows, time first."""
    steps = np.arange(config.window)[:, None]
    mask = steps < words.size[chosen]
    at = np.minimum(words.first[chosen] + steps, len(words.tokens) - 1)
    return np.where(mask, words.tokens[at], pad), mask


def _spread(words: Words, labels: np.ndarray, config: Config) -> dict[str, np.ndarray]:
    """Number of clean and of toxic texts that each word bucket and each n-gram bucket occurs in."""
    out = {"word": np.zeros((2, config.word_buckets), np.int32), "char": np.zeros((2, config.char_buckets), np.int32)}
    ends = np.cumsum(words.counts)
    borders = np.flatnonzero(np.diff(words.doc, prepend=-1, append=-1))
    for a, b in zip(borders, borders[1:]):
        used, label = np.unique(words.tokens[words.first[a] : words.first[b - 1] + words.size[b - 1]]), labels[words.doc[a]]
        out["word"][label, np.unique(words.word[used])] += 1
        out["char"][label, np.unique(words.grams[_ranges(ends[used] - words.counts[used], words.counts[used])])] += 1
    return out


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Numbers of consecutive ranges, one range after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)


def train(texts: list[bytes], labels: np.ndarray, config: Config) -> Network:
    """Alternate between each text's highest window and a pass over those.

    The first number of a vector is the log-odds of the label where the word or n-gram occurs; it
    stays, and the others are learnt beside it. It also ranks the windows of the first round.
    """
    network, draw = Network(config), np.random.default_rng(config.seed)
    words = read_in_parts(texts, config)
    y = labels[words.doc].astype(np.float32)
    ends = np.cumsum(words.counts)
    # what few texts have would be learnt by heart: it has no vector, nor has what none of them has
    rare = {}
    for name, n in _spread(words, labels, config).items():
        rare[name] = n.sum(axis=0) < config.texts_per_feature
        share = (n + 0.5) / (np.bincount(labels, minlength=2)[:, None] + 1)
        network.w[name][:, 0] = np.log(share[1] / share[0]) / 2
        network.w[name][rare[name]] = 0
    memory = {k: np.full_like(v, 1e-6) for k, v in network.w.items()}
    first = network.vectors(words.word, words.grams, words.counts)[:, [0, config.word_size]].sum(axis=1)
    odds = np.maximum.reduceat(first[words.tokens[_ranges(words.first, words.size)]], np.cumsum(words.size) - words.size)
    epoch = done = 0
    while done < config.updates:
        order = draw.permutation(len(y))
        rated = network.window_scores(words) if epoch else odds
        order = order[np.argsort(-rated[order], kind="stable")]
        # the first windows of each text in that order: a few by chance at first, later the highest
        rank = np.zeros(len(y), dtype=np.int64)
        by_doc = np.argsort(words.doc[order], kind="stable")
        docs = words.doc[order][by_doc]
        rank[order[by_doc]] = np.arange(len(docs)) - np.searchsorted(docs, docs)
        chosen = draw.permutation(np.flatnonzero(rank < np.where(y == 1, 1, 2)))
        epoch += 1
        for i in range(0, len(chosen), config.batch):
            done += 1
            part = chosen[i : i + config.batch]
            ids, mask = _laid_out(words, part, config, -1)
            used, local = np.unique(ids[mask], return_inverse=True)
            placed = np.full(ids.shape, len(used))
            placed[mask] = local
            counts = words.counts[used]
            grams = words.grams[_ranges(ends[used] - counts, counts)]
            x = network.vectors(words.word[used], grams, counts)
            x = np.concatenate((x, np.zeros((1, x.shape[1]), np.float32)))
            network.keep = True
            logit, kept = network.run(placed, mask, x)
            network.keep = False
            target = y[part]
            balance = np.where(target == 1, 0.5 / max(1, target.sum()), 0.5 / max(1, (1 - target).sum()))
            dlogit = ((1 / (1 + np.exp(-logit)) - target) * balance).astype(np.float32)
            g, dx = network.gradients(placed, mask, x, kept, dlogit)
            size = config.word_size
            owner = np.repeat(np.arange(len(used)), counts)
            for name, rows, change in (("word", words.word[used], dx[:-1, :size]), ("char", grams, (dx[:-1, size:] / counts[:, None])[owner])):
                unique, place = np.unique(rows, return_inverse=True)
                total = np.zeros((len(unique), change.shape[1]), np.float32)
                np.add.at(total, place, change)
                total[rare[name][unique]] = 0
                total[:, 0] = 0
                memory[name][unique] += total * total
                network.w[name][unique] -= 3 * config.rate * total / np.sqrt(memory[name][unique])
            for name, change in g.items():
                memory[name] = 0.95 * memory[name] + 0.05 * change * change
                network.w[name] -= (config.rate * change / (np.sqrt(memory[name]) + 1e-4)).astype(np.float32)
    return network


def fit(documents: DataFrame, labels: DataFrame, config: Config = Config()) -> Network | None:
    """A network from a bounded sample of learnable labelled texts; none without both labels."""
    rows = sample(documents, labels, "toxic", config.rows, config.longest)
    y = rows["label"].to_numpy()
    if len(set(y.tolist())) < 2:
        return None
    return train([t.encode() for t in rows["text"]], y, config)


def classify(documents: DataFrame, network: Network | None, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, scores = T.byte_texts(batch.column(2)), []
            for i, j in T.slices(texts, 384 << 10):
                part = texts[i:j]
                scores.append(network.scores(read(part, network.config), len(part)) if network else np.zeros(len(part)))
            score = pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), score], names=["doc_id", "held_out", "score"])

    source = documents.select("doc_id", held_out().alias("held_out"), T.text_or_empty().alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    scored = source.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
