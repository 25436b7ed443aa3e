"""Byte-pair encoding by an index from pairs to all their positions, and decoding.

The distinct words of a run of texts lie side by side in one symbol array with links to
their neighbours. Every pair of neighbours that the merge list knows is filed under its rank
with all its positions; a heap holds the active ranks. The least rank is applied to all its
positions at once, the pairs that this makes or breaks are filed anew, and so on until no
rank is active. Words are independent, so this equals merging word by word as long as no
merge makes a pair of lower rank; where a merge list has such merges (``early``), only the
first position in each word is applied before the heap is asked again.

Vocabularies are files of the ``tokenizers`` library: BPE with an end-of-word suffix, byte
alphabet, a splitting pattern, no decoder (tokens are joined by blanks). The splitting is
done here where this library's and that one's tables agree on every character of a text,
and by that library's own splitter otherwise. Special tokens found in a text keep their ids.

Null and empty texts give no ids and decode to the empty string. Repeated rows and null ids
stay, an empty table gives an empty result, other columns are ignored. A very long text is a
run of its own; a very long word is one more run of symbols.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from starling.llm import text as T

WIDTH = 1 << 20  # above every symbol id: a pair is first * WIDTH + second
KNOWN_BYTES = 1 << 22  # of words and ids that a worker remembers; a cache, emptied when full


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Symbols, merge ranks and splitting rules of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model = parts["model"]
        self.pattern, self.library, self.path = None, None, path
        for step in (parts["pre_tokenizer"] or {}).get("pretokenizers", ()):
            if step["type"] == "Split":
                if not step["invert"] or step["behavior"] != "Removed":
                    raise ValueError("only patterns that name what is kept are supported")
                self.pattern = regex.compile(step["pattern"]["Regex"])
        if model["type"] != "BPE" or self.pattern is None or parts["decoder"] is not None:
            raise ValueError(f"{path} is not a vocabulary of this kind")
        ids, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in parts["added_tokens"]):
            raise ValueError("special tokens with rules of their own are not supported")
        longest = sorted(self.special, key=len, reverse=True)
        if any(len(self.pattern.findall(name)) == 1 for name in self.special):
            raise ValueError("special tokens that look like words are not supported")
        self.special_pattern = re.compile("|".join(map(re.escape, longest))) if longest else None
        letters = byte_letters()
        self.inner = np.array([ids[c] for c in letters], dtype=np.int32)
        self.last = np.array([ids[c + suffix] for c in letters], dtype=np.int32)
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.first = np.array([ids[a] for a, _ in merges], dtype=np.int64)
        self.second = np.array([ids[b] for _, b in merges], dtype=np.int64)
        self.made = np.array([ids[a + b] for a, b in merges], dtype=np.int64)
        keys = self.first * WIDTH + self.second
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        least = np.full(max(ids.values()) + 1, len(merges), dtype=np.int64)
        np.minimum.at(least, self.first, np.arange(len(merges)))
        np.minimum.at(least, self.second, np.arange(len(merges)))
        self.early = frozenset(np.flatnonzero(least[self.made] < np.arange(len(merges))).tolist())
        self.names = [""] * (max([*ids.values(), *self.special.values()]) + 1)
        for name, i in [*ids.items(), *self.special.items()]:
            self.names[i] = name
        self.agreed: dict[str, bool] = {}
        self.forget()

    def forget(self) -> None:
        """Empty the memory of encoded words; special tokens stand in it by their names."""
        self.known = {name: int(i).to_bytes(4, "little") for name, i in self.special.items()}
        self.known_bytes = 0

    def ranks(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the merge list has none."""
        if not len(self.keys):
            return np.full(len(first), -1)
        wanted = first.astype(np.int64) * WIDTH + second
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.order[at], -1)

    # splitting

    def _rules(self):
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return self.library

    def _agrees(self, c: str) -> bool:
        """True if both libraries class, lower and normalise a character alike, in any text."""
        rules = self._rules()
        split = lambda t: len(rules.pre_tokenizer.pre_tokenize_str(t))
        settled = unicodedata.ucd_3_2_0.category(c) != "Cn" or unicodedata.category(c) == "So"
        lowered = rules.normalizer.normalize_str(c) if rules.normalizer else c
        return (
            settled and c != "Σ" and split(c + c) == len(self.pattern.findall(c + c))
            and split(f"a{c}a") == len(self.pattern.findall(f"a{c}a"))
            and (split(c) == 0 or lowered == unicodedata.normalize("NFC", c).lower())
        )

    def words(self, text: str) -> list[str]:
        """Words of a text without special tokens; their characters are those the byte alphabet encodes."""
        for c in set(text).difference(self.agreed):
            self.agreed[c] = self._agrees(c)
        if all(map(self.agreed.__getitem__, set(text))):
            return self.pattern.findall(unicodedata.normalize("NFC", text).lower())
        rules = self._rules()
        plain = rules.normalizer.normalize_str(text) if rules.normalizer else text
        return [plain[a:b] for _, (a, b) in rules.pre_tokenizer.pre_tokenize_str(plain)]

    def pieces(self, text: str) -> list[str]:
        """Words and special tokens, in order; no word is like a special token, which has marks and letters."""
        if self.special_pattern is None or not self.special_pattern.search(text):
            return self.words(text)
        out, end = [], 0
        for match in self.special_pattern.finditer(text):
            out += [*self.words(text[end : match.start()]), match.group()]
            end = match.end()
        return out + self.words(text[end:])


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class PairIndex:
    """Words as linked symbols, with the positions of every pair that has a rank."""

    def __init__(self, words: list[bytes], rules: Vocabulary):
        self.rules = rules
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        self.starts = ends - sizes
        self.symbols = rules.inner[data]
        self.symbols[ends - 1] = rules.last[data[ends - 1]]
        self.after = np.arange(1, len(data) + 1, dtype=np.int32)
        self.after[ends - 1] = -1
        self.before = np.arange(-1, len(data) - 1, dtype=np.int32)
        self.before[self.starts] = -1
        self.positions: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self._file(np.flatnonzero(self.after >= 0))

    def _file(self, left: np.ndarray) -> None:
        """File the pairs that begin at ``left`` under their ranks."""
        ranks = self.rules.ranks(self.symbols[left], self.symbols[self.after[left]])
        if len(left) < 16:
            for rank, at in zip(ranks.tolist(), left.tolist()):
                if rank >= 0:
                    self._add(rank, at)
            return
        order = np.argsort(ranks, kind="stable")
        order = order[np.searchsorted(ranks[order], 0) :]
        if not len(order):
            return
        ranks, left = ranks[order], left[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for rank, at in zip(ranks[np.concatenate(([0], cuts))].tolist(), np.split(left, cuts)):
            self._add(rank, at)

    def _add(self, rank: int, at: np.ndarray | int) -> None:
        if rank not in self.positions:
            self.positions[rank] = []
            heapq.heappush(self.active, rank)
        self.positions[rank].append(at)

    def _standing(self, rank: int) -> np.ndarray:
        """Positions filed under a rank where the pair still stands; of overlapping ones the left."""
        filed = self.positions.pop(rank)
        left = np.unique(np.hstack(filed)) if len(filed) > 1 else np.atleast_1d(filed[0])
        right = self.after[left]
        first, second = self.rules.first[rank], self.rules.second[rank]
        left = left[(self.symbols[left] == first) & (right >= 0) & (self.symbols[right] == second)]
        if rank in self.rules.early and len(left) > 1:
            word = np.searchsorted(self.starts, left, side="right")
            one = np.concatenate(([True], word[1:] != word[:-1]))
            if not one.all():
                self._add(rank, left[~one])
            return left[one]
        if first == second and len(left) > 1:
            chosen, taken = [], -1
            for at, following in zip(left.tolist(), self.after[left].tolist()):
                if at != taken:
                    chosen.append(at)
                    taken = following
            return np.array(chosen, dtype=np.int64)
        return left

    def merge(self) -> None:
        symbols, after, before = self.symbols, self.after, self.before
        while self.active:
            rank = heapq.heappop(self.active)
            left = self._standing(rank)
            if not len(left):
                continue
            right = after[left]
            following = after[right]
            symbols[left] = self.rules.made[rank]
            symbols[right] = -1
            after[left] = following
            inner = following >= 0
            before[following[inner]] = left[inner]
            previous = before[left]
            self._file(np.concatenate((left[inner], previous[previous >= 0])))

    def ids(self) -> list[bytes]:
        """Little-endian 32-bit ids of each word."""
        alive = self.symbols >= 0
        counts = np.add.reduceat(alive.astype(np.int64), self.starts)
        ends = np.cumsum(counts) * 4
        data = self.symbols[alive].astype("<u4").tobytes()
        return [data[a:b] for a, b in zip((ends - counts * 4).tolist(), ends.tolist())]


def word_ids(words: list[str], rules: Vocabulary) -> dict[str, bytes]:
    """Ids of distinct, non-empty words."""
    if not words:
        return {}
    index = PairIndex([w.encode() for w in words], rules)
    index.merge()
    return dict(zip(words, index.ids()))


def encode_run(texts: list[str], rules: Vocabulary) -> list[bytes]:
    """Ids of each text; all words that are not yet known go through one pair index."""
    pieces = [rules.pieces(t) for t in texts]
    known = rules.known
    found = word_ids(sorted({w for p in pieces for w in p}.difference(known)), rules)
    known.update(found)
    ids = [b"".join(map(known.__getitem__, p)) for p in pieces]
    rules.known_bytes += sum(len(w) + len(i) for w, i in found.items())
    if rules.known_bytes > KNOWN_BYTES:
        rules.forget()
    return ids


def _decoded(ids: bytes, names: list[str]) -> str:
    return " ".join([names[i] for i in np.frombuffer(ids, "<u4").tolist() if i < len(names) and names[i]])


def encode(docs: DataFrame, path: str, with_text: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids`` for every row; ids are little-endian unsigned 32-bit integers.

    ``with_text`` adds ``decoded``, as ``decode`` would, in the same pass.
    """
    source = docs.select("doc_id", T.text_or_empty().alias("text"))
    key = source.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "ids", "decoded"][: 4 if with_text else 3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = vocabulary(path)
        for part in (p for b in batches for p in T.sliced(b, 1)):
            ids = encode_run([t.decode("utf-8", "replace") for t in T.byte_texts(part.column(1))], rules)
            columns = [part.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
            if with_text:
                columns.append(pa.array([_decoded(i, rules.names) for i in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(run, f"doc_id {key}, n_tokens long, ids binary" + ", decoded string" * with_text)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` as given, and ``decoded``: the names of the ids, joined by blanks.

    Null ids decode to the empty string; an id that the vocabulary does not have is left out.
    """
    source = encoded.select("doc_id", "n_tokens", "ids")
    key = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = vocabulary(path).names
        for part in (p for b in batches for p in T.sliced(b, 2)):
            texts = pa.array([_decoded(i or b"", names) for i in part.column(2).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns, texts], ["doc_id", "n_tokens", "ids", "decoded"])

    return source.mapInArrow(run, f"doc_id {key}, n_tokens long, ids binary, decoded string")
