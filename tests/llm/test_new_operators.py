"""Conversation repair, Merkle manifest and byte-pair encoding: brute force, odd input, hot groups."""

from __future__ import annotations

import hashlib
import itertools
import json
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starling.llm import bpe_index, merkle_levels, places, turn_repair
from starling.llm.queries import QUERIES, damaged
from starling.session import scratch

FOLDER = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\x0c\r"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


# conversation repair


def cheapest(codes, entry=0, goals=(0, 3), closing=True):
    """All states with their best (cost, audit), row by row, without bounds."""
    best = {entry: (0, "")}

    def offer(table, state, way):
        if state not in table or way < table[state]:
            table[state] = way

    def inserted(table):
        out = dict(table)
        for _ in range(3):
            for s, (c, a) in list(out.items()):
                offer(out, turn_repair.NEXT_STATE[s], (c + 2, a + "I"))
        return out

    for code in codes:
        following = {}
        for s, (c, a) in inserted(best).items():
            offer(following, s, (c + 3, a + "D"))
            if code != "x":
                cut, due = code.isupper(), "a" if s == 2 else "u"
                if code.lower() == "s" and s == 0:
                    offer(following, 1, (c + cut, a + "K"))
                way = (c + cut, a + "K") if code.lower() == due else (c + cut + 2, a + "R")
                offer(following, turn_repair.NEXT_STATE[s], way)
        best = following
    best = inserted(best) if closing else best
    return min((best[g] for g in goals if g in best), default=None)


def test_search_is_optimal():
    for n in range(5):
        for codes in itertools.product("xsuaoSUAO", repeat=n):
            assert turn_repair.search("".join(codes)) == cheapest(codes)
    pick = random.Random(1)
    for _ in range(300):
        codes = "".join(pick.choices("xsuauauaoSUAO", k=pick.randint(5, 60)))
        for entry in range(4):
            for goals, closing in (((0, 3), True), *(((g,), False) for g in range(4))):
                assert turn_repair.search(codes, entry, frozenset(goals), closing) == cheapest(codes, entry, goals, closing)


def test_folded_segments_equal_one_search():
    pick = random.Random(2)
    for _ in range(200):
        codes = "".join(pick.choices("xsuauaoSUA", k=pick.randint(1, 40)))
        size = pick.randint(1, 9)
        cuts = [codes[i : i + size] for i in range(0, len(codes), size)]
        cost, chosen = turn_repair.fold((n, turn_repair.between(c, n == len(cuts) - 1)) for n, c in enumerate(cuts))
        assert (cost, "".join(a for _, _, a in chosen)) == cheapest(codes)


def repair_by_hand(rows):
    """Findings of one conversation's rows (turn, role, text)."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))
    seen, codes, counts = set(), "", [0, 0, 0]
    for _, role, text in rows:
        bare = text.strip(WHITE)
        fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
        if fault is not None:
            counts[fault] += 1
        seen.add((role, text))
        initial = role[:1] if role[:1] and role[:1] in "sua" else "o"
        codes += "x" if fault in (0, 1) else initial.upper() if fault == 2 else initial
    known = {t for t, _, _ in rows if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = cheapest(codes)
    out, i = [], 0
    for letter in audit:
        due = "user" if not out or out[-1][0][:1] != "u" else "assistant"
        if letter in "KR":
            out.append((rows[i][1] if letter == "K" else due, rows[i][2]))
        elif letter == "I":
            out.append((due, ""))
        i += letter != "I"
    return (gaps, *counts, illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in out)))


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "conv_id long, turn long, role string, text string, place string, code string, line string")


ODD = [
    (1, None, None, None), (1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 3, "assistant", "Well"), (None, 1, "system", "s."), (None, 2, "tool", "t!"),
    (2, 5, "", "a?"), (2, 6, "assistant", " \n"), (3, 1, "user", "q? " * 50_000), (3, 2, "assistant", "."), (3, 2, "assistant", "."), (3, 2, "bot", "b."),
    (4, None, "user", "x."), (4, None, "assistant", "y."), (5, 1, "user", "é…"), (5, 2, "assistant", "a:\nb. \x0b"),
]


def grouped(rows):
    out = {}
    for c, *rest in rows:
        out.setdefault(c, []).append(tuple(rest))
    return out


@pytest.mark.parametrize("config", [turn_repair.Config(), turn_repair.Config(rows=0, segment=2), turn_repair.Config(bytes=1000, segment=3)])
def test_repairs_match_brute_force(spark, config):
    pick = random.Random(5)
    texts = ["Yes.", "No!", "cut", "", "  ", "Why?", "More words here.", "\u2028."]
    rows = [*ODD, *((100 + c, pick.choice([None, *range(12)]), pick.choice(["user", "assistant", "system", "unknown", "tool"]), pick.choice(texts))
                    for c in range(25) for _ in range(pick.randint(1, 14)))]
    got = turn_repair.findings(conversations(spark, rows), config).collect()
    expected = {c: repair_by_hand(r) for c, r in grouped(rows).items()}
    assert len(got) == len(expected) and {r[0]: tuple(r)[1:] for r in got} == expected
    lines = {}
    for r in turn_repair.turns(conversations(spark, rows), config).orderBy("conv_id", "line").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for c, found in expected.items():
        assert sha("\n".join(lines.get(c, []))) == found[-1]


def test_hot_conversation_is_cut_into_segments(spark):
    pick = random.Random(9)
    rows = [(7, t, pick.choice(["user", "assistant"]), f"turn {pick.randint(0, 400)}.") for t in range(3000)] + [(c, 0, "user", "a.") for c in range(100, 120)]
    got = turn_repair.findings(conversations(spark, rows), turn_repair.Config(rows=500, segment=64)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {c: repair_by_hand(r) for c, r in grouped(rows).items()}


def test_repairs_of_an_empty_table(spark):
    assert turn_repair.findings(conversations(spark, ODD).filter("false")).count() == 0
    assert turn_repair.turns(conversations(spark, ODD).filter("false")).count() == 0


def test_damage_drops_empties_cuts_repeats_and_gives_to_the_user(spark):
    rows = [(c, t, "assistant", "One. Two?") for c in range(30) for t in range(6)] + [(None, None, None, None)]
    expected = []
    for c, t, role, text in rows:
        blank = lambda v: " " if v is None else str(v)
        harm = zlib.crc32(f"{blank(c)}:{blank(t)}".encode()) % 20
        role, text = "user" if harm == 4 else blank(role), {1: "", 2: "One Two"}.get(harm, blank(text)) if text else " "
        expected += [(c, t, role, text)] * {0: 0, 3: 2}.get(harm, 1)
    got = [tuple(r) for r in damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


# Merkle manifest


def tree(nodes):
    """Top and, per node, the (left, right) digests met on the way to it."""
    paths, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        ups, owners = [], []
        for i in range(0, len(nodes), 3):
            run = nodes[i : i + 3]
            for j in range(len(run)):
                for k in below[i + j]:
                    paths[k].append(("".join(run[:j]), "".join(run[j + 1 :])))
            ups.append(sha("".join(run)))
            owners.append(sum(below[i : i + 3], []))
        nodes, below = ups, owners
    return nodes[0], paths


def manifest_by_hand(rows):
    leaf = lambda r: sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))
    held = {}
    for r in rows:
        held.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    sources = sorted(held, key=lambda s: (s is not None, (s or "").encode()))
    tops = {s: tree([x[2] for x in sorted(held[s], key=lambda x: x[:3])]) for s in sources}
    root, upper = tree([tops[s][0] for s in sources])
    out = []
    for n, s in enumerate(sources):
        for (_, _, h, r), path in zip(sorted(held[s], key=lambda x: x[:3]), tops[s][1]):
            path = path + upper[n]
            cut = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            now = leaf((*r[:4], r[4] and r[4].replace("\n", ""))) if cut else h
            for left, right in path:
                now = sha(left + now + right)
            out.append((r[0], h, tops[s][0], root, sha("".join(a + b for a, b in path)), now, now == root))
    return sorted(out, key=repr)


def tamper():
    return {"text": F.translate("text", "\n", "")}, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0


def manifest(docs):
    out = merkle_levels.manifest(docs, *tamper())
    rows = out.select("doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256), "folded_root", F.col("folded_root") == F.col("root"))
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def rows_of(n, source, start=0):
    return [(start + i, source, None if i % 7 == 0 else "de", i, None if i % 5 == 0 else f"line {i}\nß" * (i % 4)) for i in range(n)]


@pytest.mark.parametrize("counts", [{"a": 1}, {"a": 243, "b": 1}, {"a": 244, None: 4, "é": 1, "z": 82}, {"hot": 1500, "": 3, "B": 730}])
def test_manifest_matches_brute_force(spark, counts):
    rows = [r for n, (s, k) in enumerate(counts.items()) for r in rows_of(k, s, n * 10_000)]
    # a hot id with different and with equal rows, and null ids
    rows += [(5, "a", "x", 1, f"v{i % 40}\n") for i in range(120)] + [(None, "a", None, None, "\n"), (None, None, None, None, None), (9, "a", "x", 2, "w" * 300_000)]
    docs = spark.createDataFrame([(*r, "p", "q", "r") for r in rows], "doc_id long, source string, lang string, n_chars int, text string, place string, block string, leaf string")
    assert manifest(docs.repartition(7)) == manifest_by_hand(rows)
    assert manifest(docs.filter("false")) == []


def test_many_sources_climb_a_tree_of_their_own(spark):
    rows = [(i, f"s{i % 900}", None, i, f"t{i}\n") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    assert manifest(docs) == manifest_by_hand(rows)


def test_places_of_a_hot_group(spark):
    rows = [(0, i % 50, i) for i in range(900)] + [(None, 1, 1), (None, None, 2), (3, 3, 3)]
    with scratch(spark) as keep:
        got = places.ranked(spark.createDataFrame(rows, "g long, k long, n long"), "g", ["k", "n"], keep).collect()
        sizes = places.ranked(spark.createDataFrame(rows, "g long, k long, n long"), "g", ["k", "n"], keep).groupBy(F.spark_partition_id()).count().collect()
    assert max(r[1] for r in sizes) < 600
    for g in (0, None, 3):
        mine = sorted(((r.k is not None, r.k, r.n) for r in got if r.g == g), key=lambda x: (x[0], x[1] or 0, x[2]))
        assert {(r.k, r.n): r.place for r in got if r.g == g} == {(k, n): p for p, (_, k, n) in enumerate(mine)}


# byte-pair encoding


def word_file():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def test_ids_and_texts_equal_the_library(spark, texts):
    tokenizer = library(word_file())
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_bpe_index"](spark, FOLDER).collect()}
    assert len(got) == len(texts)
    for doc, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert got[doc] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha(decoded))


def test_any_characters_equal_the_library():
    tokenizer, rules, pick = library(word_file()), bpe_index.Vocabulary(word_file()), random.Random(3)
    letters = "abcÉΣσς' 's'll'T\n\t\x1c\x85\xa0 0123½٣日本ｋ́éİ😀‍.,!-_ǅªᾈẞ ﬁͅΩ<|>"
    texts = ["".join(pick.choices(letters, k=pick.randint(0, 60))) + pick.choice(["", "<|endoftext|>", "<|startoftext|>x"]) for _ in range(4000)]
    texts += ["".join(chr(pick.choice([pick.randint(0, 0x2FFF), pick.randint(0, 0x10FFFF)])) for _ in range(40)).encode("utf8", "ignore").decode() for _ in range(1000)]
    texts += ["a" * 100_000, "aaaa bbb " * 2000, "the" * 5000, "", "<|endoftext|>" * 3]
    for text, found in zip(texts, bpe_index.encode_run(texts, rules)):
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(found, "<u4").tolist() == expected, text[:200]
        assert " ".join(rules.names[i] for i in expected) == tokenizer.decode(expected, skip_special_tokens=False)


def test_merges_that_make_pairs_of_lower_rank(tmp_path):
    """Two ways to one symbol: a merge may bring up a pair that stands earlier in the list."""
    with open(word_file(), encoding="utf-8") as file:
        parts = json.load(file)
    letters = bpe_index.byte_letters()
    merges = [["a", "b"], ["abcd", "a"], ["abc", "d"], ["b", "c"], ["a", "bc"], ["ab", "c"], ["a", "a"], ["aa", "a"], ["aa", "aa"], ["d", "abc"]]
    names = [*letters, *(c + "</w>" for c in letters), *dict.fromkeys(x + y for x, y in merges), "<|startoftext|>", "<|endoftext|>"]
    for order in range(30):
        pick = random.Random(order)
        pick.shuffle(merges)
        parts["model"] |= {"vocab": {n: i for i, n in enumerate(names[:-2])}, "merges": merges}
        for token, i in zip(parts["added_tokens"], (len(names) - 2, len(names) - 1)):
            token["id"] = i
        path = tmp_path / f"{order}.json"
        path.write_text(json.dumps(parts))
        tokenizer, rules = library(str(path)), bpe_index.Vocabulary(str(path))
        words = ["".join(pick.choices("abcd", k=pick.randint(1, 40))) for _ in range(200)]
        for word, found in bpe_index.word_ids(sorted(set(words)), rules).items():
            assert np.frombuffer(found, "<u4").tolist() == tokenizer.encode(word).ids, (merges, word)


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe_index, "KNOWN_BYTES", 50)
    rules, tokenizer = bpe_index.Vocabulary(word_file()), library(word_file())
    for text in ("some words here", "other words <|endoftext|> there", "some words here"):
        assert np.frombuffer(bpe_index.encode_run([text], rules)[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert rules.known_bytes <= 50


def test_odd_documents_encode(odd):
    got = bpe_index.decode(bpe_index.encode(odd, word_file()), word_file()).toPandas()
    assert len(got) == 8 and got.doc_id.isna().sum() == 1
    assert got[got.doc_id.isin([1, 2, 3, 6])].n_tokens.tolist() == [0] * 4 and set(got[got.doc_id.isin([1, 2, 3, 6])].decoded) == {""}
    assert got[got.doc_id == 4].decoded.nunique() == 1
    one_pass = bpe_index.encode(odd, word_file(), with_text=True).toPandas()
    rows = lambda frame: sorted(map(repr, frame.itertuples(index=False)))
    assert rows(got) == rows(one_pass)
    empty = bpe_index.encode(odd.filter("false"), word_file())
    assert bpe_index.decode(empty, word_file()).count() == 0
