"""The eleven queries on the smallest tables, against SQL or against brute force."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash
from compare import canonical, connect

from starling.llm import oracles, queries
from starling.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def result(spark, name):
    return QUERIES[name](spark, FOLDER).toPandas()


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, name, folder):
    got, expected = QUERIES[name](spark, folder).toPandas(), connect(folder).sql(oracles.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert canonical(got) == canonical(expected)


def leaks_by_brute_force(spark, texts):
    """(document, item) pairs: every window of every text against every item it shares a shingle with."""
    from starling.llm.decontaminate import Config

    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    shingles = lambda w: [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []
    items = {r["item_id"]: words(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    expected = set()
    for doc, text in texts:
        found = shingles(words(text))
        for item, item_words in items.items():
            bag = collections.Counter(shingles(item_words))
            if len(item_words) < 5 or not bag.keys() & set(found):
                continue
            size = min(sum(bag.values()), len(found))
            for i in range(len(found) - size + 1):
                shared = sum((collections.Counter(found[i : i + size]) & bag).values())
                if shared / (size + sum(bag.values()) - shared) >= Config().similarity:
                    expected.add((doc, item))
    return expected


def test_leaks_match_brute_force(spark, texts):
    from starling.llm.decontaminate import Config

    expected = leaks_by_brute_force(spark, texts)
    got = result(spark, "op3_simhash_decontamination")
    assert expected and set(zip(got.doc_id, got.item_id)) == expected
    assert (got.distance <= Config().radius).all() and len(got) == len(expected)


@pytest.mark.parametrize("name, label, threshold, least", [("op4_zstd_quality", "quality", 0.5, 0.9), ("op5_toxicity_gru", "toxic", 0.7, 0.9)])
def test_held_out_accuracy(spark, name, label, threshold, least):
    folder = "/root/testdata/sf0.01"
    got = QUERIES[name](spark, folder).toPandas()
    assert got.score.between(0, 1).all() and ((got.score >= threshold) == (got.predicted == 1)).all()
    assert list(got.held_out) == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert len(held) > 50 and (held.predicted == held[label]).mean() >= least


def test_quality_scores_are_those_of_the_two_dictionaries(spark, texts, documents):
    """Sizes of 768-byte blocks under either dictionary, taken one by one, and the curve on their difference."""
    import zstandard

    from starling.llm import zstd_quality

    model = zstd_quality.fit(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    got = {r.doc_id: r.score for r in zstd_quality.classify(documents, model).collect()}

    def size(block, dictionary):
        rules = zstandard.ZstdCompressionParameters.from_level(
            3, dict_size=len(dictionary), source_size=768, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_dict_id=0, write_checksum=0)
        return len(zstandard.ZstdCompressor(compression_params=rules, dict_data=zstandard.ZstdCompressionDict(dictionary)).compress(block))

    for doc, text in texts[:60]:
        data = (text or "").encode()
        blocks = [data[i : i + 768] for i in range(0, len(data), 768)]
        saved = sum(size(b, model.bad) - size(b, model.good) for b in blocks) / (len(data) + 16)
        assert got[doc] == pytest.approx(1 / (1 + np.exp(-np.clip(model.slope * saved + model.shift, -30, 30))))


def test_toxicity_scores_are_the_highest_of_single_windows(spark, texts, documents):
    """The network on one window after another, gates and attention in plain loops."""
    from starling.llm import toxicity_gru

    network = toxicity_gru.fit(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    got = {r.doc_id: r.score for r in toxicity_gru.classify(documents, network).collect()}
    w, c = network.w, network.config
    gate = lambda x: np.clip(0.2 * x + 0.5, 0, 1)

    def one(x):
        halves = []
        for d, order in (("f", range(len(x))), ("b", range(len(x) - 1, -1, -1))):
            state, out = np.zeros(c.hidden), [None] * len(x)
            for t in order:
                a, b = x[t] @ w[f"in_{d}"] + w[f"add_{d}"], state @ w[f"state_{d}"]
                z, r = gate(a[: c.hidden] + b[: c.hidden]), gate(a[c.hidden : 2 * c.hidden] + b[c.hidden : 2 * c.hidden])
                state = z * state + (1 - z) * np.tanh(a[2 * c.hidden :] + r * b[2 * c.hidden :])
                out[t] = state
            halves.append(np.array(out))
        states = np.concatenate(halves, axis=1)
        energy = np.tanh(states @ w["attend"] + w["attend_bias"]) @ w["v"]
        weight = np.exp(energy - energy.max())
        return 1 / (1 + np.exp(-((weight / weight.sum()) @ states @ w["out"] + w["bias"][0])))

    for doc, text in texts[:25]:
        words = toxicity_gru.read([(text or "").encode()], c)
        vectors = network.vectors(words.word, words.grams, words.counts)
        windows = [vectors[words.tokens[f : f + n]] for f, n in zip(words.first, words.size)]
        assert got[doc] == pytest.approx(max(map(one, windows), default=0.0), abs=1e-4)
        # windows of 32 words begin every 24 words and reach the last word
        number = len(words.tokens)
        assert list(words.first) == ([24 * i for i in range(1 + max(0, -(-(number - 32) // 24)))] if number else [])


def test_recall_and_false_alarms_of_toxicity(spark):
    """Accuracy alone says little where few are toxic.

    Some 300 toxic texts are learnt from here. Of the toxic texts held out, 9 of 144 have no word that
    tells them apart; measured recall is 0.78, false alarms 0.03. With 1,200 both are better (README).
    """
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op5_toxicity_gru"](spark, folder).toPandas().merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    toxic, clean = held[held.toxic == 1], held[held.toxic == 0]
    assert len(toxic) > 100 and (toxic.predicted == 1).mean() >= 0.72 and (clean.predicted == 1).mean() <= 0.05


def test_the_fast_tokenizer_equals_the_named_one():
    """Packing encodes with one library and is held to the ids of another."""
    import random

    from tokenizers import Tokenizer

    rules = queries.vocabulary()
    named, fast = Tokenizer.from_file(rules.tokenizer), rules.encoder()
    pick = random.Random(1)
    letters = "ab cdé\n\t  0123'sll\u00a0日本😀.,!<|endoftext|>ſK"
    texts = ["".join(pick.choices(letters, k=pick.randint(0, 50))) for _ in range(2000)]
    texts += ["".join(chr(pick.choice([pick.randint(1, 0x2FFF), pick.randint(1, 0x10FFFF)])) for _ in range(30)).encode("utf8", "ignore").decode() for _ in range(1000)]
    for text in texts:
        assert list(fast(text)) == named.encode(text, add_special_tokens=False).ids, repr(text)


def test_packing_is_an_exact_round_trip(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary().tokenizer)
    ids = {d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for d, t in texts}
    got = result(spark, "op6_ssq_packing")
    for doc, pieces in got.groupby("doc_id"):
        pieces = pieces.sort_values("start")
        assert (pieces.start == pieces.length.cumsum() - pieces.length).all() and pieces.length.sum() == len(ids[doc])
        assert (pieces.doc_tokens == len(ids[doc])).all()
        for p in pieces.itertuples():
            assert p.ids_crc32 == zlib.crc32(ids[doc][p.start : p.start + p.length].tobytes())
    assert set(got.doc_id) == set(ids)
    for _, sequence in got.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        fill = sequence.length.sum()
        assert (sequence.offset == sequence.length.cumsum() - sequence.length).all() and fill <= 1024 and fill & (fill - 1) == 0


def test_counts_match_the_tokenizer(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer, models

    from starling.llm import viterbi_counts as V

    pieces = V.pieces_of(public_tokenizers.path("piece_bpe_32k.model"))
    tokenizer = Tokenizer(models.Unigram(pieces, 0, True))
    expected = {d: len(tokenizer.encode((V.MARK + t).replace(" ", V.MARK)).ids) if t else 0 for d, t in texts}
    got = result(spark, "op7_viterbi_counts")
    assert dict(zip(got.doc_id, got.n_tokens)) == expected
    count = V.Counter(pieces, limit=3)
    for text in ("  a  b", " a\n\nb \n c", "日本語 😀", "\n", "<0x0A> <s>", "a▁b  ▁▁c", "x" * 500):
        assert count(text) == len(tokenizer.encode((V.MARK + text).replace(" ", V.MARK)).ids)


PATTERNS = {  # the stated patterns of the base kinds
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    def valid(kind, match):
        digits = re.sub(r"[^0-9]", "", match)
        if kind == "ip":
            return all(int(p) <= 255 for p in match.split("."))
        if kind == "phone":
            return 10 <= len(digits) <= 15
        if kind == "card":
            doubled = (int(c) if i % 2 == 0 else 2 * int(c) - 9 * (c > "4") for i, c in enumerate(reversed(digits)))
            return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return True

    spans = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if valid(k, m.group())]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))


def test_personal_data_matches_brute_force(spark, make, texts):
    from starling.llm import pii_bootstrap

    tricky = [
        "a@b.cd@e.f g_@h-.i..j x@y", "a@b.c_x@d.e.f", "1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.2.3 99999999999.1.1.1", "é 4111 1111 1111 1111 4111-1111-1111-1112",
        "4111111111111111" + "0" * 9000, "+1 (555) 010-9999 ++49 30 1234567 +1--------2", "a." * 4000 + "b@" + "c." * 4000 + "d", "1 2  3 4-5--6", "٣@x.y 1.1.1.1@a.b",
    ]
    got = pii_bootstrap.personal_data(make([*enumerate(tricky), *((d + 1000, t) for d, t in texts)])).toPandas().set_index("doc_id")
    for doc, text in [*enumerate(tricky), *((d + 1000, t) for d, t in texts)]:
        expected = base_spans(text)
        assert got.base_sha256[doc] == hashlib.sha256(expected.encode()).hexdigest(), text
        assert set(filter(None, expected.split(","))) <= set(got.spans[doc].split(","))
        for kind in PATTERNS:
            assert got[f"n_{kind}"][doc] == len(re.findall(rf"{kind}:", expected))


def test_simhash_matches_brute_force(spark, texts):
    prints, table = {}, str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc, text in texts:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(table)) if w]
        hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))] if words else []
        prints[doc] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    parent = {d: d for d in prints}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    docs = sorted(prints)
    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = result(spark, "op9_vp_simhash")
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got.itertuples()} == {d: (f"{prints[d]:016x}", root(d)) for d in docs}


def cut_by_brute_force(rows, length=200):
    seen = collections.Counter(t[i : i + length] for _, t in rows for i in range(len(t) - length + 1))
    out = []
    for doc, t in rows:
        keep = np.ones(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                keep[i : i + length] = False
        spans = int(np.diff((~keep).astype(np.int8), prepend=0).clip(0).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[keep])
        out.append((doc, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_repeated_bytes_match_brute_force(spark, texts):
    got = [tuple(r) for r in result(spark, "op10_suffix_merge").itertuples(index=False)]
    assert sorted(got, key=repr) == cut_by_brute_force([(d, (t or "").encode()) for d, t in texts])


def components_by_brute_force(prints):
    """Smallest id that each id reaches over links of at most four bits."""
    parent = {d: d for d in prints}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    docs = sorted(prints)
    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in docs}


def test_pipeline_equals_its_stages_by_brute_force(spark):
    """Ids and texts after every stage, from scores, plain components, plain leaks and listed spans."""
    import corpus_pipeline

    from starling.llm import pii_bootstrap, vp_simhash, zstd_quality

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, schema, after = docs.columns, docs.schema, [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, after[-1], FOLDER)
        assert frame.columns == columns, name
        after.append(spark.createDataFrame(frame.toPandas(), schema))
    held = [{r["doc_id"]: r["text"] for r in frame.collect()} for frame in after]
    # quality: what the classifier scores at a half or more
    model = zstd_quality.fit(after[0], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    scores = {r.doc_id: r.score for r in zstd_quality.classify(after[0], model).collect()}
    assert held[1] == {d: t for d, t in held[0].items() if scores[d] >= 0.5} and len(held[1]) < len(held[0])
    # near duplicates: of every group the smallest id
    ids = sorted(held[1])
    prints = dict(zip(ids, map(int, vp_simhash.fingerprints([(held[1][d] or "").encode() for d in ids], 4))))
    roots = components_by_brute_force(prints)
    assert held[2] == {d: held[1][d] for d in set(roots.values())} and len(held[2]) < len(held[1])
    # decontamination: what leaks no item
    leaky = {d for d, _ in leaks_by_brute_force(spark, list(held[2].items()))}
    assert leaky and held[3] == {d: t for d, t in held[2].items() if d not in leaky}
    # personal data: every listed span gives way to its kind, the first of overlapping ones
    found = {r.doc_id: r.spans for r in pii_bootstrap.personal_data(after[3]).collect()}
    for doc, text in held[3].items():
        out, at = [], 0
        for kind, start, end in (x.split(":") for x in found[doc].split(",") if x):
            if int(start) >= at:
                out += [text[at : int(start)], f"[{kind.upper()}]"]
            at = max(at, int(end))
        assert held[4][doc] == (text if text is None else "".join(out) + text[at:])
    assert held[4].keys() == held[3].keys()
    assert {r["n_chars"] == len(r["text"] or "") for r in after[4].collect()} == {True}
    pieces = corpus_pipeline.run(spark, FOLDER).toPandas()
    assert set(pieces.doc_id) == held[4].keys()
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()
