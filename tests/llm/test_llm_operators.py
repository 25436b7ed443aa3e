"""Odd input, ties, hot groups and the operators' own interfaces."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_contracts import cut_by_brute_force

from starling.llm import components, decontaminate, host_reputation, pii_bootstrap, rule_ledger, ssq_packing, suffix_merge
from starling.llm import toxicity_gru, viterbi_counts, vp_simhash, zstd_quality
from starling.llm.queries import vocabulary
from starling.session import scratch


def piece_file():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, "two words"), (4, "alpha beta gamma delta epsilon zeta eta theta iota")], "item_id long, text string")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 0, 1), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "ledger": lambda d, b, l: rule_ledger.ledger(rule_ledger.measure(d)),
    "leaks": lambda d, b, l: decontaminate.leaks(d, b),
    "clean": lambda d, b, l: decontaminate.clean(d, b),
    "quality": lambda d, b, l: zstd_quality.classify(d, zstd_quality.fit(d, l)),
    "toxicity": lambda d, b, l: toxicity_gru.classify(d, toxicity_gru.fit(d, l)),
    "pack": lambda d, b, l: ssq_packing.pack(d, vocabulary()),
    "counts": lambda d, b, l: viterbi_counts.count_tokens(d, piece_file()),
    "pii": lambda d, b, l: pii_bootstrap.personal_data(d),
    "redact": lambda d, b, l: pii_bootstrap.redact(d),
    "simhash": lambda d, b, l: vp_simhash.near_duplicates(d),
    "one_of_each": lambda d, b, l: vp_simhash.one_of_each(d),
    "suffixes": lambda d, b, l: suffix_merge.removed(d),
}
PER_ROW = {"ledger", "quality", "toxicity", "counts", "pii", "redact", "simhash", "suffixes", "clean"}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_input_has_a_defined_result(odd, benchmark, labels, name):
    got = OPERATORS[name](odd, benchmark, labels).toPandas()
    if name in PER_ROW:
        assert len(got) == 8 and got.doc_id.isna().sum() == 1
    if name == "pack":
        assert set(got.doc_id.dropna()) == {1, 2, 3, 4, 5, 6} and got[got.doc_id == 2].doc_tokens.tolist() == [1]
    if name == "simhash":
        assert got[got.doc_id.isin([1, 2, 3, 6])].component_id.unique().tolist() == [1]
        assert got[got.fingerprint == got[got.doc_id == 4].fingerprint.iloc[0]].component_id.unique().tolist() == [4]
    if name == "one_of_each":
        assert sorted(got.doc_id) == [1, 4, 5]
    if name == "suffixes":
        long = got[got.doc_id == 5].iloc[0]
        assert long.n_removed == long.n_bytes and got[got.doc_id == 4].n_removed.tolist() == [0, 0]


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_tables(odd, benchmark, labels, name):
    assert OPERATORS[name](odd.filter("false"), benchmark.filter("false"), labels.filter("false")).count() == 0


# quality rules


def thue_morse(n, swap=False):
    """Two such strings, letters swapped, collide under any polynomial hash modulo a power of two."""
    return "".join("ab"[(i.bit_count() + swap) % 2] for i in range(n))


def counts_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, covered = collections.Counter(windows), set()
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), len(lines) - len(set(lines)), len(covered)


def test_built_texts_do_not_collide():
    a, b, pick = thue_morse(2048), thue_morse(2048, True), random.Random(1)
    rest = " x y z u v w q "
    texts = [f"{a}\n{b}", a + rest + b + rest, f"{a}\n{a}", "", " \n", a + rest + a + rest]
    texts += [" ".join(pick.choices("ab", k=pick.randint(0, 60))) for _ in range(200)]
    texts += ["\n".join(pick.choices(["a", "b b", "", a, b], k=pick.randint(0, 9))) for _ in range(100)]
    found = rule_ledger.measured([t.encode() for t in texts])
    got = zip(*(found[m].tolist() for m in ("n_words", "n_dup_lines", "n_repeat_words")))
    assert list(got) == [counts_by_hand(t) for t in texts]


# url filter


def urls(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, good int")


def test_host_reputation_shrinks_and_rules_win(spark):
    rows = [(i, f"http://bad.other.org/{i}", 0) for i in range(40)] + [(100 + i, f"http://Good.site.org/{i}", 1) for i in range(400)]
    rows += [(600 + i, f"https://farm{i}.spam.net/x", 0) for i in range(60)] + [(700, "http://new.spam.net/y?z", None), (701, "http://new.site.org", None)]
    rows += [(702, None, None), (703, "no url", None), (704, "http://one.site.org/", 0), (705, "ftp://ok.spam.net/en/a#b", None)]
    pages = urls(spark, rows)
    rules = (host_reputation.Rule("allow", "spam.net/en/"), host_reputation.Rule("block", "net/en/a/b/c"))
    got = host_reputation.judge(pages, pages, rules).toPandas().set_index("page_id")
    assert set(got.verdict[:40]) == {"block"} and set(got.verdict[got.host == "good.site.org"]) == {"allow"}
    assert got.verdict[700] == "block", "an unseen host of a bad domain"
    assert got.verdict[701] == got.verdict[704] == "allow", "one bad page is not enough in a good domain"
    assert (got.host[702], got.path[702], got.host[703], got.path[703]) == ("", "", "", "")
    assert (got["rule"][705], got.verdict[705]) == ("spam.net/en/", "allow") and len(got) == len(rows)
    assert host_reputation.judge(pages.filter("false"), pages.filter("false"), rules).count() == 0
    blind = host_reputation.judge(pages, pages.filter("false"), ()).toPandas()
    assert set(blind.verdict) == {"allow"}


# rules


def test_policies_and_ablations_follow_the_masks(spark, documents):
    entries = rule_ledger.ledger(rule_ledger.measure(documents)).cache()
    rows = {(r["policy"], r["rule"]): r for r in rule_ledger.ablations(entries).collect()}
    masks = [r["failures"] for r in entries.collect()]
    for (policy, rule), r in rows.items():
        bit, mask = 1 << next(x.bit for x in rule_ledger.RULES if x.name == rule), rule_ledger.mask_of(policy)
        assert r["n_failed"] == sum(bool(m & bit) for m in masks)
        assert r["n_only"] == sum(m & mask == bit for m in masks)
        assert r["n_kept_without"] == sum(m & mask & ~bit == 0 for m in masks)
    assert entries.filter(rule_ledger.passes("v2")).count() <= entries.filter(rule_ledger.passes("base")).count()


# decontamination


def test_leaks_survive_case_and_punctuation_but_not_rewriting(make, benchmark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota"
    rows = [
        (1, "intro words " + item.upper() + " tail"), (2, "x " + item.replace(" ", ", ") + "."), (3, item), (4, item + " " + item),
        (5, item.replace("epsilon", "omega")), (6, "two words"), (7, "alpha beta gamma delta epsilon"), (7, item),
    ]
    got = decontaminate.leaks(make(rows), benchmark).toPandas()
    assert sorted(got.doc_id) == [1, 2, 3, 4, 7] and set(got.item_id) == {4} and (got.similarity == 1).all()
    assert sorted(r["doc_id"] for r in decontaminate.clean(make(rows), benchmark).collect()) == [5, 6]


def test_a_leak_without_id_takes_no_other_row_with_it(make, benchmark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota"
    rows = [(None, item), (None, "a clean text of enough words to be one"), (None, None), (1, item), (2, "clean")]
    assert sorted(str(r["text"]) for r in decontaminate.clean(make(rows), benchmark).collect()) == ["None", "a clean text of enough words to be one", "clean"]


def test_near_pairs_are_all_pairs_within_the_radius(spark):
    """Both ways of filing, against all pairs; unrelated pairs rarely meet."""
    draw = np.random.default_rng(4)
    prints = draw.integers(-(2**63), 2**63, 5000, dtype=np.int64)
    flipped = prints[:300].copy()
    for row in range(300):
        for bit in draw.choice(64, row % 18, replace=False):
            flipped[row] ^= np.int64(np.uint64(1 << int(bit)).astype(np.int64))
    windows = np.unique(np.concatenate((flipped, draw.integers(-(2**63), 2**63, 400, dtype=np.int64))))
    far = np.bitwise_count(windows.view(np.uint64)[:, None] ^ prints.view(np.uint64)[None, :])
    expected = {(int(windows[x]), int(y), int(far[x, y])) for x, y in zip(*np.nonzero(far <= 15))}
    left = spark.createDataFrame([(7, int(w)) for w in windows], "m int, print long")
    right = spark.createDataFrame([(7, int(p), i) for i, p in enumerate(prints)], "m int, item_print long, item_id long")
    with scratch(spark) as keep:
        got = {(r.print, r.item_id, r.distance) for r in decontaminate.near_pairs(left, right, decontaminate.Config(), keep).collect()}
        assert got == expected
        few = right.filter("item_id < 200")
        got = {(r.print, r.item_id, r.distance) for r in decontaminate.near_pairs(left, few, decontaminate.Config(), keep).collect()}
        assert got == {x for x in expected if x[1] < 200}
    # rows of the join before the distance is taken, against all pairs
    filed = spark.range(1).select(F.explode(decontaminate.blocks_of("id", 4, 3)).alias("cut")).groupBy("cut.block").count().collect()
    assert sum(r["count"] for r in filed) / 65_536 < 0.05


def test_edited_passages_match_brute_force_over_all_windows(spark, make):
    """Words changed at either end of a passage: a leak may show only in a window that begins between two hits."""
    draw, rows, size = random.Random(17), [], 50
    item = [f"item{i}" for i in range(size)]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    other = lambda n: [f"w{draw.getrandbits(40)}" for _ in range(n)]
    for i in range(900):
        n = draw.randrange(3, 6)
        body = other(n) + item[n:] if i % 2 else item[:-n] + other(n)
        rows.append((i, " ".join(other(12) + body + other(12))))
    documents, config = make(rows), decontaminate.Config()
    hashes = lambda frame, k: {r[0]: r[1] for r in frame.select(k, decontaminate.shingles_of(decontaminate.words_of(), config.shingle)).collect()}
    bits = lambda h: (np.array(h, np.int64).view(np.uint64)[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    (wanted,) = hashes(benchmark, "item_id").values()
    m, mark, expected = len(wanted), 2 * bits(wanted).sum(axis=0) > len(wanted), {}
    for doc, found in hashes(documents, "doc_id").items():
        sums = np.concatenate((np.zeros((1, 64), np.uint64), np.cumsum(bits(found), axis=0)))
        shared = np.concatenate(([0], np.cumsum(np.isin(found, wanted))))
        shared = shared[m:] - shared[:-m]
        distance = ((2 * (sums[m:] - sums[:-m]) > m) != mark).sum(axis=1)
        good = int(((shared / (2 * m - shared) >= config.similarity) & (distance <= config.radius)).sum())
        if good:
            expected[doc] = good
    got = decontaminate.leaks(documents, benchmark).toPandas()
    assert len(expected) > 100 and dict(zip(got.doc_id, got.n_windows)) == expected


def test_hamming_blocks_find_every_pair_within_the_radius(spark):
    draw = random.Random(5)
    pairs = []
    for distance in range(16):
        for _ in range(20):
            a, b = draw.getrandbits(64), 0
            b = a
            for bit in draw.sample(range(64), distance):
                b ^= 1 << bit
            signed = lambda v: v - (1 << 64) if v >> 63 else v
            pairs.append((signed(a), signed(b)))
    frame = spark.createDataFrame(pairs, "a long, b long")
    met = F.exists(F.arrays_zip(decontaminate.blocks_of("a", 16).alias("x"), decontaminate.blocks_of("b", 16).alias("y")), lambda z: z["x"] == z["y"])
    assert frame.filter(~met).count() == 0


# quality


def test_a_hot_labelled_id_brings_one_row_to_the_driver(spark, make, monkeypatch):
    rows = [(1, f"text {9999 - i}") for i in range(2000)] + [(2, "other"), (2, "other"), (3, "x" * 50), (3, "a" * 5)]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    learnable = {r["doc_id"] for r in zstd_quality.agreed(labels, "quality").collect()}
    documents, sizes = make(rows), []
    plain = type(documents).toPandas
    monkeypatch.setattr(type(documents), "toPandas", lambda self: (sizes.append(len(found := plain(self))), found)[1])
    got = zstd_quality.sample(documents, labels, "quality", 10, 20)
    assert 1 in learnable and sizes == [len(learnable)]
    least = {1: "text 8000", 2: "other", 3: "a" * 5}
    assert sorted(got["text"]) == sorted(least[i] for i in learnable)


# packing


def test_sum_of_squares_level(spark):
    packer = ssq_packing.Packer(10)
    packer.counts[:] = [0, 0, 0, 2, 0, 0, 1, 0, 0, 0, 0]
    for n in range(1, 10):
        cost = {}
        for level in range(0, 11 - n):
            if level and not packer.counts[level]:
                continue
            after = packer.counts.copy()
            if level:
                after[level] -= 1
            if level + n < 10:
                after[level + n] += 1
            cost[level] = int((after**2).sum())
        assert cost[packer.level(n)] == min(cost.values())


def test_special_strings_are_encoded_as_the_tokenizer_does(make):
    from tokenizers import Tokenizer

    text = "before <|endoftext|> after"
    got = ssq_packing.pack(make([(1, text)]), vocabulary()).toPandas()
    assert got.length.sum() == len(Tokenizer.from_file(vocabulary().tokenizer).encode(text, add_special_tokens=False).ids) + 1


# toxicity


def test_gradients_match_finite_differences():
    config = toxicity_gru.Config(window=5, stride=3, hidden=3, word_size=2, char_size=2, word_buckets=16, char_buckets=32)
    network = toxicity_gru.Network(config)
    network.w = {k: v.astype(np.float64) for k, v in network.w.items()}
    draw = np.random.default_rng(1)
    ids, mask = draw.integers(0, 4, (5, 2)), np.array([[1, 1], [1, 1], [1, 1], [1, 0], [1, 0]], bool)
    x = draw.standard_normal((5, 4)) * 0.5
    x[4] = 0
    network.keep = True
    logit, kept = network.run(np.where(mask, ids, 4), mask, x)
    g, _ = network.gradients(np.where(mask, ids, 4), mask, x, kept, np.array([1.0, -2.0]))
    for name in ("out", "attend", "state_f", "state_b", "in_f", "v"):
        flat = network.w[name].reshape(-1)
        for i in range(0, len(flat), 5):
            before, losses = flat[i], []
            for step in (1e-3, -1e-3):
                flat[i] = before + step
                losses.append(network.run(np.where(mask, ids, 4), mask, x)[0] @ [1.0, -2.0])
            flat[i] = before
            assert abs((losses[0] - losses[1]) / 2e-3 - g[name].reshape(-1)[i]) < 2e-3, name


def test_windows_cover_every_word():
    config = toxicity_gru.Config()
    words = toxicity_gru.read([b"a " * n for n in (0, 1, 31, 32, 33, 56, 57, 500)], config)
    for doc, n in enumerate((0, 1, 31, 32, 33, 56, 57, 500)):
        mine = words.doc == doc
        base = sum((0, 1, 31, 32, 33, 56, 57, 500)[:doc])
        covered = {i for f, s in zip(words.first[mine], words.size[mine]) for i in range(f - base, f - base + s)}
        assert covered == set(range(n))


# personal data


def test_contexts_find_unseen_identifiers(make):
    filler = " and so on with plain words that say little here"
    rows = [(i, f"please call support desk {'+1 (555) 010-' + str(1000 + i)} today{filler}") for i in range(12)]
    rows += [(100, "please call support desk 555-77-1234 today" + filler), (101, "the number 555-00-9999 is no phone" + filler)]
    got = pii_bootstrap.personal_data(make(rows)).toPandas().set_index("doc_id")
    assert got.spans[100] == "phone:25:36" and got.n_phone[100] == 0 and got.spans[101] == ""
    assert got.spans[3].startswith("phone:25:") and got.n_phone[3] == 1
    clean = {r["doc_id"]: r["text"] for r in pii_bootstrap.redact(make(rows)).collect()}
    assert clean[100].startswith("please call support desk [PHONE] today")


def test_common_contexts_are_not_trusted(make):
    rows = [(i, f"we saw the +1 (555) 010-{1000 + i} there and we saw the cat and we saw the dog and we saw the sea") for i in range(12)]
    rows.append((100, "we saw the 1234-5678 elsewhere"))
    assert pii_bootstrap.personal_data(make(rows)).filter("doc_id = 100").first()["spans"] == ""


def test_contexts_find_identifiers_of_any_shape(make):
    """Without digits, of several tokens, glued to a label or bracket: what fills a trusted pattern is found whole."""
    rows = [(i, f"please write to support {'abcdefghijkl'[i]}x@mail{i}.example.com today and so on") for i in range(12)]
    rows += [(20 + i, f"please call our desk {'+1 (555) 010-' + str(1000 + i)} today and so on") for i in range(12)]
    mails = ["jane.doe(at)corp.com", "jane.doe@localhost", "jane99@corp", "jane (at) corp (dot) com"]
    phones = ["(555) 123 456", "555 123 4567", "555 - 123 - 4567", "555-7712"]
    rows += [(100 + i, f"please write to support {m} today and so on") for i, m in enumerate(mails)]
    rows += [(200 + i, f"please call our desk {m} today and so on") for i, m in enumerate(phones)]
    rows += [(300, "please call our desk:\"555-7713\" today"), (301, "see 555 123 4567 in jane99@corp there"), (302, "please call our desk again today")]
    got = pii_bootstrap.personal_data(make(rows)).toPandas().set_index("doc_id").spans
    for i, m in enumerate(mails):
        assert got[100 + i] == f"email:24:{24 + len(m)}", m
    for i, m in enumerate(phones):
        assert got[200 + i] == f"phone:21:{21 + len(m)}", m
    assert got[300] == "phone:22:30" and got[301] == got[302] == ""


def test_contexts_glued_to_their_span_have_a_corpus_count(make):
    rows = [(i, f"note tel:+1 (555) 010-{1000 + i} end") for i in range(12)] + [(20 + i, "note tel:cat end") for i in range(30)]
    rows.append((100, "note tel:5551234 end"))
    assert pii_bootstrap.personal_data(make(rows)).filter("doc_id = 100").first()["spans"] == ""


# near-duplicates


@pytest.mark.parametrize("config", [vp_simhash.Config(), vp_simhash.Config(shard=256, leaf=256), vp_simhash.Config(shard=64, sample=500, leaf=64)])
def test_forest_finds_every_link_of_dense_and_sparse_groups(spark, config):
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**63, 1500, dtype=np.int64).astype(np.uint64)
    flipped = [base]
    for count, origin in ((1, base[:500]), (4, base[500:900]), (5, base[900:1100]), (3, np.repeat(base[1200], 600))):
        part = origin.copy()
        for i in range(len(part)):
            for bit in draw.choice(64, count, replace=False):
                part[i] ^= np.uint64(1) << np.uint64(bit)
        flipped.append(part)
    prints = np.unique(np.concatenate(flipped))
    x, y = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4)
    forest = vp_simhash.Forest(len(prints))
    forest.add(x, y)
    expected = {int(p): int(prints.view(np.int64)[r]) for p, r in zip(prints.view(np.int64), forest.settle())}
    frame = spark.createDataFrame([(int(p), int(p)) for p in prints.view(np.int64)], "doc_id long, fp long")
    with scratch(spark) as keep:
        got = vp_simhash.classes(frame, keep, config).toPandas()
    groups = lambda m: sorted(sorted(k for k in m if m[k] == v) for v in set(m.values()))
    assert groups(dict(zip(got.fp, got.component_id))) == groups(expected)


@pytest.mark.parametrize("prints", [200_000, 400_000])
def test_filing_does_not_grow_with_the_corpus(prints):
    """Copies of a fingerprint and the largest shard, of random fingerprints, with many shards."""
    drawn = np.random.default_rng(5).integers(0, 2**63, prints, dtype=np.int64).astype(np.uint64)
    for shards in (1 << 10, 1 << 15):
        config = vp_simhash.Config(shard=15 * prints // shards)
        where = vp_simhash.Shards(drawn[: config.sample], prints, config)
        filed = np.concatenate([s for s, *_ in where.of(drawn)])
        assert len(filed) == 15 * prints and not where.hot
        assert np.bincount(filed).max() < 2 * len(filed) / shards + 100


def test_a_hot_bucket_is_cut_by_its_tree():
    """A third of all fingerprints near few centres that agree in two blocks: every link is in some shard, none holds all."""
    draw = np.random.default_rng(6)
    centres = draw.integers(0, 2**63, 12, dtype=np.int64).astype(np.uint64) << np.uint64(21) >> np.uint64(1)
    near = np.repeat(centres, 400)
    for _ in range(3):
        near = near ^ (np.uint64(1) << draw.integers(22, 62, len(near)).astype(np.uint64))
    prints = np.unique(np.concatenate((near, draw.integers(0, 2**63, 9000, dtype=np.int64).astype(np.uint64))))
    config = vp_simhash.Config(shard=1500)
    where = vp_simhash.Shards(prints, len(prints), config)
    assert where.hot
    seen, sizes = set(), {}
    for shard, keys, rows, home in where.of(prints):
        for s in np.unique(shard):
            mine = rows[shard == s]
            sizes[s] = sizes.get(s, 0) + len(mine)
    shards = {}
    for shard, keys, rows, home in where.of(prints):
        for s, k, r, h in zip(shard.tolist(), keys.tolist(), rows.tolist(), home.tolist()):
            shards.setdefault((s, k), []).append((r, h))
    for members in shards.values():
        rows, home = (np.array(x) for x in zip(*members))
        x, y = np.nonzero(np.bitwise_count(prints[rows][:, None] ^ prints[rows][None, :]) <= 4)
        touched = (home[x] | home[y]) & (rows[x] < rows[y])
        seen.update(zip(rows[x][touched].tolist(), rows[y][touched].tolist()))
    expected = set()
    for i in range(0, len(prints), 1000):
        x, y = np.nonzero(np.bitwise_count(prints[i : i + 1000, None] ^ prints[None, :]) <= 4)
        expected.update((a, b) for a, b in zip((x + i).tolist(), y.tolist()) if a < b)
    assert seen == expected and max(sizes.values()) < 2 * config.shard


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (7, 3), (2001, 2000)]
    with scratch(spark) as keep:
        got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long"), keep).collect()}
    assert all(got[i] == 0 for i in range(1, 101)) and all(got[1000 + i] == 1000 for i in range(1, 200)) and got[2001] == 2000


# repeated bytes


@pytest.mark.parametrize("hot", [0, 6, 40_000])
def test_suffix_merge_of_hard_texts(make, hot):
    """However frequent a gram must be to be dealt out further, the same bytes go."""
    draw = random.Random(9)
    noise = lambda n: "".join(draw.choice("abcdefghij klmnop\n") for _ in range(n))
    passage, other = noise(260), noise(200)
    rows = [noise(400) + passage + noise(100) for _ in range(25)] + [passage, other, "q" + other + "z", noise(199)]
    rows += ["a" * 700, "ab" * 300, "xyz" * 150 + noise(50), "é" * 150, noise(300) + "é" * 120]
    rows += [rows[0][:450], rows[1][300:], passage[:230] + other[30:], "same row" * 40, "same row" * 40]
    got = [tuple(r)[:5] for r in suffix_merge.removed(make(list(enumerate(rows))), suffix_merge.Config(entries=40, run=50, hot=hot)).collect()]
    assert sorted(got, key=repr) == cut_by_brute_force([(i, t.encode()) for i, t in enumerate(rows)])


def test_loser_tree_merges_and_keeps_shared_lengths():
    draw = random.Random(2)
    runs = [sorted(bytes(draw.choices(b"ab", k=draw.randrange(0, 12))) for _ in range(draw.randrange(0, 30))) for _ in range(7)]
    coded = [suffix_merge.decoded(*suffix_merge.front_coded(r)) for r in runs]
    assert [r[0] for r in coded] == runs
    out = [(runs[r][i], h) for r, i, h in suffix_merge.merged(coded)]
    assert [s for s, _ in out] == sorted(s for r in runs for s in r)
    for (a, _), (b, h) in zip(out, out[1:]):
        assert h == suffix_merge.shared(a, b, 0)
