"""Bootstrapped personal data against plain dictionaries, and very long texts."""

from __future__ import annotations

import collections
import math
import random

import regex
from pyspark.sql import functions as F
from test_contracts import PATTERNS, base_spans

from starling.llm import arrays, pii_bootstrap
from starling.llm.pii_bootstrap import BODY, HEAD, KINDS, NOT_PLAIN, UNIT, UNLINKED, Config


def cut_into_units(text):
    """Units (start, end, word) and, per base span, its kind, token and unit."""
    spans = sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in base_spans(text).split(",") if x))
    masked, groups, reach = list(text), [], 0
    for start, end, kind in spans:
        if start >= reach:
            groups.append([])
            masked[start] = HEAD
            masked[start + 1 : end] = BODY * (end - start - 1)
        else:
            masked[reach:end] = BODY * max(0, end - reach)
        reach = max(reach, end)
        groups[-1].append((kind, text[start:end]))
    masked = "".join(masked)
    linked = regex.search(pii_bootstrap._LINK, masked)
    units = [(m.start(), m.end(), HEAD if m.group().startswith(HEAD) else m.group().lower()) for m in regex.finditer(UNIT if linked else UNLINKED, masked)]
    heads = [n for n, u in enumerate(units) if u[2] == HEAD]
    return units, [(kind, token.lower(), n) for n, group in zip(heads, groups) for kind, token in group]


def bootstrapped(texts, config=Config()):
    """All spans of every text, base and found, by counting in dictionaries."""
    cut = [cut_into_units(t) for t in texts]

    def contexts(units, n):
        words = [u[2] for u in units]
        found = [("before", words[n - 2], words[n - 1])] if n >= 2 else []
        return found + ([("around", words[n - 1], words[n + 1])] if 1 <= n < len(words) - 1 else [])

    pairs, totals, tokens, seeds = collections.Counter(), collections.Counter(), [], {}
    for number, (units, known) in enumerate(cut):
        for kind, item, n in known:
            seeds[item, kind] = 1.0
            pairs.update((item, c) for c in contexts(units, n))
        for n, (_, _, word) in enumerate(units):
            if word != HEAD and regex.search(NOT_PLAIN, word):
                tokens.append((number, n, word))
                pairs.update((word, c) for c in contexts(units, n))
        words = [u[2] for u in units]
        for i in range(len(words) - 2):
            totals[("before", words[i], words[i + 1])] += 1
            totals[("around", words[i], words[i + 2])] += 1
    # an identifier without any context is no seed of the graph
    seeds = {k: v for k, v in seeds.items() if any(item == k[0] for item, _ in pairs)}
    seed_items, items, chosen = {i for i, _ in seeds}, dict(seeds), {}
    kinds_of = lambda table: [(i, k, t) for (i, k), t in table.items()]
    for _ in range(config.rounds):
        support, weight, by_item = collections.Counter(), collections.Counter(), collections.defaultdict(list)
        for item, kind, trust in kinds_of(items):
            by_item[item].append((kind, trust))
        for (item, pattern), n in pairs.items():
            for kind, trust in by_item[item]:
                support[pattern, kind] += trust
                weight[pattern, kind] += trust * n
        chosen = {}
        for (pattern, kind), s in support.items():
            if totals[pattern]:
                share = min(weight[pattern, kind] / totals[pattern], 1.0) * s / (s + 0.1)
                if s >= config.support and share >= config.trust:
                    chosen[pattern, kind] = share
        doubt = collections.Counter()
        for (item, pattern), _ in pairs.items():
            for kind in KINDS:
                if item not in seed_items and (pattern, kind) in chosen:
                    doubt[item, kind] += math.log1p(-min(chosen[pattern, kind], 0.999))
        items = {**seeds, **{k: 1 - math.exp(d) for k, d in doubt.items()}}
    out = []
    for number, text in enumerate(texts):
        out.append([(int(s), KINDS.index(k), int(e), k) for k, s, e in (x.split(":") for x in base_spans(text).split(",") if x)])
    added = 0
    for number, n, word in tokens:
        units = cut[number][0]
        ways = [(-items[word, k], k) for k in KINDS if word not in seed_items and items.get((word, k), 0) >= config.accept
                and any((c, k) in chosen for c in contexts(units, n))]
        if ways:
            kind, added = min(ways)[1], added + 1
            out[number].append((units[n][0], KINDS.index(kind), units[n][1], kind))
    return [",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(x)) for x in out], added


def built_texts(seed):
    pick, texts = random.Random(seed), []
    fill = lambda: " ".join(pick.choices(["lorem", "ipsum", "dolor", "😀", "it's", "x-y", "tel:", "(2024)", "v2.0", "now", "42"], k=pick.randint(1, 9)))
    for _ in range(300):
        parts = []
        for _ in range(pick.randint(1, 25)):
            mail, line = f"write to u{pick.randint(0, 99)}@mail{pick.randint(0, 5)}.com now", f"call me +1 ({pick.randint(200, 999)}) 555-{pick.randint(1000, 9999)} today é"
            host = f"up host 10.0.{pick.randint(0, 255)}.{pick.randint(0, 255)} is"
            parts.append(pick.choice([
                mail, mail, mail, line, line, line, host, host, host, f"write to u{pick.randint(0, 50)}(at)mail.com now",
                f"call me ({pick.randint(200, 999)}) 555 {pick.randint(1000, 9999)} today",
                f"up host srv-{pick.randint(0, 50)} is", f"call me {pick.choice(['later', 'maybe', 'x9'])} today",
                "a@b.cd@e.f 1.2.3.4@x.yz card 4111 1111 1111 1111 \n", fill(), fill(), fill(),
            ]))
        texts.append(" ".join(parts))
    return texts


def test_bootstrapping_matches_dictionaries(make, monkeypatch):
    for seed, listed in ((3, 1000), (4, 2)):  # patterns named in the plan, and met by a join
        monkeypatch.setattr(pii_bootstrap, "LISTED", listed)
        texts = built_texts(seed)
        expected, added = bootstrapped(texts)
        got = {r["doc_id"]: r["spans"] for r in pii_bootstrap.personal_data(make(list(enumerate(texts)))).collect()}
        assert added > 100 and [got[i] for i in range(len(texts))] == expected


def test_a_very_long_text_takes_time_in_proportion(make):
    """20,000 spans in one text; a step that looks at all spans for each would take minutes."""
    count = 20_000
    text = " ".join(f"write to ü{i}x u{i}@mail.com now" for i in range(count))
    rows = [(1, text), (2, None), (3, "plain")]
    found = pii_bootstrap.personal_data(make(rows)).filter("doc_id = 1").first()
    assert found["n_email"] == count and found["spans"].startswith(base_spans(text)[:200]) and set(base_spans(text).split(",")) <= set(found["spans"].split(","))
    clean = {r["doc_id"]: r["text"] for r in pii_bootstrap.redact(make(rows)).collect()}
    assert clean[1].count("[EMAIL]") >= count and "@" not in clean[1] and clean[2] is None and clean[3] == "plain"


def test_redaction_carries_columns_named_like_its_own(spark):
    docs = spark.createDataFrame([(1, "to a@b.cd 😀 or 1.2.3.4, x@y.zz@q.r end", "k", "m", "n", 7)], "doc_id long, text string, key string, merged string, new string, n_chars int")
    row = pii_bootstrap.redact(docs).first().asDict()
    assert row == {"doc_id": 1, "text": "to [EMAIL] 😀 or [IP], [EMAIL]@q.r end", "key": "k", "merged": "m", "new": "n", "n_chars": len(row["text"])}


def test_sums_and_cuts_of_long_arrays_and_texts(spark):
    sizes = (0, 1, 63, 64, 65, 4096, 4097, 70_000)
    for n in sizes:
        values = [(i * 37) % 11 for i in range(n)]
        df = spark.createDataFrame([(values, "aé😀\n"[: n % 4] * 1 + "é😀x\n" * (n // 4))], "v array<int>, t string")
        got = df.select(arrays.sums_before(F.col("v")).alias("s"), arrays.before(F.col("v"), lambda a, b: F.greatest(a, b), F.lit(0)).alias("m")).first()
        total, top, sums, tops = 0, 0, [], []
        for v in values:
            sums.append(total)
            tops.append(top)
            total, top = total + v, max(top, v)
        assert got["s"] == sums and got["m"] == tops
        text = df.first()["t"]
        for a, b in ((0, len(text)), (0, 0), (len(text) // 3, len(text) // 2), (max(0, len(text) - 1), len(text)), (255, 257), (256, 512)):
            if a <= b <= len(text):
                assert df.select(arrays.cut(arrays.pieces_of(F.col("t")), F.lit(a), F.lit(b)).alias("c")).first()["c"] == text[a:b]


assert set(PATTERNS) == set(KINDS)
