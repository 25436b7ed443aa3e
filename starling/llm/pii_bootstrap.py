"""Personal data: stated patterns, and bootstrapped contexts that find more of it.

The base kinds are regular expressions with a check each. Their matches are the seeds. A text
is a row of units: base spans, plain words (letters, with hyphens and apostrophes inside), and
fills, which are all other tokens: runs of numbers joined by blanks, brackets and hyphens, and
tokens of letters with digits or marks inside, also joined by "(at)" and "(dot)". Marks around
a unit, and a label like "tel:" before it, are not part of it. The units around a unit are its
lexical patterns (two to the left, or one to either side). Patterns and identifiers form a
graph: a pattern is trusted by the share of all units it surrounds in the corpus that are
trusted identifiers, an identifier by the patterns it fills. After a stated number of rounds,
fills of a trusted pattern that are trusted identifiers are added as spans, with or without
digits. Plain words count against a pattern, but are never identifiers. Other occurrences of
a found identifier, outside the trusted patterns of its kind, are not added: the same
characters may mean something else there.

DataFrame functions only. What leaves a text are spans and hashes of its contexts, never
the text; graph rows are summed per pattern and identifier before anything is joined, so a
context with a third of all matches is one row. Corpus counts are taken for those patterns
only that could be trusted if no plain word filled them, and that are not too common
already in a part of the texts. Null and empty texts have no spans;
repeated rows have the same spans each; an empty table gives an empty result. Other input
columns are ignored. Positions are code points, ends exclusive. A kind's matches are the
leftmost ones that do not overlap; matches of two kinds may.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.llm import arrays as A
from starling.llm import text as T
from starling.session import broadcast_if_small, scratch

KINDS = ("email", "ip", "card", "phone")
# the stated patterns; loops that cannot give back are possessive, and a match may begin inside a
# run of its first characters only where the one before ended, so that long runs take linear time
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# what a text must contain before a pattern is tried
MUST = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][0-9\x20-]{12,}[0-9]"),
    "phone": lambda t: t.rlike(r"\+[0-9]"),
}
# base spans are written as one HEAD and a BODY per further character before a text is cut into units
HEAD, BODY, OTHER = "\ue000", "\ue001", "\ue002"
_MARKS = r"!#$%&'’()*+./:?@\[\]\\^_`{}~-"  # may stand inside a unit; what is no letter, digit or mark ends it
_IN, _END, _BLANK = rf"[\p{{L}}\p{{M}}\p{{N}}{_MARKS}]", r"[\p{L}\p{M}\p{N}]", r"[\x20\x09]++"
_TAIL = rf"[\p{{L}}\p{{N}}](?:{_IN}*{_END})?"
_DIGITS = rf"[0-9]++(?:[{_MARKS}]*+[0-9]++)*+"
_NO_LETTER = rf"(?![\p{{M}}\p{{N}}{_MARKS}]*+\p{{L}})"
_LINK = r"[(\[{](?i:at|dot)[)\]}]"
_LINKED = rf"[\p{{L}}\p{{N}}]{_IN}*+(?:{_BLANK}{_LINK}{_BLANK}{_TAIL})++"
UNLINKED = "|".join((
    rf"{HEAD}{BODY}*+",
    rf"\p{{L}}[\p{{L}}\p{{M}}]*+(?:['’-]\p{{L}}[\p{{L}}\p{{M}}]*+)*+(?=[:=]|[{_MARKS}]*+(?!{_IN}))",
    rf"{_NO_LETTER}(?:\+?\((?=[0-9][0-9./+-]*+\)[\x20\x09.()/+-]*+[0-9])|\+)?{_DIGITS}(?:\)?{_BLANK}(?:[-/.]{_BLANK})?{_NO_LETTER}[(+]*+{_DIGITS})*+",
    _TAIL,
))
UNIT = f"{_LINKED}|{UNLINKED}"  # the same as UNLINKED in texts that have no link
LISTED = 1000  # patterns that are named in the plan; more are met by a join
PART = 16  # one in so many texts is counted first, to drop patterns that no count of the others can save
NOT_PLAIN = r"[^\p{L}\p{M}'’-]"
SPAN = "struct<kind:string,start:int,end:int,token:string>"
MERGED = "struct<start:int,end:int,kind:string,token:string,reach:int,apart:int,group:int>"


@dataclass(frozen=True)
class Config:
    rounds: int = 3
    support: float = 3.0  # trusted identifiers that a pattern needs
    trust: float = 0.6  # least share of a pattern's units that are trusted identifiers
    accept: float = 0.8  # least trust in an identifier that is added


def _located(text: str, pattern: str, kind: str) -> Column:
    """Matches of a pattern with their places, from the matches and the gaps between them."""
    return F.transform(_measured(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))), lambda x: F.struct(
        F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["token"].alias("token")
    ))


def _measured(gaps: Column, matches: Column) -> Column:
    """``start, end, nr, token`` of the matches that stand between gaps."""
    # one gap more than matches: the last pair has no match
    pairs = F.zip_with(gaps, matches, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"), m.alias("token")))

    def placed(ps: Column) -> Column:
        ends = A.sums_before(F.transform(ps, lambda p: p["gap"] + F.coalesce(p["size"], F.lit(0))))
        found = F.zip_with(ps, ends, lambda p, at: F.struct(
            (at + p["gap"]).alias("start"), (at + p["gap"] + p["size"]).alias("end"), p["token"].alias("token")
        ))
        found = F.filter(found, lambda x: x["token"].isNotNull())
        return F.transform(found, lambda x, i: F.struct(x["start"].alias("start"), x["end"].alias("end"), i.alias("nr"), x["token"].alias("token")))

    return A.let(pairs, placed)


def base_spans(text: str) -> Column:
    """Spans of the base kinds, kind by kind."""
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    found = {kind: F.when(MUST[kind](F.col(text)), _located(text, PATTERNS[kind], kind)).otherwise(none) for kind in KINDS}
    return F.concat(*[F.filter(spans, partial(_checked, kind)) for kind, spans in found.items()])


def _checked(kind: str, span: Column) -> Column:
    token = span["token"]
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(token, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    digits = F.regexp_replace(token, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(10, 15)
    values = F.reverse(F.transform(F.split(digits, ""), lambda d: d.cast("int")))
    doubled = F.transform(values, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.when(F.length(digits).between(14, 19), F.aggregate(doubled, F.lit(0), lambda s, d: s + d) % 10 == 0).otherwise(False)


def _ordered(spans: str) -> Column:
    return F.sort_array(F.transform(F.col(spans), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), x["token"].alias("token"))))


def _merged(order: Column) -> Column:
    """Spans given in order, each with ``reach``, the end of those before it, and ``group``: spans that overlap are one, numbered from 1."""

    def reached(xs: Column) -> Column:
        reach = A.before(F.transform(xs, lambda x: x["end"]), lambda a, b: F.greatest(a, b), F.lit(0))
        return F.zip_with(xs, reach, lambda x, r: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), x["token"].alias("token"),
            r.alias("reach"), (x["start"] >= r).cast("int").alias("apart"),
        ))

    def numbered(xs: Column) -> Column:
        groups = A.sums_before(F.transform(xs, lambda x: x["apart"]))
        return F.zip_with(xs, groups, lambda x, g: F.struct(*(x[c].alias(c) for c in ("start", "end", "kind", "token", "reach", "apart")), (g + x["apart"]).alias("group")))

    return A.let(A.let(order, reached), numbered)


def _rewritten(text: Column, merged: Column, head, more) -> Column:
    """The text with ``head(span)`` for the first of overlapping spans and ``more(span)`` for those it reaches over."""

    def written(pieces: Column) -> Column:
        parts = F.transform(merged, lambda x: F.when(x["apart"] == 1, F.concat(A.cut(pieces, x["reach"], x["start"]), head(x))).otherwise(more(x)))
        last = F.array_max(F.transform(merged, lambda x: x["end"]))
        return F.concat(F.array_join(parts, ""), A.cut(pieces, last, F.length(text)))

    return A.let(A.pieces_of(text), written)


def _masked(text: str, merged: str) -> Column:
    """The text, as long as before, with base spans written as ``HEAD`` and ``BODY``; spans that overlap are one."""
    plain = F.translate(F.col(text), HEAD + BODY, OTHER + OTHER)
    head = lambda x: F.concat(F.lit(HEAD), F.repeat(F.lit(BODY), x["end"] - x["start"] - 1))
    more = lambda x: F.repeat(F.lit(BODY), F.greatest(x["end"] - x["reach"], F.lit(0)))
    return F.when(F.size(merged) > 0, _rewritten(plain, F.col(merged), head, more)).otherwise(plain)


def _units(documents: DataFrame, *kept: str) -> DataFrame:
    """``kept, text, base, merged, masked, units, words`` of each text: ``words`` are the units as contexts name them."""
    text = T.text_or_empty()
    source = documents.select(*kept, text.alias("text"), (text.contains("@") | text.rlike("[0-9]")).alias("any"))
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    some = source.select(*kept, "text", F.when(F.col("any"), base_spans("text")).otherwise(none).alias("base"))
    some = some.select(*kept, "text", "base", F.when(F.size("base") > 0, _merged(_ordered("base"))).otherwise(F.expr(f"cast(array() as array<{MERGED}>)")).alias("merged"))
    some = some.select(*kept, "text", "base", "merged", _masked("text", "merged").alias("masked"))
    units = lambda pattern: F.regexp_extract_all("masked", F.lit(pattern), F.lit(0))
    units = F.when(F.col("masked").rlike(_LINK), units(UNIT)).otherwise(units(UNLINKED))
    some = some.select(*kept, "text", "base", "merged", "masked", units.alias("units"))
    return some.select("*", F.transform("units", lambda u: F.when(u.startswith(HEAD), HEAD).otherwise(F.lower(u))).alias("words"))


def _places() -> Column:
    """Places of the units, base spans included, with their numbers."""
    gaps = F.when(F.col("masked").rlike(_LINK), F.split("masked", UNIT, -1)).otherwise(F.split("masked", UNLINKED, -1))
    return _measured(gaps, F.col("units"))


def _with_contexts(nr: Column, kind: Column, token: Column) -> Column:
    """``kind, nr, item`` and the hashes of both patterns around unit ``nr``; null without units there."""
    two, one, after = (F.get("words", nr + i) for i in (-2, -1, 1))
    return F.struct(
        kind.alias("kind"), nr.alias("nr"), F.xxhash64(F.lower(token)).alias("item"),
        F.when(two.isNotNull(), F.xxhash64(F.lit(0), two, one)).alias("before"),
        F.when(one.isNotNull() & after.isNotNull(), F.xxhash64(F.lit(1), one, after)).alias("around"),
    )


def _key(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("a"), F.md5(text).alias("b"))


def spans_of(documents: DataFrame) -> DataFrame:
    """``doc_id, key, base, seeds, tokens``: base spans, their contexts, and fills outside them with contexts.

    ``key`` stands for the text; it is null where there are neither.
    """
    numbers = F.expr("if(size(units) > 0, sequence(0, size(units) - 1), cast(array() as array<int>))")
    some = _units(documents, "doc_id").select("*", F.filter(numbers, lambda i: F.get("units", i).rlike(NOT_PLAIN)).alias("odd"))
    heads, fills = (F.filter("odd", lambda i: F.get("units", i).startswith(HEAD) == is_head) for is_head in (True, False))
    # spans that overlap are one unit, and the units of spans come in their order
    some = some.select("doc_id", "text", "base", "merged", "units", "words", "odd", heads.alias("heads"), fills.alias("fills"))
    seeds = F.transform("merged", lambda x: _with_contexts(F.get("heads", x["group"] - 1), x["kind"], x["token"]))
    tokens = F.transform("fills", lambda i: _with_contexts(i, F.lit("token"), F.get("units", i)))
    base = F.transform("base", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return some.select(
        "doc_id", F.when(F.size("odd") > 0, _key(F.col("text"))).alias("key"), base.alias("base"), seeds.alias("seeds"), tokens.alias("tokens")
    )


def _placed(documents: DataFrame, best: DataFrame) -> DataFrame:
    """``key, added``: the places of the units ``best(key, nr, kind)``, a written table, from the texts that hold one."""
    wanted = best.select("key").distinct()
    texts = documents.select(_key(T.text_or_empty()).alias("key"), "text").join(broadcast_if_small(wanted, best), "key")
    # the outer form: from the plain one the optimizer infers a filter that computes all units again, per unit
    places = _units(texts, "key").select("key", _places().alias("places")).select("key", F.explode_outer("places").alias("p"))
    places = places.select("key", "p.nr", "p.start", "p.end").join(broadcast_if_small(best, best), ["key", "nr"])
    return places.groupBy("key").agg(F.collect_set(F.struct("kind", "start", "end")).alias("added"))


def pattern_fills(documents: DataFrame, patterns: DataFrame) -> DataFrame:
    """How many units each of ``patterns(pattern)`` surrounds in all texts, whatever they are: ``pattern, total``."""
    listed = _units(documents).select("words").select(
        F.when(
            F.size("words") > 2,
            F.expr("flatten(transform(sequence(0, size(words) - 3), i -> array(xxhash64(0, words[i], words[i + 1]), xxhash64(1, words[i], words[i + 2]))))"),
        ).alias("hashes")
    )
    listed_patterns = [r[0] for r in patterns.select("pattern").distinct().limit(LISTED + 1).collect()]
    if not listed_patterns:
        return patterns.select("pattern", F.lit(0).cast("long").alias("total")).limit(0)
    if len(listed_patterns) <= LISTED:
        # few patterns are looked for inside the arrays: no row for any other unit
        found = listed.select(F.filter("hashes", lambda h: h.isin(listed_patterns)).alias("hashes"))
        return found.select(F.explode_outer("hashes").alias("pattern")).filter("pattern IS NOT NULL").groupBy("pattern").agg(F.count("*").alias("total"))
    # the outer form: the plain one lets the optimizer compute the hashes twice
    every = listed.select(F.explode_outer("hashes").alias("pattern"))
    return every.join(broadcast_if_small(patterns, patterns), "pattern").groupBy("pattern").agg(F.count("*").alias("total"))


def _possible(pairs: DataFrame, seeds: DataFrame, config: Config, keep) -> DataFrame:
    """Patterns that could be trusted after all rounds if every identifier within reach were, and no plain word filled them."""
    held = keep(pairs.groupBy("pattern").agg(F.sum("n").alias("held")))
    reached, found = seeds.select("item", "kind"), None
    for _ in range(config.rounds):
        scored = keep(
            pairs.join(broadcast_if_small(reached, reached), "item").groupBy("pattern", "kind")
            .agg(F.count("*").alias("support"), F.sum("n").alias("weight")).filter(F.col("support") >= config.support)
        )
        found = held.join(broadcast_if_small(scored, scored), "pattern").filter(F.col("weight") >= config.trust * F.col("held"))
        found = keep(found.select("pattern", "kind"))
        more = pairs.join(broadcast_if_small(found, found), "pattern").select("item", "kind")
        reached = keep(seeds.select("item", "kind").unionByName(more).distinct())
    return found.select("pattern").distinct()


def trusted(documents: DataFrame, spans: DataFrame, keep, config: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """Trusted patterns ``(pattern, kind)`` and identifiers ``(item, kind, trust)`` not among the seeds; ``keep`` writes a table."""
    seen = lambda name: spans.filter("key is not null").select(F.explode_outer(name).alias("x")).filter("x is not null")
    both = seen("seeds").select("x.*").unionByName(seen("tokens").select("x.*"))
    edges = both.select("kind", "item", F.explode_outer(F.array("before", "around")).alias("pattern")).filter("pattern is not null")
    edges = keep(edges.groupBy("kind", "item", "pattern").agg(F.count("*").alias("n")))
    seeds = edges.filter("kind <> 'token'").select("item", "kind").distinct().withColumn("trust", F.lit(1.0))
    seeds = keep(seeds)
    pairs = keep(edges.groupBy("item", "pattern").agg(F.sum("n").alias("n")))
    patterns = keep(_possible(pairs, seeds, config, keep))
    # counts in a part of the texts bound those in all from below: most chance contexts are too common already there
    held = pairs.groupBy("pattern").agg(F.sum("n").alias("held"))
    part = documents.filter(F.pmod(F.xxhash64(T.text_or_empty()), F.lit(PART)) == 0)
    seen = keep(pattern_fills(part, patterns))
    patterns = patterns.join(held, "pattern").join(seen, "pattern", "left")
    patterns = keep(patterns.filter(F.coalesce("total", F.lit(0)) * config.trust <= F.col("held")).select("pattern"))
    fills = keep(pattern_fills(documents, patterns))
    pairs = keep(pairs.join(broadcast_if_small(patterns, patterns), "pattern"))
    items, chosen = seeds, None
    for _ in range(config.rounds):
        scored = pairs.join(items, "item").groupBy("pattern", "kind").agg(
            F.sum("trust").alias("support"), F.sum(F.col("trust") * F.col("n")).alias("weight")
        ).join(fills, "pattern")
        share = F.least(F.col("weight") / F.col("total"), F.lit(1.0)) * F.col("support") / (F.col("support") + 0.1)
        chosen = keep(
            scored.withColumn("share", share).filter((F.col("support") >= config.support) & (F.col("share") >= config.trust)).select("pattern", "kind", "share")
        )
        doubt = F.sum(F.log1p(-F.least("share", F.lit(0.999))))
        fresh = pairs.join(chosen, "pattern").groupBy("item", "kind").agg((1 - F.exp(doubt)).alias("trust"))
        fresh = fresh.join(seeds.select("item").distinct(), "item", "left_anti")
        items = keep(seeds.unionByName(fresh))
    return chosen, items.join(seeds.select("item").distinct(), "item", "left_anti")


def found_spans(documents: DataFrame, keep, config: Config = Config()) -> DataFrame:
    """``doc_id, key, base, added`` for every row; ``added`` are the spans that trusted contexts found."""
    spans = keep(spans_of(documents))
    patterns, items = trusted(documents, spans, keep, config)
    tokens = spans.filter("key is not null").select("key", F.explode_outer("tokens").alias("x")).filter("x is not null")
    tokens = tokens.select("key", "x.nr", "x.item", F.explode_outer(F.array("x.before", "x.around")).alias("pattern"))
    good = items.filter(F.col("trust") >= config.accept)
    hits = tokens.join(broadcast_if_small(good, good), "item").join(broadcast_if_small(patterns.select("pattern", "kind"), patterns), ["pattern", "kind"])
    best = keep(hits.groupBy("key", "nr").agg(F.min_by("kind", F.struct(-F.col("trust"), F.col("kind"))).alias("kind")))
    added = keep(_placed(documents, best))
    columns = ["doc_id", "key", "base", "added"]
    # texts without spans have no key: they stay out of the join, where they would be one group
    plain = spans.filter("key is null").withColumn("added", F.lit(None).cast("array<struct<kind:string,start:int,end:int>>"))
    both = spans.filter("key is not null").join(broadcast_if_small(added, added), "key", "left")
    return both.select(*columns).unionByName(plain.select(*columns))


def listed(*spans: str) -> Column:
    """Spans sorted by start, then kind as listed."""
    order = lambda x: F.struct(
        x["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]).alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")
    )
    none = F.expr("cast(array() as array<struct<start:int,rank:bigint,end:int,kind:string>>)")
    return F.array_sort(F.concat(*[F.coalesce(F.transform(F.col(s), order), none) for s in spans]))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def personal_data(documents: DataFrame, config: Config = Config()) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text, per row."""
    count = lambda k: F.coalesce(F.size(F.filter("base", lambda x: x["kind"] == k)), F.lit(0))
    with scratch(documents.sparkSession) as keep:
        found = found_spans(documents, keep, config)
        # size of a null array is not null in every setting: rows without a key have none
        return T.staged(found.select(
            "doc_id",
            *[F.when(F.col("key").isNull(), 0).otherwise(count(k)).cast("long").alias(f"n_{k}") for k in KINDS],
            F.sha2(written(listed("base")), 256).alias("base_sha256"),
            written(listed("base", "added")).alias("spans"),
        ), "spans")


def redact(documents: DataFrame, config: Config = Config()) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; ``n_chars`` follows if there is such a column."""
    with scratch(documents.sparkSession) as keep:
        found = found_spans(documents, keep, config).filter("key is not null")
        marks = F.transform(listed("base", "added"), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), x["kind"].alias("token")))
        marks = found.select("key", marks.alias("marks")).filter(F.size("marks") > 0).groupBy("key").agg(F.first("marks").alias("marks"))
        marks = T.staged(marks.select("key", _merged(F.col("marks")).alias("merged")), "marks")
    marks = marks.select(F.col("key").alias(T.unused("key", documents)), F.col("merged").alias(T.unused("merged", documents)))
    key, merged = marks.columns
    text = F.coalesce(documents["text"], F.lit(""))
    joined = documents.join(broadcast_if_small(marks, marks), _key(text) == marks[key], "left")
    head, more = lambda x: F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")), lambda x: F.lit("")
    new = T.unused("new", documents, marks)
    joined = joined.withColumn(new, F.when(F.col(merged).isNotNull(), _rewritten(F.col("text"), F.col(merged), head, more)).otherwise(F.col("text")))
    columns = [
        F.col(new).alias(c) if c == "text" else F.length(new).cast(documents.schema[c].dataType).alias(c) if c == "n_chars" else F.col(T.quoted(c))
        for c in documents.columns
    ]
    return joined.select(*columns)
