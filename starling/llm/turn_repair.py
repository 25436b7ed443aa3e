"""Repair of conversation structure: depth-first branch and bound over edits of the turns.

A repaired conversation has the roles ``(system? (user assistant)+)?`` by their initials.
Edits of a row: Keep costs 0, Rerole to user or assistant 2, Delete 3; before any row, and at
the end, a turn of empty text may be Inserted for 2. Blank rows and repeats of an earlier
row must be deleted; a truncated row that stays adds 1. Wanted is the cheapest sequence of
edits and among those the one whose initials (the audit) are ASCII-least.

The search keeps an explicit stack of prefixes (rows read, state, cost, audit). A prefix is
cut if its cost and a lower bound of the rows that follow exceed the incumbent (cost,
audit), or tie with it and its audit is greater; a table holds the best prefix met at each
(rows read, state) and cuts those it dominates. The bound is the cheapest repair of the
rows that follow, where any number of system turns may open the conversation. When the stack
is empty, the incumbent is proved optimal.

A conversation is searched as one, up to ``Config.rows`` rows and ``Config.bytes`` of text.
Longer ones are cut into segments: the same search gives, for each state before and after
a segment, the best edits between; these are folded in the order of the segments. Costs add
up and no audit is a prefix of another of the same cost, so this finds the same edits. Turns
are numbered and compared by Spark then; what remains sequential is the fold (a few rows per
segment) and the digest of the repaired text, both of which read a sorted stream.

Order: by turn, nulls first, then role and text. Null roles and texts count as one space; a null
conversation id is a conversation. Empty and very long texts are texts like others. Repeated
rows are duplicates, other columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.llm import text as T
from starling.llm.places import ranked
from starling.session import broadcast_if_small, scratch

SPACES = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
# states: nothing kept, a system turn, then a user turn, then an assistant turn
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT_ROLE = {NOTHING: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
NEXT_STATE = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LEGAL = {"su", "ua", "au"}
FAR = 1 << 60
SHORT = 64  # rows of conversations whose searches are remembered


@dataclass(frozen=True)
class Config:
    rows: int = 8192  # of a conversation that one search takes
    bytes: int = 1 << 26
    segment: int = 512  # rows of a segment of a longer one


# A row's code: x where it must go, else the initial of its role (o: any other), upper case if truncated.


def _bounds(codes: str, goals: frozenset[int], closing: bool) -> tuple[list[int], list[int], list[int]]:
    """Lower bounds of the cost of rows i and on: from the start, and where a user or an assistant turn is due.

    ``closing``: turns may be inserted after the last row.
    """
    n = len(codes)
    start, user, assistant = [FAR] * (n + 1), [FAR] * (n + 1), [FAR] * (n + 1)
    user[n] = 0 if ASSISTANT in goals else FAR
    assistant[n] = 0 if USER in goals else FAR
    if closing:
        assistant[n] = min(assistant[n], INSERT + user[n])
        user[n] = min(user[n], INSERT + assistant[n])
    start[n] = 0 if goals & {NOTHING, SYSTEM} else INSERT + assistant[n] if closing else FAR
    for i in range(n - 1, -1, -1):
        code = codes[i]
        u, a, s = DELETE + user[i + 1], DELETE + assistant[i + 1], DELETE + start[i + 1]
        if code != "x":
            role, cut = code.lower(), CUT * code.isupper()
            opened = cut + REROLE * (role != "u") + assistant[i + 1]
            u, s = min(u, opened), min(s, opened)
            a = min(a, cut + REROLE * (role != "a") + user[i + 1])
            if role == "s":
                s = min(s, cut + start[i + 1])
        user[i], assistant[i], start[i] = min(u, INSERT + a), min(a, INSERT + u), min(s, INSERT + a)
    return start, user, assistant


def search(codes: str, entry: int = NOTHING, goals: frozenset[int] = frozenset({NOTHING, ASSISTANT}), closing: bool = True) -> tuple[int, str] | None:
    """The least (cost, audit) from state ``entry`` over all rows to a state among ``goals``; None if there is none."""
    n, last = len(codes), max(goals)
    start, user, assistant = _bounds(codes, goals, closing)
    bound = {NOTHING: start, SYSTEM: start, USER: assistant, ASSISTANT: user}
    best: tuple[int, str] | None = None
    seen: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        low = cost + bound[state][i]
        if low >= FAR or best and (low > best[0] or low == best[0] and audit > best[1][: len(audit)]):
            continue
        known = seen.get((i, state))
        if known and known <= (cost, audit):
            continue
        seen[i, state] = (cost, audit)
        if i == n and state in goals:
            if best is None or (cost, audit) < best:
                best = (cost, audit)
            continue
        branches = []
        following = NEXT_STATE[state]
        if i < n:
            code = codes[i]
            branches.append((DELETE, "D", i + 1, state))
            if code != "x":
                role, cut = code.lower(), CUT * code.isupper()
                if role == "s" and state == NOTHING:
                    branches.append((cut, "K", i + 1, SYSTEM))
                if role == NEXT_ROLE[state][0]:
                    branches.append((cut, "K", i + 1, following))
                else:
                    branches.append((REROLE + cut, "R", i + 1, following))
        if i < n or closing:
            branches.append((INSERT, "I", i, following))
        ways = [
            (cost + price + bound[after][j], letter, j, after, cost + price)
            for price, letter, j, after in branches
            if after <= last or last >= USER
        ]
        for _, letter, j, after, spent in sorted(ways, reverse=True):  # the most promising comes off the stack first
            stack.append((j, after, spent, audit + letter))
    return best


@functools.lru_cache(maxsize=1 << 16)
def _remembered(codes: str) -> tuple[int, str]:
    return search(codes)


def repaired(rows: list[tuple[str, str]], codes: str, audit: str, state: int = NOTHING) -> tuple[list[tuple[str, str, str]], int]:
    """``(edit, role, text)`` of the turns that an audit leaves, and the state after them."""
    out, i = [], 0
    for letter in audit:
        if letter != "D":
            role, text = rows[i] if letter != "I" else ("", "")
            out.append((letter, role if letter == "K" else NEXT_ROLE[state], text))
            state = SYSTEM if letter == "K" and codes[i] in "sS" else NEXT_STATE[state]
        i += letter != "I"
    return out, state


# rows as Spark sees them


def _turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, blank, cut``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    end = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    return rows.withColumns({"blank": end == "", "cut": ~end.isin("", ".", "!", "?")})


def _initial(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else "o"


def _code(role: str, gone: bool, cut: bool) -> str:
    return "x" if gone else _initial(role).upper() if cut else _initial(role)


FINDINGS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
TURNS = "line long, edit string, role string, text string"


def _pairs(initials: str) -> int:
    return sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1))


def _repair_one(rows: list[tuple]) -> tuple[tuple, list[tuple[str, str, str]]]:
    """Findings and repaired turns of the rows ``(turn, role, text, blank, cut)`` of one conversation."""
    seen, codes, blank, duplicate, truncated = set(), [], 0, 0, 0
    for _, role, text, empty, cut in rows:
        again = (role, text) in seen
        seen.add((role, text))
        blank += empty
        duplicate += again and not empty
        truncated += cut and not again and not empty
        codes.append(_code(role, empty or again, cut))
    codes = "".join(codes)
    cost, audit = (_remembered if len(codes) <= SHORT else search)(codes)
    known = {t for t, *_ in rows if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    illegal = _pairs("".join(_initial(r[1]) for r in rows))
    kept, _ = repaired([(r[1], r[2]) for r in rows], codes, audit)
    return (gaps, blank, duplicate, truncated, illegal, cost, audit), kept


def _digest(turns: list[tuple[str, str, str]]) -> str:
    return hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in turns).encode()).hexdigest()


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Runs of rows with the same first column in a sorted stream: the value and the rows' other columns."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    for key, run in itertools.groupby(rows, key=lambda r: r[0]):
        yield key, (r[1:] for r in run)


def _written(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded length and text."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= size or weight >= T.SLICE_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _sorted_map(rows: DataFrame, by: list[str], fields: str, work: Callable[[object, Iterator[tuple]], Iterator[tuple]]) -> DataFrame:
    """``work`` over each conversation's rows as a stream; the rows of one task are sorted, not collected.

    ``fields`` names and types the columns of the result after the conversation's id.
    """
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    named = [(name, kinds[kind]) for name, kind in (f.split() for f in fields.split(","))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            schema = pa.schema([first.schema.field(0), *named])
            yield from _written((r for key, group in _streamed(itertools.chain([first], batches)) for r in work(key, group)), schema)

    order = [F.col(c).asc_nulls_first() for c in by]
    return rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, f"{_key(rows)}, {fields}")


def _parts(conversations: DataFrame, config: Config, keep) -> tuple[DataFrame, DataFrame | None]:
    """Turns of conversations that one search takes, and of longer ones if there are any."""
    turns = _turns(conversations)
    sizes = turns.groupBy(F.col("conv_id").alias("_c")).agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b"))
    long = keep(sizes.filter((F.col("n") > config.rows) | (F.col("b") > config.bytes)).select("_c"))
    if long.isEmpty():
        return turns, None
    same, side = F.col("conv_id").eqNullSafe(F.col("_c")), broadcast_if_small(long, long)
    return turns.join(side, same, "left_anti"), turns.join(side, same, "left_semi")


def _key(conversations: DataFrame) -> str:
    return f"conv_id {conversations.schema['conv_id'].dataType.simpleString()}"


def findings(conversations: DataFrame, config: Config = Config()) -> DataFrame:
    """One row per conversation: faults found, cost and audit of its repair, digest of the repaired text.

    Columns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.
    """
    with scratch(conversations.sparkSession) as keep:
        short, long = _parts(conversations, config, keep)

        def work(key, rows):
            found, kept = _repair_one(list(rows))
            yield key, *found, _digest(kept)

        out = _sorted_map(short, ["conv_id", "turn", "role", "text"], f"{FINDINGS}, repaired_sha256 string", work)
        if long is not None:
            found, lines = _long(long, config, keep)
            digests = _sorted_map(lines.select("conv_id", "line", "role", "text"), ["conv_id", "line"], "sha string", _stream_digest)
            digests = digests.withColumnRenamed("conv_id", "_c")
            found = found.join(digests, F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c")
            out = out.unionByName(found.withColumn("repaired_sha256", F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256))).drop("sha"))
        return T.staged(out, "repairs")


def turns(conversations: DataFrame, config: Config = Config()) -> DataFrame:
    """The repaired turns ``conv_id, line, edit, role, text``, in the order of ``line``."""
    with scratch(conversations.sparkSession) as keep:
        short, long = _parts(conversations, config, keep)

        def work(key, rows):
            for line, turn in enumerate(_repair_one(list(rows))[1]):
                yield key, line, *turn

        out = _sorted_map(short, ["conv_id", "turn", "role", "text"], TURNS, work)
        if long is not None:
            out = out.unionByName(_long(long, config, keep)[1])
        return T.staged(out, "turns")


def _stream_digest(key, rows: Iterator[tuple]) -> Iterator[tuple]:
    digest, first = hashlib.sha256(), True
    for _, role, text in rows:
        digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
        first = False
    yield key, digest.hexdigest()


# long conversations


def between(codes: str, closing: bool) -> dict[tuple[int, int], tuple[int, str]]:
    """The best edits of a segment for each state before and after it; of the last segment, up to an end."""
    goals = [frozenset({NOTHING, ASSISTANT})] if closing else [frozenset({s}) for s in range(4)]
    found = {(entry, max(g)): search(codes, entry, g, closing) for entry in range(4) for g in goals}
    return {k: v for k, v in found.items() if v}


def fold(segments: Iterator[tuple[int, dict[tuple[int, int], tuple[int, str]]]]) -> tuple[int, list[tuple[int, int, str]]]:
    """Cost of the whole and, per segment, its number, the state before it and its edits.

    Prefixes that end in different states are told apart by cost and by the rank of their audits.
    """
    ends = {NOTHING: (0, 0)}  # state: cost, rank of the audit so far
    back: list[tuple[int, dict[int, tuple[int, str]]]] = []
    for number, ways in segments:
        best: dict[int, tuple[int, int, str, int]] = {}
        for (entry, after), (cost, audit) in ways.items():
            if entry in ends:
                way = (ends[entry][0] + cost, ends[entry][1], audit, entry)
                if after not in best or way < best[after]:
                    best[after] = way
        ranks = {s: r for r, s in enumerate(sorted(best, key=lambda s: best[s][1:3]))}
        ends = {s: (best[s][0], ranks[s]) for s in best}
        back.append((number, {s: (w[3], w[2]) for s, w in best.items()}))
    state = min(ends, key=ends.get)
    cost, chosen = ends[state][0], []
    for number, ways in reversed(back):
        entry, audit = ways[state]
        chosen.append((number, entry, audit))
        state = entry
    return cost, chosen[::-1]


def _long(turns: DataFrame, config: Config, keep) -> tuple[DataFrame, DataFrame]:
    """Findings without digest, and repaired turns, of conversations cut into segments."""
    numbered = keep(turns.withColumn("number", F.monotonically_increasing_id()))
    placed = ranked(numbered, "conv_id", ["turn", "role", "text", "number"], keep).drop("number")
    first = placed.groupBy("conv_id", "role", F.sha2("text", 256).alias("sha")).agg(F.min("place").alias("_p")).select(F.col("conv_id").alias("_c"), "_p")
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("place") == F.col("_p"))
    placed = placed.join(first, same, "left").withColumn("again", F.col("_p").isNull()).drop("_c", "_p")
    initial = F.left("role", F.lit(1))
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    gone = F.col("blank") | F.col("again")
    code = F.when(gone, "x").when(F.col("cut"), F.upper(initial)).otherwise(initial)
    rows = keep(placed.withColumns({"segment": F.floor(F.col("place") / config.segment).cast("long"), "initial": initial, "code": code, "gone": gone}))
    text_of = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", c))), lambda x: x[c]), "")
    parts = rows.groupBy("conv_id", "segment").agg(
        text_of("code").alias("codes"), text_of("initial").alias("initials"),
        F.sum(F.col("blank").cast("long")).alias("blank"), F.sum((F.col("again") & ~F.col("blank")).cast("long")).alias("duplicate"),
        F.sum((F.col("cut") & ~gone).cast("long")).alias("truncated"),
    )
    ends = rows.groupBy(F.col("conv_id").alias("_c")).agg(F.max("segment").alias("end"))
    parts = keep(parts.join(broadcast_if_small(ends, rows), F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c"))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ways = []
            for number, codes, end in zip(*(batch.column(c).to_pylist() for c in ("segment", "codes", "end"))):
                ways.append([{"entry": e, "after": a, "cost": c, "audit": t} for (e, a), (c, t) in between(codes, number == end).items()])
            kind = pa.list_(pa.struct([("entry", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("segment"), pa.array(ways, kind)], ["conv_id", "segment", "ways"])

    ways = keep(
        parts.select("conv_id", "segment", "codes", "end").repartition(T.partitions(turns.sparkSession), "conv_id", "segment")
        .mapInArrow(searched, f"{_key(turns)}, segment long, ways array<struct<entry int, after int, cost long, audit string>>")
    )

    def folded(conversation, segments):
        cost, chosen = fold((n, {(w["entry"], w["after"]): (w["cost"], w["audit"]) for w in ws}) for n, ws in segments)
        line = 0
        for number, entry, audit in chosen:
            yield conversation, number, entry, line, cost, audit
            line += len(audit) - audit.count("D")

    chosen = keep(_sorted_map(ways, ["conv_id", "segment"], "segment long, entry int, line long, cost long, audit string", folded))
    lines = _lines(rows, chosen, parts, config)
    return _found(rows, parts, chosen), lines


def _found(rows: DataFrame, parts: DataFrame, chosen: DataFrame) -> DataFrame:
    """Findings of long conversations from their segments."""
    spans = rows.groupBy(F.col("conv_id").alias("_c")).agg((F.max("turn") - F.min("turn") + 1).alias("span"))
    # distinct turns as counts per turn: a turn may hold any number of rows
    distinct = rows.filter("turn is not null").groupBy("conv_id", "turn").agg(F.lit(1).alias("one"))
    distinct = distinct.groupBy(F.col("conv_id").alias("_d")).agg(F.count("*").alias("known"))
    pair = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length("initials") - 1, F.lit(1))), lambda i: F.substring("initials", i, F.lit(2))
    )
    inside = F.size(F.filter(pair, lambda p: (F.length(p) == 2) & ~p.isin(*LEGAL)))
    # the last turn of a segment and the first of the next
    borders = parts.select("conv_id", F.col("segment").alias("at"), F.left("initials", F.lit(1)).alias("initial")).unionByName(
        parts.select("conv_id", (F.col("segment") + 1).alias("at"), F.right("initials", F.lit(1)).alias("initial")).withColumn("left", F.lit(True)),
        allowMissingColumns=True,
    )
    borders = borders.groupBy("conv_id", "at").agg(
        F.concat(F.max(F.when(F.col("left"), F.col("initial"))), F.max(F.when(F.col("left").isNull(), F.col("initial")))).alias("p")
    )
    borders = borders.groupBy(F.col("conv_id").alias("_b")).agg(F.sum((~F.col("p").isin(*LEGAL)).cast("long")).alias("across"))
    sums = parts.groupBy("conv_id").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")), F.sum(inside.cast("long")).alias("inside")
    )
    audits = chosen.groupBy(F.col("conv_id").alias("_a")).agg(
        F.max("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("segment", "audit"))), lambda s: s.audit), "").alias("audit"),
    )
    out = sums
    for side, name in ((spans, "_c"), (distinct, "_d"), (borders, "_b"), (audits, "_a")):
        out = out.join(side, F.col("conv_id").eqNullSafe(F.col(name)), "left")
    return out.select(
        "conv_id", F.coalesce(F.col("span") - F.col("known"), F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated",
        (F.col("inside") + F.coalesce("across", F.lit(0))).alias("illegal"), "cost", "audit",
    )


def _lines(rows: DataFrame, chosen: DataFrame, parts: DataFrame, config: Config) -> DataFrame:
    """Repaired turns of long conversations: the edits, one by one, joined to the rows they read."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("line", pa.int64()), ("edit", pa.string()), ("place", pa.int64()), ("given", pa.string())]
        for batch in batches:
            schema = pa.schema([batch.schema.field("conv_id"), *fields])
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "segment", "entry", "line", "audit", "codes"))
            yield from _written(
                ((c, line + k, edit, n * config.segment + place if edit != "I" else None, role or None)
                 for c, n, entry, line, audit, codes in zip(*columns)
                 for k, (edit, role, place) in enumerate(repaired([("", i) for i in range(len(codes))], codes, audit, entry)[0])),
                schema,
            )

    decided = chosen.join(
        parts.select(F.col("conv_id").alias("_c"), F.col("segment").alias("_s"), "codes"),
        F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("segment") == F.col("_s")),
    ).select("conv_id", "segment", "entry", "line", "audit", "codes")
    edits = decided.mapInArrow(listed, f"{_key(rows)}, line long, edit string, place long, given string")
    held = rows.select(F.col("conv_id").alias("_c"), F.col("place").alias("_p"), F.col("role").alias("own"), "text")
    out = edits.join(held, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("place") == F.col("_p")), "left")
    return out.select("conv_id", "line", "edit", F.coalesce("given", "own").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
