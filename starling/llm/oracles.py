"""DuckDB counterparts of the queries that SQL can say."""

from __future__ import annotations

from starling.llm.host_reputation import TWO_LABEL_SUFFIXES, URL_PATTERN, Config
from starling.llm.queries import PAGE_NUMBER, URL_RULES
from starling.llm.rule_ledger import POLICIES, RULES, mask_of

_config = Config()
_two = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)


def _fits(rule) -> str:
    return f"((host = '{rule.host}' or ends_with(host, '.{rule.host}')) and starts_with(path, '{rule.path}'))"


_by_length = sorted(URL_RULES, key=lambda r: (len(r.text), r.text), reverse=True)
_rule = "case " + " ".join(f"when {_fits(r)} then '{r.text}'" for r in _by_length) + " end"
_action = "case rule " + " ".join(f"when '{r.text}' then '{r.action}'" for r in URL_RULES) + " end"


def _level(name: str, keys: str, parent: str, key: str) -> str:
    """Counts, parent share, prior weight and posterior share of one level."""
    return f"""
{name}_c as (select {keys}, sum(good) as good, sum(seen) as seen from hosts group by {keys}),
{name}_m as (select c.*, p.share as m from {name}_c c join {parent} p on {key}),
{name}_k as (
  select 1 / least(greatest(case when whole > 0 then spread / whole else 0.1 end, {_config.least_spread}), {_config.most_spread}) - 1 as k
  from (select
      coalesce(sum(cast(round(seen * (good / seen - m) ** 2 - m * (1 - m), 9) as decimal(28, 9))), 0)::double as spread,
      coalesce(sum(cast(round(m * (1 - m) * (seen - 1), 9) as decimal(28, 9))), 0)::double as whole
    from {name}_m where seen >= 2)),
{name}_p as (select m.*, m * k + good as alpha, (1 - m) * k + seen - good as beta, alpha / (alpha + beta) as share from {name}_m m, {name}_k)"""


HOST_REPUTATION = f"""
with judged as (
  select page_id, translate(coalesce(regexp_extract(url, '{URL_PATTERN}', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '{URL_PATTERN}', 2), '') as path from pages),
good as (select doc_id, min(quality) as good from labels where doc_id is not null and quality is not null group by doc_id),
known as (
  select host, good from judged left join good on try_cast(regexp_extract(path, '{PAGE_NUMBER}', 1) as bigint) = doc_id),
counted as (select host, coalesce(sum(good), 0)::double as good, count(good) as seen, string_split(host, '.') as l from known group by host),
sized as (select *, case when len(l) >= 3 and array_to_string(l[-2:], '.') in ({_two}) then 2 else 1 end as n from counted),
hosts as (
  select host, good, seen, case when len(l) <= n then host else array_to_string(l[-(n + 1):], '.') end as domain,
    case when len(l) <= n then host else array_to_string(l[-n:], '.') end as suffix from sized),
root as (select (sum(good) + 1) / (sum(seen) + 2) as share from hosts),
{_level("suffix", "suffix", "root", "true")},
{_level("domain", "domain, suffix", "suffix_p", "c.suffix = p.suffix")},
{_level("host", "host, domain", "domain_p", "c.domain = p.domain")},
reputations as (
  select host, seen, case when 1 / (1 + exp(-(ln(alpha / beta) + {_config.z} * sqrt(1 / alpha + 1 / beta)))) < {_config.floor} then 'block' else 'allow' end as reputation
  from host_p),
ruled as (select *, {_rule} as rule from judged)
select page_id, host, path, rule, coalesce({_action}, reputation) as verdict, seen::bigint as host_outcomes
from ruled join reputations using (host)
"""

_rules = " + ".join(f"case when {r.failed} then {1 << r.bit} else 0 end" for r in RULES)

_LEDGER = rf"""
with texts as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
words as (select r, unnest(w) as word, unnest(generate_series(1, len(w))) as i
  from (select r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from texts)),
counted as (select r, count(*) as n_words, sum(length(word)) as word_chars from words group by r),
windows as (
  select r, i, array_to_string(list(word) over (partition by r order by i rows between current row and 7 following), ' ') as w,
    lead(i, 7) over (partition by r order by i) as whole from words),
twice as (select r, i from (select r, i, count(*) over (partition by r, w) as n from windows where whole is not null) where n > 1),
covered as (select r, count(distinct i + k) as n_repeat_words from twice, generate_series(0, 7) g(k) group by r),
lines as (select r, line, count(*) as n from (select r, unnest(string_split(text, chr(10))) as line from texts)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by r, line),
repeated as (select r, sum(n) as n_lines, sum(n - 1) as n_dup_lines from lines group by r),
measured as (
  select doc_id, coalesce(n_words, 0)::bigint as n_words, coalesce(word_chars, 0)::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    coalesce(n_lines, 0)::bigint as n_lines, (length(text) - length(replace(text, '!', '')))::bigint as n_exclaim
  from texts left join counted using (r) left join covered using (r) left join repeated using (r)),
ledger as (select *, ({_rules})::bigint as failures from measured)
"""
RULE_LEDGER = f"""{_LEDGER}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failures & 3) <> 0 as base_failed, failures = 0 as kept, failures from ledger
"""



_listed = ", ".join(f"('{p}', '{r.name}', {mask_of(p)}, {1 << r.bit})" for p in POLICIES for r in RULES if r.name in POLICIES[p])
ABLATIONS = f"""{_LEDGER}
select policy, rule, sum((failures & bit <> 0)::int)::bigint as n_failed, sum((failures & mask = bit)::int)::bigint as n_only,
  sum(((failures & mask) & ~bit = 0)::int)::bigint as n_kept_without, sum((failures & mask = 0)::int)::bigint as n_kept
from ledger, (values {_listed}) as w(policy, rule, mask, bit) group by policy, rule
"""


def _crc32(text: str) -> str:
    """Checksum of an ASCII text, byte by byte and bit by bit."""
    eight = "list_reduce(list_concat([xor(c, b)], range(8)), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))"
    return f"xor(list_reduce(list_concat([4294967295], list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint)), lambda c, b: {eight}), 4294967295)"


_blank = "coalesce(%s::varchar, ' ')"
_white = r"[ \t\n\x0B\f\r]"
TURN_REPAIR = rf"""
with recursive given as (
  select conv_id, turn, {_blank % 'role'} as role, {_blank % 'text'} as text,
    {_crc32(f"{_blank % 'conv_id'} || ':' || {_blank % 'turn'}")} % 20 as harm from conversations),
damaged as (
  select conv_id, turn, case when harm = 4 then 'user' else role end as role,
    case harm when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from given, generate_series(1, case when harm = 3 then 2 else 1 end) where harm <> 0),
placed as (
  select *, row_number() over (partition by conv_id, role, text order by i) > 1 as again,
    right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) as ending,
    case when left(role, 1) in ('s', 'u', 'a') then left(role, 1) else 'o' end as initial
  from (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as i from damaged)),
coded as (
  select *, ending = '' as blank, again and ending <> '' as duplicate, not again and ending not in ('', '.', '!', '?') as cut,
    lag(initial) over (partition by conv_id order by i) || initial not in ('su', 'ua', 'au') as illegal from placed),
-- states: 0 nothing kept, 1 a system turn, 2 then a user turn, 3 then an assistant turn
inserts(s, spent, letters, t) as (
  from (values (0, 0, '', 0), (1, 0, '', 1), (2, 0, '', 2), (3, 0, '', 3), (0, 2, 'I', 2), (1, 2, 'I', 2), (2, 2, 'I', 3), (3, 2, 'I', 2),
    (0, 4, 'II', 3), (1, 4, 'II', 3), (2, 4, 'II', 2), (3, 4, 'II', 3))),
edits(s, initial, price, letter, t) as (
  select s, initial, 3, 'D', s from range(4) a(s), (values ('s'), ('u'), ('a'), ('o'), ('x')) b(initial)
  union all from (values (0, 's', 0, 'K', 1)) where true
  union all select s, initial, case when initial = due then 0 else 2 end, case when initial = due then 'K' else 'R' end, t
  from (values (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) a(s, due, t), (values ('s'), ('u'), ('a'), ('o')) b(initial)),
best as (
  select conv_id, 0::bigint as i, 0 as s, {{'cost': 0, 'audit': ''}} as b from (select distinct conv_id from coded)
  union all
  select best.conv_id, best.i + 1, e.t,
    min({{'cost': b.cost + n.spent + e.price + case when c.cut and e.letter <> 'D' then 1 else 0 end, 'audit': b.audit || n.letters || e.letter}})
  from best join coded c on c.conv_id is not distinct from best.conv_id and c.i = best.i
    join inserts n on n.s = best.s
    join edits e on e.s = n.t and e.initial = case when blank or again then 'x' else c.initial end
  group by best.conv_id, best.i, e.t),
counted as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, sum(blank::int) as blank,
    sum(duplicate::int) as duplicate, sum(cut::int) as truncated, coalesce(sum(illegal::int), 0) as illegal
  from coded group by conv_id),
chosen as (
  select best.conv_id, min({{'cost': b.cost + spent, 'audit': b.audit || letters}}) as b
  from best join counted k on k.conv_id is not distinct from best.conv_id and k.n = best.i join inserts n on n.s = best.s
  where t in (0, 3) group by best.conv_id),
steps as (
  select conv_id, unnest(string_split(b.audit, '')) as letter, unnest(generate_series(1, length(b.audit))) as k from chosen where b.audit <> ''),
read as (
  select *, sum((letter <> 'I')::int) over w - (letter <> 'I')::int as i, sum((letter <> 'D')::int) over w - 1 as line
  from steps window w as (partition by conv_id order by k)),
lines as (
  select r.conv_id, k, line, letter, case when letter <> 'I' then c.text else '' end as text, c.role, c.initial,
    max((line = 0 and letter = 'K' and c.initial = 's')::int) over (partition by r.conv_id) as opened
  from read r left join coded c on c.conv_id is not distinct from r.conv_id and c.i = r.i and r.letter <> 'I' where letter <> 'D'),
repaired as (
  select conv_id, sha256(string_agg(
    case when letter = 'K' then role when (line - opened) % 2 = 0 then 'user' else 'assistant' end || ':' || text, chr(10) order by k)) as sha
  from lines group by conv_id)
select e.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(b.cost, 0)::bigint as cost,
  coalesce(b.audit, '') as audit, coalesce(sha, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) e
  left join counted k on k.conv_id is not distinct from e.conv_id
  left join chosen c on c.conv_id is not distinct from e.conv_id
  left join repaired r on r.conv_id is not distinct from e.conv_id
"""


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::varchar) || ':' || {column}::varchar, '-')"


def _row(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _climbed(name: str, group: str, nodes: str) -> str:
    """Levels of a tree per group: nodes(group, i, h) become (group, level, i, h, n), n of them on a level."""
    return f"""
{name} as (
  select {group} as g, 0 as level, i, h, count(*) over (partition by {group}) as n from {nodes}
  union all
  select g, level + 1, i // 3, sha256(string_agg(h, '' order by i)), (n + 2) // 3 from {name} where n > 1 group by g, level, i // 3, n)"""


def _path(name: str, nodes: str, tree: str) -> str:
    """What flanks each node's way up: (key, level, before, after)."""
    return f"""
{name} as (
  select key, t.level, coalesce(string_agg(t.h, '' order by t.i) filter (t.i < l.i // (3 ** t.level)::bigint), '') as before,
    coalesce(string_agg(t.h, '' order by t.i) filter (t.i > l.i // (3 ** t.level)::bigint), '') as after
  from {nodes} l join {tree} t on t.g is not distinct from l.g and t.n > 1 and t.i // 3 = l.i // (3 ** (t.level + 1))::bigint
  group by key, t.level)"""


MERKLE_LEVELS = f"""
with recursive leaves as (
  select row_number() over () as key, doc_id, source as g, {_row('text')} as h,
    case when {_crc32("coalesce(doc_id::varchar, 'x')")} % 2 = 0 and doc_id is not null then {_row("replace(text, chr(10), '')")} end as changed,
  from documents),
numbered as (select *, row_number() over (partition by g order by doc_id nulls first, h) - 1 as i from leaves),
{_climbed('tree', 'g', 'numbered')},
subroots as (select 0 as one, row_number() over (order by g nulls first) - 1 as i, g as source, h from tree where n = 1),
{_climbed('upper', 'one', 'subroots')},
{_path('low', 'numbered', 'tree')},
named as (select row_number() over () as key, 0 as g, i, source, h from subroots),
{_path('high', 'named', 'upper')},
path as (
  select key, level, before, after from low
  union all
  select l.key, 1000 + high.level, before, after from numbered l join named on named.source is not distinct from l.g join high on high.key = named.key),
stepped as (select *, row_number() over (partition by key order by level) as step from path),
folded as (
  select key, 0::bigint as step, coalesce(changed, h) as h from leaves
  union all
  select f.key, s.step, sha256(s.before || f.h || s.after) from folded f join stepped s on s.key = f.key and s.step = f.step + 1),
ends as (select key, arg_max(h, step) as h from folded group by key),
proofs as (select key, sha256(string_agg(before || after, '' order by step)) as proof from stepped group by key)
select l.doc_id, l.h as leaf, s.h as subroot, r.h as root, coalesce(p.proof, sha256('')) as proof_sha256, e.h as folded_root, e.h = r.h as verified
from leaves l join subroots s on s.source is not distinct from l.g join upper r on r.n = 1 join ends e using (key) left join proofs p using (key)
"""

ORACLES = {"ledger_ablations": ABLATIONS, "op11_turn_repair": TURN_REPAIR, "op12_merkle_levels": MERKLE_LEVELS, "op1_host_reputation": HOST_REPUTATION, "op2_rule_ledger": RULE_LEDGER}
