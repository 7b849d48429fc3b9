"""SQL of the operators that it can express; each row of a table gets a number, as rows may repeat."""

from __future__ import annotations

from . import conversations, fim, mixing, secrets
from .common import WORD

RULES_SQL = f"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '{WORD}') as words from d),
v as (
 select rid, doc_id, words, len(words) as n_words, cast(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) as bigint) as word_chars,
  cast(coalesce(list_sum(list_transform(words, lambda x: strlen(x))), 0) as bigint) as word_bytes,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_upper,
  length(regexp_replace(t, '[^!?]', '', 'g')) as n_marks, length(regexp_replace(t, '[^0-9]', '', 'g')) as n_digits,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) as lines,
  len(list_filter(range(1, len(words)), lambda i: words[i] = words[i + 1])) as n_adjacent
 from w),
windows as (select rid, i, array_to_string(words[i : i + 7], ' ') as win from (select rid, words, unnest(range(1, len(words) - 6)) as i from v)),
again as (select rid, i from windows qualify count(*) over (partition by rid, win) >= 2),
repeats as (select rid, count(distinct i + k) as n_repeat_words from again, range(8) as x(k) group by rid),
counted as (
 select v.*, len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
 from v left join repeats using (rid))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
 not (n_words < 20 or 100 * n_repeat_words > 30 * n_words or n_symbols > 0.15::double * n_words or n_upper > 0.3::double * word_bytes or n_marks > 0.25::double * n_words
  or n_dup_lines > 0.6::double * greatest(4, len(lines)) or n_adjacent > 0.25::double * n_words or n_digits > 0.4::double * word_bytes or word_chars > 25 * n_words) as kept
from counted"""

MIX_SQL = f"""
with line as (
 select row_number() over () as rid, doc_id, case when source is null then '1' else '0' || source end as src,
  coalesce(len(regexp_extract_all(text, '{WORD}')), 0) as size, md5(coalesce(cast(doc_id as varchar), '')) as spot
 from documents),
s1 as (
 select src, cast(sum(size) as bigint) as source_size, case (row_number() over (order by src) - 1) % 3 when 0 then {mixing.WEIGHTS[0]} when 1 then {mixing.WEIGHTS[1]} else {mixing.WEIGHTS[2]} end::double as weight
 from line group by src),
s2 as (select *, {mixing.MOST} * source_size as stop, sum(source_size) over () as whole, sum(weight) over () as weights from s1),
s3 as (
 select *, stop / weight <= (whole - coalesce(sum(stop) over fuller, 0))::double / (weights - coalesce(sum(weight) over fuller, 0)) as is_full
 from s2 window fuller as (order by stop / weight, src rows between unbounded preceding and 1 preceding)),
s4 as (
 select src, source_size, case when is_full then stop::double else weight * ((whole - sum(case when is_full then stop else 0 end) over ())::double / sum(case when is_full then 0 else weight end) over ()) end as target
 from s3),
placed as (
 select rid, doc_id, src, size, spot, source_size, target, coalesce(sum(size) over (partition by src order by spot, doc_id nulls first, size, rid rows between unbounded preceding and 1 preceding), 0)::bigint as ahead
 from line join s4 using (src)),
turns as (select *, unnest(range(0, least({mixing.MOST}, floor(target / source_size + 0.5)::bigint + 1))) as turn from placed where size > 0),
starts as (select *, unnest(range(0, size, {mixing.QUANTUM})) as start from turns),
pieces as (select *, least({mixing.QUANTUM}, size - start) as length, (turn * source_size + ahead + start + least({mixing.QUANTUM}, size - start))::double / target as finish from starts),
served as (
 select rid, length, coalesce(sum(length) over (order by finish, src, spot, doc_id nulls first, size, rid, start rows between unbounded preceding and 1 preceding), 0) as before, (select sum(size) from line) as budget
 from pieces),
taken as (select rid, sum(least(length, budget - before)) as taken from served where before < budget group by rid)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken from placed left join taken using (rid)"""

_EITHER = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "(?:password|passwd|secret|token|api_?key)")
_ASSIGN = _EITHER + secrets.ASSIGN.partition("(?-i)")[2].replace("'", "''")
_PATTERNS = {"assign": (_ASSIGN, 1), "access": (secrets.ACCESS, 0), "hex": (secrets.HEX, 0), "blob": (secrets.BLOB, 0)}


def _kind(number: int, name: str) -> str:
    pattern, group = _PATTERNS[name]
    test = {"assign": f"length(v) >= {secrets.MIN_VALUE}", "blob": "regexp_matches(v, '[0-9]') and regexp_matches(v, '[a-z]') and regexp_matches(v, '[A-Z]')"}.get(name, "true")
    return f"""
{name}_m as (
 select rid, {number} as kind, v, s, s + length(m) as e from (
  select rid, m, v, sum(length(g)) over (partition by rid order by i) + coalesce(sum(length(m)) over (partition by rid order by i rows between unbounded preceding and 1 preceding), 0) as s from (
   select rid, i, ms[i] as m, vs[i] as v, gs[i] as g from (
    select *, unnest(range(1, len(ms) + 1)) as i from (
     select rid, regexp_extract_all(t, '{pattern}') as ms, regexp_extract_all(t, '{pattern}', {group}) as vs, string_split_regex(t, '{pattern}') as gs from d)))) where {test})"""


SECRETS_SQL = f"""
with d as (select row_number() over () as rid, doc_id, source, coalesce(text, '') as t from documents),
{",".join(_kind(k, name) for k, name in enumerate(secrets.KINDS))},
base as (select * from assign_m union all select * from access_m union all select * from hex_m),
loose as (select * from blob_m b where not exists (select 1 from base x where x.rid = b.rid and x.s < b.e and b.s < x.e)),
every as (select * from base union all select * from loose),
owned as (
 select v, count(distinct owner) as owners, count(distinct owner || ':' || repo) as repositories
 from (select v, coalesce('1' || source, '0') as owner, coalesce(cast(doc_id as varchar), '') as repo from every join d using (rid)) group by v),
judged as (select every.*, owners <= {secrets.MAX_OWNERS} and repositories <= {secrets.MAX_REPOSITORIES} as live from every join owned using (v)),
named as (select rid, s, kind, live, {secrets.KINDS!r}[kind + 1] || ':' || cast(s as bigint) || ':' || cast(e as bigint) as x, kind < 3 as is_base from judged where live or kind < 3),
joined as (
 select rid, count(*) filter (kind = 0) as a, count(*) filter (kind = 1) as b, count(*) filter (kind = 2) as c, count(*) filter (live) as n_live, count(*) filter (not live) as n_copied,
  string_agg(x, ',' order by s, kind) filter (is_base) as base, string_agg(x, ',' order by s, kind) as spans from named group by rid)
select doc_id, coalesce(a, 0) as n_assign, coalesce(b, 0) as n_access, coalesce(c, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live, coalesce(n_copied, 0) as n_copied
from d left join joined using (rid)""".replace(repr(secrets.KINDS), repr(list(secrets.KINDS)))

FIM_SQL = f"""
with d as (
 select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{fim.UNIT}') as u, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
s as (
 select *, len(u) as n, ('0x' || h[1:8])::bigint % (len(u) + 1) as a, ('0x' || h[9:16])::bigint % (len(u) + 1) as b, ('0x' || h[17:24])::bigint % 100 as c, ('0x' || h[25:32])::bigint % 100 as e from d),
cut as (
 select *, case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or c >= {fim.CUT_PER_CENT} then 'plain' when e < {fim.SPM_PER_CENT} then 'spm' else 'psm' end as form,
  array_to_string(u[1:least(a, b)], '') as p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') as m, array_to_string(u[greatest(a, b) + 1:], '') as z from s)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
 sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || z || '<M>' || m else '<S>' || z || '<P>' || p || '<M>' || m end) as output_sha256, sha256(p || m || z) as restored_sha256 from cut"""

CRC_SQL = """
-- crc32 byte by byte: the table's entries by eight halvings, then a fold over the characters of a decimal number
table_ as (select list(v order by i) as entries from (select i, list_reduce(list_prepend(i, range(8)), lambda a, k: case when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end) as v from (select unnest(range(256)) as i))),
crc as (
 select c, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(c as varchar), ''), lambda x: ascii(x)::bigint)), lambda a, x: xor(a // 256, entries[xor(a % 256, x) + 1])), 4294967295) as crc
 from (select distinct conv_id as c from conversations where conv_id is not null), table_)"""

TRIE_SQL = f"""
with {CRC_SQL.strip()},
own as (
 select conv_id as c, list(coalesce(role, '') || chr(31) || coalesce(text, '') order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns from conversations where conv_id is not null group by 1),
made as (
 select o.c, coalesce(b.turns[1:crc % {conversations.SHARES}], []) || o.turns[crc % {conversations.SHARES} + 1:] as turns
 from own o join crc using (c) left join own b on b.c = o.c - o.c % {conversations.FAMILY}),
entries as (
 select c, d, sha256(d || chr(30) || array_to_string(turns[1:d], chr(30))) as k, case when d > 0 then sha256((d - 1) || chr(30) || array_to_string(turns[1:d - 1], chr(30))) end as up,
  case when d > 0 then strlen(turns[d]) - strlen(split_part(turns[d], chr(31), 1)) - 1 else 0 end as bytes, d = len(turns) as ends
 from (select *, unnest(range(0, len(turns) + 1)) as d from made)),
nodes as (
 select k, any_value(up) as up, any_value(d) as depth, min(c) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(bytes) as saved, sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (ends), '')) as ends_sha256 from entries group by k),
kids as (select up as k, count(*) as n_children from nodes where up is not null group by 1),
full_ as (select n.*, coalesce(n_children, 0) as n_children from nodes n left join kids using (k)),
sums as (
 select e.k, cast(sum(saved) as bigint) as saved_tokens, count(*) filter (n_children = 0) as n_leaves from full_ f join entries e on e.c = f.conv_id and e.d <= f.depth group by 1)
select f.conv_id, f.depth, p.conv_id as parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256 from full_ f join sums using (k) left join nodes p on p.k = f.up"""

ORACLES = {"op11_fill_in_middle": FIM_SQL, "op12_conversation_trie": TRIE_SQL, "op3_weighted_fair_mix": MIX_SQL, "op6_ownership_secrets": SECRETS_SQL, "op8_rule_cascade": RULES_SQL}
