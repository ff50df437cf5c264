"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op7_exact_dedup"] = r"""
with normal as (
 select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents
)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
 doc_id is not distinct from min(doc_id) over same as kept, sha256(t) as text_sha256
from normal
window same as (partition by t)
"""

ORACLES["op10_mixing"] = r"""
with sized as (
 select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
  md5(coalesce(cast(doc_id as varchar), '')) as code
 from documents
), named as (
 select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as rank
 from sized group by source
), filled as (
 select *, case rank % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as weight, source_size * 2.0::double as cap
 from named
), levels as (
 select *, (cast(sum(source_size) over () as double) * 1.5::double - (sum(cap) over ordered - cap))
   / sum(weight) over (order by cap / weight, rank rows between current row and unbounded following) as level
 from filled
 window ordered as (order by cap / weight, rank rows between unbounded preceding and current row)
), quota as (
 select source, source_size, rank,
  coalesce(least(cap, weight * max(case when cap / weight >= level then level end) over ()), cap) as target
 from levels
), placed as (
 select s.doc_id, s.size, q.source_size, q.rank, q.target, cast(floor(q.target) as bigint) as whole,
  cast(sum(s.size) over (partition by s.source order by s.code, s.size rows between unbounded preceding and current row) - s.size as bigint) as place
 from sized s join quota q on s.source is not distinct from q.source
), timed as (
 select *, case when size > 0 and whole > place then place / target end as part,
  case when size > 0 and whole > place + source_size then (place + source_size) / target end as again from placed
)
select doc_id, size, source_size, target,
 cast(greatest(0, least(size, whole - place)) + greatest(0, least(size, whole - place - source_size)) as bigint) as taken,
 cast(floor(1e6 * case
  when rank % 3 = 0 then 2.0::double * part / (1.5::double + sqrt(2.25::double - 2.0::double * part))
  when rank % 3 = 1 then part
  when 0.875::double * part >= 0.25::double then 0.5::double + 2.0::double * (0.875::double * part - 0.25::double) / (0.5::double + sqrt(0.25::double + 6.0::double * (0.875::double * part - 0.25::double)))
  else 2.0::double * (0.875::double * part) / (0.5::double + sqrt(0.25::double)) end) as bigint) as position,
 cast(floor(1e6 * case
  when rank % 3 = 0 then 2.0::double * again / (1.5::double + sqrt(2.25::double - 2.0::double * again))
  when rank % 3 = 1 then again
  when 0.875::double * again >= 0.25::double then 0.5::double + 2.0::double * (0.875::double * again - 0.25::double) / (0.5::double + sqrt(0.25::double + 6.0::double * (0.875::double * again - 0.25::double)))
  else 2.0::double * (0.875::double * again) / (0.5::double + sqrt(0.25::double)) end) as bigint) as second_position
from timed
"""

ORACLES["op6_near_dedup"] = r"""
with recursive worded as (
 select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
 from documents
), shingled as (
 select distinct doc_id, unnest(case
   when len(w) >= 3 then [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]
   when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
 from worded
), sized as (
 select doc_id, count(*) as n from shingled group by doc_id
), common as (
 select a.doc_id as x, b.doc_id as y, count(*) as c from shingled a join shingled b on a.s = b.s and a.doc_id < b.doc_id group by all
), linked as (
 select x, y from common join sized nx on nx.doc_id = x join sized ny on ny.doc_id = y where 100 * c >= 85 * (nx.n + ny.n - c)
), ways as (
 select x, y from linked union all select y, x from linked
), reach as (
 select x, y from ways
 union
 select r.x, w.y from reach r join ways w on r.y = w.x
), least as (
 select x, min(least(x, y)) as component from reach group by x
)
select d.doc_id, coalesce(n, 0) as n_shingles, coalesce(component, d.doc_id) as component_id, coalesce(component, d.doc_id) = d.doc_id as kept
from documents d left join sized s on s.doc_id = d.doc_id left join least l on l.x = d.doc_id
"""

ORACLES["op5_substring_dedup"] = r"""
with worded as (
 select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), starts as (
 select r, unnest(range(1, len(w) - 33)) as i from worded
), windows as (
 select s.r, i, array_to_string(w[i:i + 34], ' ') as t from starts s join worded d on d.r = s.r
), again as (
 select r, i from (select r, i, count(*) over (partition by t) as n from windows) where n > 1
), covered as (
 select r, list(distinct j) as js from (select r, unnest(range(i, i + 35)) as j from again) group by r
), left_over as (
 select d.doc_id, len(w) as n_words, len(coalesce(js, [])) as n_removed,
  [w[k] for k in range(1, len(w) + 1) if js is null or not list_contains(js, k)] as kept
 from worded d left join covered c on c.r = d.r
)
select doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) as kept_sha256 from left_over
"""

_UNITS = "'%', 'mm', 'cm', 'm', 'km', 'in', 'ft', 'mi', 'g', 'kg', 'mg', 't', 'lb', 'oz', 's', 'ms', 'min', 'h', 'hours', 'minutes', 'seconds', 'days', 'years', 'l', 'ml', 'usd', 'eur', 'dollars', 'euros', 'cents', 'degrees', 'percent'"
_NUMBER = "^[+-]?[0-9]+([.,/:-][0-9]+)*"
_PLAIN = r"""case
  when regexp_matches(b[i], '{number}$') then '<num>'
  when regexp_matches(b[i], '{number}[A-Za-z%]+$') then '<num><unit>'
  when lower(b[i]) in ({units}) and i > 1 and regexp_matches(b[i - 1], '{number}$') then '<unit>'"""
_WORDED = r"""
select id, w, b, [{plain}
  when regexp_matches(b[i], '^\p{{Lu}}\p{{Ll}}+$') and i > 1 and regexp_matches(w[i - 1], '[\p{{Ll}},;]$') then '<name>'
  else lower(b[i]) end for i in range(1, len(b) + 1)] as t0, [case
  when regexp_matches(b[i], '^[+-]?[$€£¥][0-9]+([.,/:-][0-9]+)*[A-Za-z]?$|{number}[$€£¥]$') then '<money>'
  when regexp_matches(b[i], '{possessive}') then '<name''s>'
  else {plain} when regexp_matches(b[i], '^\p{{Lu}}\p{{Ll}}+$') then '<name>' else lower(b[i]) end end for i in range(1, len(b) + 1)] as t1
from (select id, w, [translate(x, '.,;:!?"()[]', '') for x in w] as b
 from (select {id} as id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from {table}))
"""
_POSSESSIVE = r"^(\p{Lu}\p{Ll}+)[''’]s?$"


def _worded(table: str, key: str) -> str:
    plain = _PLAIN.format(number=_NUMBER, units=_UNITS)
    return _WORDED.format(table=table, id=key, number=_NUMBER, possessive=_POSSESSIVE, plain=plain)


def _windowed(words: str, key: str, place: str, slots: str) -> str:
    """Windows of eight words in both forms; those of placeholders only go by their words."""
    parts = []
    for form in (0, 1):
        value = f"regexp_replace(b[k], '{_POSSESSIVE}', '\\1')" if form else "b[k]"
        parts.append(
            f"""select id as {key}, {form} as form, i as {place}, len(w) - 7 as n,
  if(len([k for k in range(i, i + 8) if not starts_with(t{form}[k], '<')]) = 0, 'values ' || array_to_string(b[i:i + 7], ' '), 'words ' || array_to_string(t{form}[i:i + 7], ' ')) as h,
  [{value} for k in range(i, i + 8) if starts_with(t{form}[k], '<')] as {slots} from (select *, unnest(range(1, len(w) - 6)) as i from {words})"""
        )
    return " union all ".join(parts)


_SIDES = "count(distinct x) = count(distinct (x, y)) and count(distinct y) = count(distinct (x, y))"
_SAME = "m.doc_id is not distinct from {o}.doc_id and m.item_id is not distinct from {o}.item_id and m.form = {o}.form and m.diagonal = {o}.diagonal"
_DIAGONAL = "doc_id, item_id, form, diagonal"

ORACLES["op2_decontamination"] = f"""
with items as ({_worded("benchmark", "item_id")}),
docs as ({_worded("documents", "doc_id")}),
item_windows as ({_windowed("items", "item_id", "i", "a")}),
doc_windows as ({_windowed("docs", "doc_id", "place", "s")}),
met as (
 select distinct d.doc_id, m.item_id, m.form, d.place - m.i as diagonal, m.i, m.n, m.a, d.s from doc_windows d join item_windows m on m.h = d.h and m.form = d.form
), slots as (
 select distinct {_DIAGONAL}, i, unnest(a) as x, unnest(s) as y from met
), whole as (
 select {_DIAGONAL}, {_SIDES} as fits, bool_and(x = y) as same from slots group by all
), wanted as (
 select m.*, coalesce(o.fits, true) as fits, coalesce(o.same, true) as same, least(6, ceil(0.5 * m.n)) as needed
 from met m left join whole o on {_SAME.format(o="o")}
), begun as (
 select m.*, (select count(distinct o.i) from met o where {_SAME.format(o="o")} and o.i between m.i and m.i + m.needed - 1) as held from wanted m where not fits
), run_slots as (
 select m.doc_id, m.item_id, m.form, m.diagonal, m.i, x, y from begun m join slots o on {_SAME.format(o="o")} and o.i between m.i and m.i + m.needed - 1 where held = m.needed
), run_fits as (
 select {_DIAGONAL}, i from run_slots group by all having {_SIDES}
), fitting as (
 select m.doc_id, m.item_id, m.form, m.diagonal, m.i, m.needed from begun m
 where held = m.needed and (exists (select 1 from run_fits o where {_SAME.format(o="o")} and o.i = m.i) or not exists (select 1 from run_slots o where {_SAME.format(o="o")} and o.i = m.i))
), counted as (
 select {_DIAGONAL}, i from wanted where fits or a = s
 union select {_DIAGONAL}, unnest(range(i, i + cast(needed as bigint))) from fitting
), best as (
 select doc_id, item_id, form, max(k) as best from (select {_DIAGONAL}, count(*) as k from counted group by all) group by all
), together as (
 select doc_id, item_id, form, count(distinct i) as windows from counted group by all
), lengths as (
 select doc_id, item_id, form, max(n) as item_windows, bool_and(same) as verbatim from wanted group by all
), long_ones as (
 select m.doc_id, m.item_id, b.windows, cast(m.item_windows as bigint) as item_windows, m.verbatim
 from lengths m join together b on b.doc_id is not distinct from m.doc_id and b.item_id is not distinct from m.item_id and b.form = m.form
 join best o on o.doc_id is not distinct from m.doc_id and o.item_id is not distinct from m.item_id and o.form = m.form
 where o.best >= 6 or b.windows >= 0.5 * m.item_windows
), short_items as (
 select id as item_id, len(w) as n, array_to_string([lower(x) for x in b], ' ') as h from items where len(w) between 1 and 7 and array_to_string(b, '') <> ''
), short_ones as (
 select d.id as doc_id, m.item_id, 1 as windows, 1 as item_windows, true as verbatim
 from (select id, l, array_to_string([lower(x) for x in b[i:i + l - 1]], ' ') as h from (select *, unnest(range(1, len(w) - l + 2)) as i from docs, (select distinct n as l from short_items))) d
 join short_items m on m.h = d.h and m.n = d.l
)
select doc_id, item_id, cast(max(windows) as bigint) as windows, cast(max(item_windows) as bigint) as item_windows, bool_and(verbatim) as verbatim
from (select * from long_ones union all select * from short_ones) group by doc_id, item_id
"""

ORACLES["op12_fill_in_middle"] = r"""
with coded as (
 select doc_id, coalesce(text, '') as x, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as w,
  sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h
 from documents
), drawn as (
 select doc_id, x, w, len(w) as n,
  least(cast('0x' || h[1:8] as bigint) % (len(w) + 1), cast('0x' || h[9:16] as bigint) % (len(w) + 1)) as a,
  greatest(cast('0x' || h[1:8] as bigint) % (len(w) + 1), cast('0x' || h[9:16] as bigint) % (len(w) + 1)) as b,
  case when x = '' or regexp_matches(x, '<[PSM]>') or cast('0x' || h[17:24] as bigint) % 100 >= 90 then 'plain'
   when cast('0x' || h[25:32] as bigint) % 100 < 20 then 'spm' else 'psm' end as form
 from coded
), parted as (
 select *, array_to_string(w[1:a], '') as p, array_to_string(w[a + 1:b], '') as m, array_to_string(w[b + 1:n], '') as s from drawn
)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
 sha256(case form when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m else x end) as output_sha256,
 sha256(x) as restored_sha256
from parted
"""


def _edit(state: str, cost: str, letter: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || {letter}}}"


def _shift(state: str, initial: str) -> str:
    """Keep or Rerole as the initial has it, out of the question for faulty rows."""
    return _edit(state, f"if(f.faulty, 1000000, if(f.cut, 5, 0) + if(f.initial = '{initial}', 0, 1))", f"if(f.initial = '{initial}', 'K', 'R')")


# States: e nothing yet, s after the system's, u after a user's, a after an assistant's row.
def _step(moved: str) -> str:
    """Rows after any inserts."""
    return f"""
 select conv_id, i, e, s, least(u, {_edit("a", "5", "'I'")}) as u, a from (
  select conv_id, i, e, s, u, least(a, {_edit("u", "5", "'I'")}) as a from (
   select conv_id, i, e, s, a, least(u, {_edit("e", "5", "'I'")}, {_edit("s", "5", "'I'")}, {_edit("a", "5", "'I'")}) as u from ({moved})))
"""


_MOVED = f"""
    select d.conv_id, f.i, {_edit("d.e", "2", "'D'")} as e,
     least({_edit("d.s", "2", "'D'")}, {_edit("d.e", "if(f.faulty or f.initial <> 's', 1000000, if(f.cut, 5, 0))", "'K'")}) as s,
     least({_edit("d.u", "2", "'D'")}, {_shift("d.e", "u")}, {_shift("d.s", "u")}, {_shift("d.a", "u")}) as u,
     least({_edit("d.a", "2", "'D'")}, {_shift("d.u", "a")}) as a
    from steps d join faults f on f.conv_id is not distinct from d.conv_id and f.i = d.i + 1
"""
_FAR = "{'c': 1000000, 'a': '~'}"
_BEGUN = f"select distinct conv_id, 0::bigint as i, {{'c': 0, 'a': ''}} as e, {_FAR} as s, {_FAR} as u, {_FAR} as a from conversations"

ORACLES["op11_conversation_repair"] = rf"""
with recursive coded as (
 select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  xor(4294967295, list_reduce(list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''), lambda c: cast(ascii(c) as bigint)),
   lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)), xor(c, b)), 4294967295::bigint)) % 20 as k
 from conversations
), damaged as (
 select conv_id, turn, case k when 4 then 'user' else role end as role,
  case k when 1 then '' when 2 then translate(text, '.!?', '') else text end as text, unnest(if(k = 3, [1, 2], [1])) as copy
 from coded where k <> 0
), numbered as (
 select *, left(role, 1) as initial, right(rtrim(text, E' 	

'), 1) as last,
  row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as i
 from damaged
), flagged as (
 select *, last = '' as blank, row_number() over (partition by conv_id, role, text order by i) > 1 as again, last not in ('.', '!', '?') as cut,
  lag(initial) over (partition by conv_id order by i) as before
 from numbered
), faults as (
 select *, blank or again as faulty from flagged
), steps as (
 {_step(_BEGUN)}
 union all
 {_step(_MOVED)}
), ended as (
 select conv_id, least(e, a) as best from steps qualify row_number() over (partition by conv_id order by i desc) = 1
), letters as (
 select conv_id, unnest(string_split(best.a, '')) as letter, unnest(range(1, length(best.a) + 1)) as p from ended where best.a <> ''
), placed as (
 select *, sum(cast(letter <> 'I' as bigint)) over so_far as i, sum(cast(letter <> 'D' as bigint)) over so_far as j from letters
 window so_far as (partition by conv_id order by p)
), kept as (
 select l.conv_id, l.p, l.j, l.letter, f.role, f.initial, f.text from placed l
 left join faults f on f.conv_id is not distinct from l.conv_id and f.i = l.i and l.letter <> 'I' where l.letter <> 'D'
), spoken as (
 select *, max(cast(j = 1 and letter = 'K' and initial = 's' as bigint)) over (partition by conv_id) as shift from kept
), lines as (
 select conv_id, string_agg(case when letter = 'K' then role when (j - shift) % 2 = 1 then 'user' else 'assistant' end || ':' || if(letter = 'I', '', text), chr(10) order by p) as t
 from spoken group by conv_id
), counted as (
 select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
  count(*) filter (again and not blank) as duplicate, count(*) filter (cut and not again and not blank) as truncated,
  count(*) filter (before || initial not in ('su', 'ua', 'au')) as illegal
 from faults group by conv_id
)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
 coalesce(illegal, 0) as illegal, cast(best.c as bigint) as cost, best.a as audit, sha256(coalesce(t, '')) as repaired_sha256
from ended e left join counted c on c.conv_id is not distinct from e.conv_id left join lines l on l.conv_id is not distinct from e.conv_id
"""
