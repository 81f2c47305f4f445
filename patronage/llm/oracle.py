"""DuckDB SQL that computes the rows of the queries on its own."""

from __future__ import annotations

from patronage.llm.url_filter import MAX_BAD, TWO_LABEL_SUFFIXES, Z

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
          ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def _op4() -> str:
    cases = []
    for verdict, host, path in sorted(_RULES, key=lambda r: -len(r[1] + r[2])):
        fits = f"(host = '{host}' or host like '%.{host}') and starts_with(path, '{path}')"
        cases.append((fits, verdict, host + path))
    rule = "case " + " ".join(f"when {f} then '{r}'" for f, _, r in cases) + " end"
    verdict = "case " + " ".join(f"when {f} then '{v}'" for f, v, _ in cases) + " end"
    two = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
    level = """(with e as (select sum((s - n * prior) * (s - n * prior) - n * prior * (1 - prior)) as up,
        sum(n * prior * (1 - prior) * (n - 1)) as room from {t})
        select 1 / (case when room > 0 then least(0.5, greatest(0.001, up / room)) else 0.001 end) - 1 from e)"""
    return f"""
with split as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
cut as (
  select page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from split),
seen as (select page_id, coalesce(host, '') as host, coalesce(path, '') as path from cut),
counts as (select s.host, count(*)::double as n, sum(1 - l.quality)::double as s
  from seen s join labels l on l.doc_id = s.page_id where l.quality is not null group by s.host),
parts as (select host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') as bare,
  from (select distinct host from seen)),
labelled as (select host, bare, string_split(bare, '.') as l, regexp_matches(bare, '^[0-9.]+$') as address from parts),
named as (select host,
    case when address then bare when len(l) >= 2 and array_to_string(l[-2:], '.') in ({two})
      then array_to_string(l[-2:], '.') else l[-1] end as suffix,
    case when address then bare when len(l) >= 2 and array_to_string(l[-2:], '.') in ({two})
      then array_to_string(l[-3:], '.') else array_to_string(l[-2:], '.') end as domain from labelled),
h as (select host, domain, suffix, coalesce(n, 0) as n, coalesce(s, 0) as s from named left join counts using (host)),
d as (select domain, suffix, sum(n) as n, sum(s) as s from h group by all),
x as (select suffix, sum(n) as n, sum(s) as s from d group by all),
x1 as (select *, ((select sum(s) from x) - s + 1) / ((select sum(n) from x) - n + 2) as prior from x),
x2 as (select *, {level.format(t="x1")} as k from x1),
d1 as (select d.domain, d.n, d.s, (x2.s - d.s + x2.k * x2.prior) / (x2.n - d.n + x2.k) as prior from d join x2 using (suffix)),
d2 as (select *, {level.format(t="d1")} as k from d1),
h1 as (select h.host, h.n, h.s, (d2.s - h.s + d2.k * d2.prior) / (d2.n - h.n + d2.k) as prior from h join d2 using (domain)),
h2 as (select host, s + k * prior as a, n - s + k * (1 - prior) as b from (select *, {level.format(t="h1")} as k from h1)),
low as (select host, greatest(0, a / (a + b) - {Z} * sqrt(a * b / (a + b + 1)) / (a + b)) as bad_low from h2)
select page_id, host, path, {rule} as rule,
  coalesce({verdict}, case when bad_low > {MAX_BAD} then 'block' else 'allow' end) as verdict
from seen left join low using (host)"""


_OP3 = rf"""
with w as (select doc_id, {_WORDS} as w from documents),
win as (select doc_id, i, hash(array_to_string(w[i:i + 49], ' ')) as run, md5(array_to_string(w[i:i + 49], ' ')) as proof
  from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from w)),
first as (select run, proof, min(doc_id) as owner from win group by all),
gone as (select distinct doc_id, place from (
  select doc_id, unnest(range(i, i + 50)) as place from win join first using (run, proof) where doc_id > owner)),
word as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as place from w),
kept as (select doc_id, count(*) as n_kept, string_agg(word, ' ' order by place) as text
  from word anti join gone using (doc_id, place) group by doc_id)
select doc_id, len(w) as n_words, len(w) - coalesce(n_kept, 0) as n_removed, sha256(coalesce(text, '')) as kept_sha256
from w left join kept using (doc_id)"""

_OP5 = rf"""
with recursive w as (select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 3], ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) as i from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as joint from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all),
link as (select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * joint >= 85 * (x.n + y.n - joint)),
reach as (select doc_id, doc_id as other from w union select r.doc_id, l.b from reach r join link l on l.a = r.other)
select w.doc_id, coalesce(any_value(n), 0) as n_shingles, min(other) as component_id
from w left join n using (doc_id) join reach using (doc_id) group by w.doc_id"""

_OP7 = rf"""
with line as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as place from documents),
keyed as (select *, {_LOWER.format("regexp_replace(line, '^[ \\t\\n\\v\\f\\r]+|[ \\t\\n\\v\\f\\r]+$', '', 'g')")} as key from line),
repeated as (select key, max(doc_id) as last_doc from keyed where length(key) >= 20
  group by key having count(distinct doc_id) >= 3),
judged as (select k.*, r.key is not null and k.doc_id < r.last_doc as gone from keyed k left join repeated r on k.key = r.key)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '')) as kept_sha256
from judged group by doc_id"""

_OP8 = rf"""
with dw as (select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
iw as (select item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
sized as (select item_id, w, least(len(w), 10) as length from iw where len(w) > 0),
win as (select distinct item_id, length, array_to_string(w[i:i + length - 1], ' ') as run
  from (select *, unnest(range(1, len(w) - length + 2)) as i from sized)),
lengths as (select distinct length from win),
dwin as (select doc_id, i, length, array_to_string(w[i:i + length - 1], ' ') as run
  from (select doc_id, w, length, unnest(range(1, len(w) - length + 2)) as i from dw, lengths)),
hit as (select d.doc_id, d.i, d.length, x.item_id from dwin d join win x on d.run = x.run and d.length = x.length),
words as (select doc_id, count(distinct place) as n_hit
  from (select doc_id, unnest(range(i, i + length)) as place from (select distinct doc_id, i, length from hit)) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as item_list
  from (select distinct doc_id, item_id::varchar as item from hit) group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(item_list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join words using (doc_id) left join items using (doc_id)"""

_OP9 = rf"""
with t as (select doc_id, coalesce(text, '') as text from documents),
w as (select doc_id, text, {_WORDS} as w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from t),
grams as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from w)),
twice as (select doc_id, g from grams group by all having count(*) > 1),
rep as (select doc_id, count(distinct place) as n_repeat_words
  from (select doc_id, unnest([i, i + 1, i + 2]) as place from grams join twice using (doc_id, g)) group by doc_id),
m as (select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words, len(lines) as n_lines from w left join rep using (doc_id)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not (100 * n_symbols > 10 * n_words) and not (100 * n_dup_lines > 30 * n_lines)
    and not (word_chars < 2 * n_words) and not (word_chars > 20 * n_words) as kept
from b"""

# CRC-32 by its table, which is built from its polynomial.
_CRC_TABLE = """crc_steps as (select list(v order by i) as t from (select i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v from range(256) x(i)))"""


def _crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes; ``t`` of crc_steps must be in reach."""
    digit = "strpos('0123456789ABCDEF', substr(hex({0}), {1}, 1)) - 1"
    first, second = digit.format(text, "k"), digit.format(text, "k + 1")
    coded = f"list_transform(range(1, length(hex({text})), 2), lambda k: ({first}) * 16 + {second})"
    step = "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {coded}), {step}), 4294967295)"


_OP12 = rf"""
with recursive {_CRC_TABLE},
runs as (select doc_id::varchar as id, {_LOWER.format("unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+'))")} as run from documents),
marked as (select run, {_crc32("id || ':' || run")} as h from (select * from runs where length(run) >= 7), crc_steps),
changed as (select case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word from marked),
w as (select word, count(*) as n from changed where length(word) >= 7 group by word having count(*) >= 2),
place as (select word, unnest(range(1, length(word) + 1)) as i from w),
hole as (select word, substr(word, 1, i - 1) || '_' || substr(word, i + 1) as key, substr(word, 1, i - 1) || substr(word, i + 1) as shorter from place),
near as (select a.word, b.word as other from hole a join hole b using (key) where a.word <> b.word
  union select word, shorter from hole where shorter in (select word from w)
  union select shorter, word from hole where shorter in (select word from w)),
counted as (select a.word, count(*) as n_near, min(struct_pack(less := -b.n, word := b.word)) as best
  from near a join w b on b.word = a.other group by a.word),
judged as (select word, n, coalesce(n_near, 0) as n_near, case when -best.less >= 10 * n then best.word end as form,
    case when -best.less >= 10 * n then -best.less end as form_n from w left join counted using (word)),
chain as (select word, form as reached, 1 as steps from judged where form is not null
  union all select c.word, j.form, steps + 1 from chain c join judged j on j.word = c.reached where j.form is not null),
roots as (select word, max_by(reached, steps) as root from chain group by word)
select word, form, coalesce(root, word) as root, n, n_near, form_n from judged left join roots using (word)"""

_OP13 = rf"""
with recursive {_CRC_TABLE},
source as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {_crc32("(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 as kind from conversations, crc_steps),
damaged as (select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) as copy from source),
numbered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as r,
    row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as again from damaged),
judged as (select *, substr(role, 1, 1) as i, lag(substr(role, 1, 1)) over (partition by conv_id order by r) as i_before,
    case when not regexp_matches(text, '[^ 	-
]') then 'blank' when again then 'duplicate'
      when not regexp_matches(text, '[.!?][ 	-
]*$') then 'truncated' end as fault from numbered),
counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
    count(*) filter (where fault = 'truncated') as truncated,
    count(*) filter (where i_before is not null and i_before || i not in ('su', 'ua', 'au')) as illegal,
    count(*) as n from judged group by conv_id),
-- grammar states: 0 nothing, 1 after s, 2 after u, 3 after a
shift(state, i, following, role) as (values (0, 's', 1, null), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (2, 'a', 3, 'assistant'), (3, 'u', 2, 'user')),
inserts(state, following, price, edits, said) as (values (0, 0, 0, '', []::varchar[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
  (0, 2, 5, 'I', ['user:']), (1, 2, 5, 'I', ['user:']), (2, 3, 5, 'I', ['assistant:']), (3, 2, 5, 'I', ['user:']),
  (0, 3, 10, 'II', ['user:', 'assistant:']), (1, 3, 10, 'II', ['user:', 'assistant:'])),
walk as (
  select conv_id, 0::bigint as r, following as state, struct_pack(cost := price::bigint, audit := edits, said := said) as best
  from (select distinct conv_id from conversations), inserts where inserts.state = 0
  union all
  select conv_id, r, state, min(best) as best from (
    select m.conv_id, m.r, n.following as state,
      struct_pack(cost := m.cost + n.price, audit := m.audit || n.edits, said := list_concat(m.said, n.said)) as best
    from (
      select w.conv_id, j.r, e.following as state, w.best.cost + e.price as cost, w.best.audit || e.edit as audit,
        list_concat(w.best.said, e.said) as said
      from walk w join judged j on j.conv_id is not distinct from w.conv_id and j.r = w.r + 1,
      lateral (
        select w.state as following, 2 as price, 'D' as edit, []::varchar[] as said
        union all select s.following, case when j.fault is null then 0 else 5 end, 'K', [j.role || ':' || j.text]
          from shift s where s.state = w.state and s.i = j.i and (j.fault is null or j.fault = 'truncated')
        union all select s.following, case when j.fault is null then 1 else 6 end, 'R', [s.role || ':' || j.text]
          from shift s where s.state = w.state and s.role is not null and (j.fault is null or j.fault = 'truncated')
      ) e
    ) m join inserts n on n.state = m.state
  ) group by conv_id, r, state),
ends as (select w.conv_id, min(w.best) as best from walk w left join counts c on c.conv_id is not distinct from w.conv_id
  where w.r = coalesce(c.n, 0) and w.state in (0, 3) group by w.conv_id)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, best.cost as cost, best.audit as audit,
  sha256(array_to_string(best.said, chr(10))) as repaired_sha256
from ends e left join counts c on c.conv_id is not distinct from e.conv_id"""

ORACLES = {
    "op4_url_reputation": _op4(),
    "op3_suffix_automata": _OP3,
    "op5_adaptive_prefix": _OP5,
    "op7_line_runs": _OP7,
    "op8_winnowing": _OP8,
    "op9_rule_ledger": _OP9,
    "op12_permuterm": _OP12,
    "op13_glr_repair": _OP13,
}
