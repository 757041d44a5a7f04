"""DuckDB texts of the queries that SQL can express.

The language model, the ordinal regression, the fingerprints, the minimum cut, and the tokenizers' merges have no SQL form.
"""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ESCAPED = r"replace(replace({}, '\', '\\'), '<|', '\l')"

OP1 = rf"""
with turns as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length('<|im_start|>' || {_ESCAPED.format('role')} || chr(10) || {_ESCAPED.format('text')} || '<|im_end|>' || chr(10))) as bigint)
    as formatted_chars,
  regexp_full_match(string_agg(role || ',', '' order by turn, role, text), '(system,)?user,(assistant,user,)*(assistant,)?') as valid
from turns group by conv_id
"""

OP6 = rf"""
with recursive words as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents
), sets as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) end) as shingle
  from words
), sizes as (select doc_id, count(*) as n from sets group by doc_id),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared
  from sets a join sets b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all
), links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * shared >= 75 * (x.n + y.n - shared)
), ways as (select a, b from links union all select b, a from links),
reach as (
  select doc_id as a, doc_id as b from sizes
  union
  select reach.a, ways.b from reach join ways on ways.a = reach.b
), least as (select a, min(b) as component_id from reach group by a)
select d.doc_id, coalesce(s.n, 0) as n_shingles, coalesce(l.component_id, d.doc_id) as component_id
from documents d left join sizes s using (doc_id) left join least l on l.a = d.doc_id
"""

OP8 = """
with texts as (
  select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n from documents
), starts as (
  select doc_id, 1000 * piece + k as p, md5(substring(part, 2 * k + 1, 400)) as code from (
    select doc_id, piece, part, unnest(range(0, least(1000, n - 199 - 1000 * piece))) as k from (
      select doc_id, n, piece, substring(h, 2000 * piece + 1, 2400) as part from (
        select doc_id, h, n, unnest(range(0, (n - 199 + 999) // 1000)) as piece from texts where n >= 200)))
), hits as (
  select doc_id, p from (select *, count(*) over (partition by code) as times from starts) where times > 1
), runs as (
  select doc_id, min(p) as a, max(p) + 200 as b from (
    select doc_id, p, sum(new) over (partition by doc_id order by p) as run from (
      select doc_id, p, case when p - lag(p) over (partition by doc_id order by p) <= 200 then 0 else 1 end as new from hits))
  group by doc_id, run
), kept as (
  select doc_id, sum(b - a) as n_removed, count(*) as n_spans, list({'a': a, 'b': b} order by a) as spans from runs group by doc_id
)
select doc_id, n as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(case when spans is null then unhex(h) else unhex(array_to_string(list_transform(range(0, len(spans) + 1), lambda k:
    case when k = 0 then substring(h, 1, 2 * spans[1].a)
      when k = len(spans) then substring(h, 2 * spans[k].b + 1)
      else substring(h, 2 * spans[k].b + 1, 2 * (spans[k + 1].a - spans[k].b)) end), '')) end) as kept_sha256
from texts left join kept using (doc_id)
"""

_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
OP10 = rf"""
with words as (
  select doc_id, regexp_extract_all({_LOWER}, {_WORD}) as w from documents
), items as (
  select item_id, regexp_extract_all({_LOWER}, {_WORD}) as w from benchmark where item_id is not null
), windows as (
  select distinct item_id, least(10, len(w)) as size,
    unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda k: array_to_string(w[k:k + least(10, len(w)) - 1], ' '))) as content
  from items where len(w) > 0
), sizes as (select distinct size from windows),
places as (
  select doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') as content
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as p from words, sizes where len(w) >= size)
), found as (select doc_id, p, size, item_id from places join windows using (size, content)),
hit as (select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(p, p + size)) as place from found) group by doc_id),
named as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hit using (doc_id) left join named using (doc_id)
"""

OP11 = """
with recursive kept as (
  select row_number() over () as row, vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), points as (
  select row, part, v[part * len(v) // 16 + 1:(part + 1) * len(v) // 16] as p from kept, range(16) r(part)
), firsts as (
  select row, row_number() over (order by vec_id nulls last, v) - 1 as entry from kept qualify entry < 64
), start as (select part, entry, p as c from firsts join points using (row)),
{rounds}
final as (
  select row, string_agg(printf('%02x', cast(entry as integer)), '' order by part) as code, cast(sum(away) as bigint) as error from assigned_2 group by row
), books as (
  select sha256(string_agg(cast(x as varchar), ',' order by part, entry, k)) as codebooks_sha256
  from (select part, entry, unnest(c) as x, unnest(range(len(c))) as k from books_2)
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from kept join final using (row), books
"""

_ROUND = """
assigned_{n} as (
  select row, part, p, min(away) as away, arg_min(entry, away * 64 + entry) as entry
  from (select row, part, p, entry, list_sum(list_transform(list_zip(p, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as away
    from points join {books} using (part)) group by row, part, p
),
"""
_MOVED = """
books_{n} as (
  select part, entry, coalesce(m, c) as c from {books} left join (
    select part, entry, list(x order by k) as m from (
      select part, entry, k, cast(floor(sum(x) / count(*)) as bigint) as x
      from (select part, entry, unnest(p) as x, unnest(range(len(p))) as k from assigned_{last}) group by part, entry, k)
    group by part, entry) using (part, entry)
),
"""
OP11 = OP11.replace("{rounds}", "".join([
    _ROUND.format(n=0, books="start"), _MOVED.format(n=1, books="start", last=0),
    _ROUND.format(n=1, books="books_1"), _MOVED.format(n=2, books="books_1", last=1),
    _ROUND.format(n=2, books="books_2"),
]))

OP13 = rf"""
with steps as (
  select list(c order by b) as tab from (
    select b, list_reduce(list_prepend(b, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
    from range(256) r(b))
), words as (
  select 0 as side, doc_id as id, regexp_extract_all({_LOWER}, {_WORD}) as w from documents
  union all select 1, item_id, regexp_extract_all({_LOWER}, {_WORD}) from benchmark
), features as (
  select side, id, unnest(list_concat(w, list_concat(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]),
    list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])))) as f from words
), spelled as (
  select f, hex(encode(f)) as h, count(*) filter (side = 0) as s, count(*) filter (side = 1) as t from features group by f
), bucketed as (
  select f, s, t, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(h), 2),
      lambda k: (instr('0123456789ABCDEF', h[k]) - 1) * 16 + instr('0123456789ABCDEF', h[k + 1]) - 1)),
    lambda c, x: xor(c >> 8, tab[xor(c & 255, x) + 1])), 4294967295) % 10000 as bucket from spelled, steps
), totals as (select sum(s) as all_s, sum(t) as all_t from spelled),
gains as (
  select bucket, floor(1000 * ln(cast((sum(t) + 1) * (any_value(all_s) + 10000) as double) / cast((sum(s) + 1) * (any_value(all_t) + 10000) as double))) as gain
  from bucketed, totals group by bucket
), weights as (
  select id as doc_id, count(*) as n_features, sum(gain) as weight
  from features join bucketed using (f) join gains using (bucket) where side = 0 group by id
), scored as (
  select id as doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
    cast(coalesce(weight, 0) as bigint)
      + cast(floor(-1000 * ln(-ln((cast('0x' || left(sha256('42:' || id), 8) as bigint) + 0.5) / 4294967296::double))) as bigint) as score
  from words left join weights on doc_id = id where side = 0
), ranked as (
  select doc_id, row_number() over (order by score desc, doc_id) as place from scored where n_words >= 20
)
select doc_id, n_features, n_words, weight, score,
  case when place <= (select 5 * count(*) // 100 from ranked) then place end as rank
from scored left join ranked using (doc_id)
"""

TEXTS = {"op11_vector_codes": OP11, "op13_resample": OP13, "op1_chat_format": OP1, "op6_jaccard_join": OP6, "op8_suffix_dedup": OP8, "op10_decontaminate": OP10}
