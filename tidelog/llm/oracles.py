"""SQL for the queries of this folder that SQL can express on whole tables.

Each states the result from its definition, without the method of the operator: rules and reachability, all inner
products, ranks by one window, all shared shingles, distinct sites by plain counts, one edit by words with a letter cut out. Trained scores (op1, op3, op10), a
search (op6) and edit distances within texts (op7) have none; tests/llm holds them against brute force.
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _attribute(name: str) -> str:
    forms = ("\"([^\"]*)\"", "''([^'']*)''", "([^\\s\"''>]+)")
    return "coalesce(" + ", ".join(
        f"nullif(regexp_extract(tag, '(?is)\\s{name}\\s*=\\s*{form}', 1), '')" for form in forms) + ")"


def _host(url: str) -> str:
    return f"translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}')"


def _node(url: str) -> str:
    rest = f"regexp_extract({url}, '(?s)^.*?://[^/?#]*([^#]*)', 1)"
    return (f"case when {_host(url)} != '' then {_host(url)} || "
            f"case when {rest} like '/%' then {rest} else '/' || {rest} end end")


RULES = """
rules (kind, host, path) as (values
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/'))"""


def _ruled(name: str, source: str, key: str) -> str:
    """(key, kind, rule) of the longest rule that fits the host and path of source's rows."""
    return f"""
{name} as (
  select s.{key}, r.kind, r.host || r.path as rule
  from {source} s join rules r
    on (s.host = r.host or ends_with(s.host, '.' || r.host)) and starts_with(s.path, r.path)
  qualify row_number() over (partition by s.{key} order by length(r.host || r.path) desc, r.host || r.path desc) = 1)"""


OP2 = f"""
with recursive {RULES},
tags as (
  select url, unnest(regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?is)<(?:link|meta)\\s[^>]*>')) as tag
  from pages where {_host('url')} != '' and (html ilike '%canonical%' or html ilike '%refresh%')),
found as (
  select url, trim(replace(case
      when tag ilike '<link%' and regexp_matches(lower({_attribute('rel')}), '(^|\\s)canonical(\\s|$)') then {_attribute('href')}
      when tag ilike '<meta%' and lower({_attribute('http-equiv')}) = 'refresh'
        then regexp_extract({_attribute('content')}, '(?i)url\\s*=\\s*[''"]?([^''"]+)', 1)
    end, '&amp;', '&')) as target
  from tags),
bases as (
  select url, target, regexp_extract(url, '(?s)^(.*?)://', 1) as scheme, {_host('url')} as host,
         regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from found where target != ''),
resolved as (
  select url, case
      when regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') then target
      when target like '//%' then scheme || ':' || target
      when target like '/%' then scheme || '://' || host || target
      when regexp_matches(target, '^([A-Za-z][A-Za-z0-9+.-]*:|#)') then null
      when target like '?%' then scheme || '://' || host || path || target
      else scheme || '://' || host || regexp_extract('/' || path, '^/?(/.*/|/)', 1) || regexp_replace(target, '^\\./', '')
    end as target
  from bases),
links as (
  select {_node('url')} as a, {_node('target')} as b from resolved where target is not null),
both_ways as (
  select a, b from links where b is not null union select b, a from links where b is not null),
reach as (
  select a, a as b from both_ways
  union
  select r.a, e.b from reach r join both_ways e on r.b = e.a),
places as (
  select distinct b as node, regexp_extract(b, '(?s)^([^/]*)', 1) as host, regexp_extract(b, '(?s)^[^/]*([^?]*)', 1) as path from reach),
{_ruled('node_rule', 'places', 'node')},
shared as (
  select r.a as node, min(n.kind) as kind from reach r join node_rule n on r.b = n.node group by r.a),
judged as (
  select page_id, url, coalesce({_host('url')}, '') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path, {_node('url')} as node,
         row_number() over () as row_id
  from pages),
{_ruled('page_rule', 'judged', 'row_id')}
select j.page_id, j.host, j.path, p.rule, coalesce(p.kind, s.kind, 'allow') as verdict,
       case when p.kind is not null then 'rule' when s.kind is not null then 'alias' else 'none' end as "by"
from judged j left join page_rule p using (row_id) left join shared s on j.node = s.node
"""

OP4 = """
with cells as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
  from cells q join cells c on q.vec_id % 50 = 0 and c.vec_id != q.vec_id)
select query_id, rank::integer as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
where rank <= 5
"""

# The reflected polynomial of CRC-32 is a fixed value; its table follows from it.
OP5 = """
with recursive steps (byte, step, c) as (
  select range, 0, range from range(256)
  union all
  select byte, step + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from steps where step < 8),
crc_table as (select list(c order by byte) as t from steps where step = 8),
whole as (
  select doc_id, source, coalesce(octet_length(encode(text)), 0) + 16 as size,
         case when text is not null then xor(4294967295, list_reduce(
           list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::bigint),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) end as text_crc32,
         ('0x' || substr(md5('42:' || coalesce(doc_id::varchar, '-')), 1, 13))::bigint as draw,
         ('0x' || substr(md5('42:' || coalesce(source, '-')), 1, 13))::bigint / 4503599627370496 as start
  from documents, crc_table),
in_source as (
  select *, count(*) over (partition by source) as held,
         row_number() over (partition by source order by draw, doc_id nulls first, text_crc32 nulls first, size) - 1 as rank
  from whole),
placed as (
  select *, count(*) over () as total,
         row_number() over (order by (rank + start) / held, source nulls first, rank) - 1 as position
  from in_source),
cut as (select *, (position * 40) // total as shard from placed)
select doc_id, size, text_crc32, 'rows' as law, shard::integer as shard,
       position - (shard * total + 39) // 40 as slot, null::integer as grown_shard
from cut
"""

OP8 = f"""
with recursive worded as (
  select doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') as w from documents),
shingled as (
  select doc_id, list_distinct(case
      when len(w) = 0 then []
      when len(w) < 5 then [array_to_string(w, ' ')]
      else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
  from worded),
sizes as (select doc_id, coalesce(len(s), 0) as n from shingled),
single as (select doc_id, unnest(s) as s from shingled),
in_common as (
  select x.doc_id as a, y.doc_id as b, count(*) as both_have
  from single x join single y on x.s = y.s and x.doc_id != y.doc_id group by x.doc_id, y.doc_id),
links as materialized (
  select a, b from in_common join sizes p on p.doc_id = a join sizes q on q.doc_id = b
  where 100 * both_have >= 85 * (p.n + q.n - both_have)),
reach as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, l.b from reach r join links l on r.b = l.a),
smallest as (select a, min(b) as component_id from reach group by a)
select s.doc_id, s.n::bigint as n_shingles, m.component_id, s.doc_id = m.component_id as kept
from sizes s join smallest m on m.a = s.doc_id
"""

OP9 = """
with split as (
  select row_number() over () as row_id, doc_id, text, source,
         case when text is null then [] else string_split(text, chr(10)) end as lines
  from documents),
lined as (
  select row_id, doc_id, source, unnest(lines) as raw, generate_subscripts(lines, 1) as line_no from split),
bad as (
  select trim(raw) as line, min(doc_id) as home from lined where trim(raw) != ''
  group by trim(raw) having count(distinct source) >= 10),
marked as (
  select l.row_id, l.raw, l.line_no, b.home is not null and l.doc_id is distinct from b.home as goes
  from lined l left join bad b on trim(l.raw) = b.line),
left_over as (
  select row_id, count(*) as n_lines, count(*) filter (goes) as n_removed,
         string_agg(raw, chr(10) order by line_no) filter (not goes) as rest,
         coalesce(bool_or(trim(raw) != '') filter (not goes), false) as has_rest
  from marked group by row_id)
select s.doc_id, coalesce(n_lines, 0)::integer as n_lines, coalesce(n_removed, 0)::integer as n_removed,
       md5(case when coalesce(n_removed, 0) = 0 then s.text else coalesce(rest, '') end) as clean_md5,
       coalesce(n_removed, 0) = 0 as unchanged, coalesce(has_rest, false) as has_rest
from split s left join left_over o using (row_id)
"""

OP13 = f"""
with recursive steps (byte, step, c) as (
  select range, 0, range from range(256)
  union all
  select byte, step + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from steps where step < 8),
crc_table as (select list(c order by byte) as t from steps where step = 8),
runs as (
  select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00c0-\u00ff]+')), '{UPPER}', '{LOWER}') as run from documents),
held as (select doc_id, run, count(*) as n from runs where length(run) >= 5 group by doc_id, run),
hashed as (
  select doc_id, run, n, case when doc_id is not null then xor(4294967295, list_reduce(
      list_transform(regexp_extract_all(hex(encode(doc_id::varchar || ':' || run)), '..'), lambda h: ('0x' || h)::bigint),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) end as h
  from held, crc_table),
slipped as (
  select case when h % 97 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, n
  from hashed),
words as (select word, sum(n)::bigint as n from slipped where length(word) >= 5 group by word having sum(n) >= 3),
cut as (
  select word, n, i, left(word, i - 1) || substr(word, i + 1) as rest
  from (select word, n, unnest(range(1, length(word) + 1))::int as i from words)),
near as (
  select a.word, b.word as near, b.n as near_n from cut a join cut b on a.i = b.i and a.rest = b.rest and a.word != b.word
  union
  select c.word, w.word, w.n from cut c join words w on c.rest = w.word
  union
  select w.word, c.word, c.n from cut c join words w on c.rest = w.word),
best as (
  select word, count(*) as n_near, min(struct_pack(less := -near_n, near := near)) as best from near group by word),
forms as (
  select w.word, w.n, coalesce(b.n_near, 0) as n_near, case when -b.best.less >= 2 * w.n then b.best.near end as form,
         case when -b.best.less >= 2 * w.n then -b.best.less end as form_n
  from words w left join best b using (word)),
walk as (
  select word, word as place, 0 as k from forms
  union all
  select w.word, f.form, w.k + 1 from walk w join forms f on f.word = w.place where f.form is not null)
select f.word, f.form, w.root, f.n, f.n_near, f.form_n
from forms f join (select word, arg_max(place, k) as root from walk group by word) w using (word)
"""

ORACLES = {
    "op2_redirect_filter": OP2,
    "op4_cover_tree_topk": OP4,
    "op5_stratified_shards": OP5,
    "op8_minhash_dedup": OP8,
    "op9_line_spread": OP9,
    "op13_two_way_spelling": OP13,
}
