"""SQL twins of the registered queries."""

from __future__ import annotations

from shelfmark.operators.context import DEFAULT_TEMPLATE
from workload.views import GRAPH, GRAPH_TYPE, PREDICATE, SOFTWARE

_SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

_TRIPLES = f"""
triples as (
  select 'https://kg.example/entity/Q' || c_custkey as s, '{PREDICATE}' as p,
         case when c_mktsegment in ('BUILDING', 'MACHINERY') then '{SOFTWARE}' else 'Q2' end as o,
         c_acctbal
  from customer),
items as (
  select regexp_replace(s, '^.*/', '') as qid, c_acctbal from triples
  where p = '{PREDICATE}' and o = '{SOFTWARE}')"""

_OBJECTS = """
objects as (
  select o_orderkey, o_orderstatus, o_orderdate, o_orderpriority,
    case when o_orderkey % 10 = 0 then 'main/other/order_' || o_orderkey || '.txt'
    else 'main/' || substr(lpad(o_custkey::varchar, 6, '0'), 1, 2) || '/'
      || substr(lpad(o_custkey::varchar, 6, '0'), 3, 2) || '/'
      || substr(lpad(o_custkey::varchar, 6, '0'), 5, 2) || '/Q' || o_custkey
      || '/components/pkg' || (o_orderkey % 50) || '_' || (o_orderkey % 7) || '.' || o_orderkey
      || case o_orderkey % 4 when 0 then '.pdf' when 1 then '.PDF' when 2 then '.html' else '.csv' end
    end as k
  from orders),
listed as (
  select *, list_filter(string_split(k, '/'), lambda x: regexp_full_match(x, 'Q[0-9]+'))[-1] as qid
  from objects
  where lower(k) like '%.pdf' or lower(k) like '%.html' or lower(k) like '%.txt'),
files as (select qid, k as component, o_orderdate, o_orderstatus, o_orderpriority from listed where qid is not null),
status as (
  select qid, component, o_orderdate as updated_at,
    case o_orderstatus when 'F' then 'ok' when 'P' then 'planned' else 'failed - TimeoutError' end as status
  from files where o_orderpriority <> '5-LOW')"""

_BACKLOG = """
retry as (
  select f.qid, f.component from items i join files f on f.qid = i.qid
  left join status e on e.qid = f.qid and e.component = f.component
  where e.status is null or e.status not in ('ok', 'planned')),
fresh as (
  select f.qid, f.component from files f join items i on i.qid = f.qid
  left join status e on e.qid = f.qid and e.component = f.component
  where e.qid is null)"""

_STATE = f"with {_TRIPLES},{_OBJECTS},{_BACKLOG}"

_EVENTS = """
with events_status as (
  select 'Q' || user_id as qid, event_type as component, ts as updated_at, event_id,
    case event_id % 3 when 0 then 'ok' when 1 then 'planned' else 'failed - TimeoutError' end as status
  from events)"""

_TALKS = """
talks as (
  select 'Q' || conv_id as qid, 'talk_' || conv_id || '.txt' as component, turn as page, text, conv_id
  from conversations)"""

_DOCS = f"""
docs as (
  select doc_id, 'Q' || doc_id as qid, 'docs/' || source || '_1.' || doc_id || '.txt' as component,
    source as package, '1.' || doc_id as version, lang || ': document ' || doc_id as title, text,
    case doc_id % 4 when 0 then 'CRAN_PACKAGE' when 1 then '{GRAPH_TYPE}' when 2 then 'PUBLICATION' else 'OTHER' end
      as document_type
  from documents)"""


def _windows(source: str, keys: str, size: int, overlap: int) -> str:
    """Fixed windows of a text column as rows (keys, pos, piece)."""
    step = size - overlap
    count = (
        f"case when length(text) > {size} then 1 + cast(ceil((length(text) - {size}) / {float(step)}) as bigint) else 1 end"
    )
    return f"""
pieces as (
  select {keys}, pos, case when length(text) > {size} then substr(text, pos * {step} + 1, {size}) else text end as piece
  from (select *, unnest(range(0, {count})) as pos from {source}))"""


def _hashed(name: str, source: str, keys: str, dim: int = 64) -> str:
    """Hashed bag-of-words vectors, sparse: (keys, b, w) with single-precision weights."""
    return f"""
{name}_tokens as (
  select {keys}, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) as tok from {source}),
{name}_counts as (
  select {keys}, ('0x' || substr(md5(tok), 1, 8))::bigint % {dim} as b, count(*) as c
  from {name}_tokens where tok <> '' group by all),
{name}_norms as (select {keys}, sqrt(sum(c * c)) as n from {name}_counts group by all),
{name} as (select {keys}, b, (c / n)::float::double as w from {name}_counts join {name}_norms using ({keys}))"""


def _bm25(k: int) -> str:
    """BM25 of the words of each benchmark item over all documents, every posting read."""
    split = "unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'))"
    return f"""
b_words as (select doc_id, tok, count(*) as tf from (select doc_id, {split} as tok from documents) where tok <> '' group by all),
b_asked as (select distinct item_id, tok from (select item_id, {split} as tok from benchmark) where tok <> ''),
b_len as (select doc_id, sum(tf) as len from b_words group by 1),
b_all as (select (select count(*) from documents) as n, (select sum(len) from b_len) / (select count(*) from documents) as avg),
b_df as (select tok, count(*) as df from b_words group by 1),
b_scored as (
  select item_id as query_id, doc_id as id,
    round(sum(ln(1 + (n - df + 0.5::double) / (df + 0.5::double)) * (tf * 2.2::double) / (tf + 1.2::double * (0.25::double + 0.75::double * len / avg))), 6) as score
  from b_asked join b_words using (tok) join b_len using (doc_id) join b_df using (tok), b_all group by all),
b_ranked as (
  select *, row_number() over (partition by query_id order by score desc, id) as rank from b_scored qualify rank <= {k})"""


def _uuid5(name: str) -> str:
    digest = f"sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode({name}))"
    return (
        f"substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-5' || substr({digest}, 14, 3) || '-' || "
        f"translate(substr({digest}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({digest}, 18, 3) || '-' || "
        f"substr({digest}, 21, 12)"
    )


def _knn(expression: str, direction: str, k: int) -> str:
    return f"""
with pairs as (
  select q.vec_id as query_id, c.vec_id as id, round({expression}, 6) as score
  from (select vec_id, embedding::double[] as e from embeddings) q,
       (select vec_id, embedding::double[] as e from embeddings) c),
ranked as (
  select *, row_number() over (partition by query_id order by score {direction}, id) as rank from pairs)
select query_id, id, score, rank from ranked where rank <= {k}"""


_RETRIEVED = f"""
with questions as (
  select conv_id || '-' || turn as query_id, text from conversations where role = 'user'),
{_hashed("q", "questions", "query_id")},
{_hashed("d", "documents", "doc_id")},
q_len as (select query_id, sqrt(sum(w * w)) as n from q group by 1),
d_len as (select doc_id, sqrt(sum(w * w)) as n from d group by 1),
dots as (select query_id, doc_id, sum(q.w * d.w) as s from q join d using (b) group by all),
pairs as (
  select qq.query_id, dd.doc_id as id, round(coalesce(s / (ql.n * dl.n), 0), 6) as score
  from questions qq cross join documents dd
  left join dots on dots.query_id = qq.query_id and dots.doc_id = dd.doc_id
  left join q_len ql on ql.query_id = qq.query_id left join d_len dl on dl.doc_id = dd.doc_id),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, id) as rank from pairs),
contexts as (
  select query_id, string_agg(text, chr(10) || chr(10) order by rank) as context
  from ranked join documents on doc_id = id where rank <= 3 group by 1)"""


def _semantic(size: int, percentile: float, dim: int = 64) -> str:
    """Sentences, windows of one neighbour each side, distances, breaks, greedy merge."""
    return f"""
with recursive sentence_lists as (
  select doc_id, string_split(regexp_replace(text, '([.?!]){_SPACE}+', '\\1' || chr(57344), 'g'), chr(57344)) as parts
  from documents),
sents as (
  select doc_id, unnest(range(0, len(parts))) as pos, unnest(parts) as s, len(parts) as n from sentence_lists),
wins as (
  select doc_id, pos, n, s, length(s) as size,
    coalesce(lag(s) over w || ' ', '') || s || coalesce(' ' || lead(s) over w, '') as text
  from sents window w as (partition by doc_id order by pos)),
tokens as (select doc_id, pos, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) as tok from wins where n > 2),
counts as (
  select doc_id, pos, ('0x' || substr(md5(tok), 1, 8))::bigint % {dim} as b, count(*)::double as c
  from tokens where tok <> '' group by all),
norms as (select doc_id, pos, sum(c * c) as n2 from counts group by all),
dots as (
  select a.doc_id, a.pos, sum(a.c * z.c) as s
  from counts a join counts z on z.doc_id = a.doc_id and z.pos = a.pos + 1 and z.b = a.b group by all),
dists as (
  select w.doc_id, w.pos, round(1 - coalesce(dots.s / sqrt(l.n2 * r.n2), 0), 9) as dist
  from wins w left join dots using (doc_id, pos)
  left join norms l on l.doc_id = w.doc_id and l.pos = w.pos
  left join norms r on r.doc_id = w.doc_id and r.pos = w.pos + 1
  where w.n > 2 and w.pos < w.n - 1),
limits as (select doc_id, round(quantile_cont(dist, {percentile}), 9) as cut from dists group by 1),
marked as materialized (
  select w.doc_id, w.pos, w.size, coalesce(dist > cut, false) as brk
  from wins w left join dists using (doc_id, pos) left join limits using (doc_id)),
merged as (
  select doc_id, pos, 0 as chunk, 0::bigint as start_index, size::bigint as len, brk and size >= {size} as closed
  from marked where pos = 0
  union all
  select m.doc_id, m.pos, case when p.closed then p.chunk + 1 else p.chunk end,
    case when p.closed then p.start_index + p.len else p.start_index end,
    case when p.closed then m.size else p.len + 1 + m.size end,
    m.brk and case when p.closed then m.size else p.len + 1 + m.size end >= {size}
  from merged p join marked m on m.doc_id = p.doc_id and m.pos = p.pos + 1),
chunked as (
  select doc_id, chunk, max(start_index) as start_index, string_agg(s, ' ' order by pos) as text
  from merged join sents using (doc_id, pos) group by all)"""


def _prompt_sql() -> str:
    text = DEFAULT_TEMPLATE.replace("'", "''")
    lead, rest = text.split("{context}")
    middle, tail = rest.split("{question}")
    return f"'{lead}' || coalesce(context, '') || '{middle}' || text || '{tail}'"


_PREFIX = f"""case
    when document_type = 'CRAN_PACKAGE' then 'Package ' || package || '. '
    when document_type = '{GRAPH_TYPE}' then '{GRAPH} item ' || qid || '. '
    when document_type = 'PUBLICATION' then 'Publication ' || title || '. '
    else '' end"""

_DURATION = """case when s is null or s <= 0 then 'unknown'
    when floor(s / 3600) > 0 then (floor(s / 3600)::bigint) || 'h ' || (floor(s / 60)::bigint % 60) || 'm'
    when floor(s / 60) > 0 then (floor(s / 60)::bigint) || 'm ' || (floor(s)::bigint % 60) || 's'
    else (floor(s)::bigint) || 's' end"""


def sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["item_list_from_triples"] = f"with {_TRIPLES} select qid from items order by qid"
    q["item_list_page"] = f"with {_TRIPLES} select qid from items order by qid limit 50 offset 10"
    q["items_incremental_anti"] = f"with {_TRIPLES} select qid from items where not c_acctbal > 0"
    q["items_offset"] = f"""with {_TRIPLES}
select qid from items order by qid offset (select count(*) from items where c_acctbal > 0)"""
    q["items_from_bindings"] = "select 'Q' || c_custkey as qid from customer where c_mktsegment <> 'FURNITURE'"
    q["shard_paths"] = f"""with {_TRIPLES}
select qid, substr(d, 1, 2) || '/' || substr(d, 3, 2) || '/' || substr(d, 5, 2) || '/' || qid as path
from (select qid, lpad(substr(qid, 2), greatest(6, length(qid) - 1)::int, '0') as d from items)"""
    q["file_index"] = f"{_STATE} select qid, component from files"
    q["file_index_summary"] = (
        f"{_STATE} select count(qid) as n_indexed, count(*) - count(qid) as n_skipped from listed"
    )
    q["component_listing"] = f"""{_STATE}
select i.qid, string_split(k, '/')[-1] as component_name
from items i join objects o on starts_with(o.k,
  'main/' || substr(lpad(substr(i.qid, 2), 6, '0'), 1, 2) || '/' || substr(lpad(substr(i.qid, 2), 6, '0'), 3, 2)
  || '/' || substr(lpad(substr(i.qid, 2), 6, '0'), 5, 2) || '/' || i.qid || '/components/')"""
    q["qid_overlap_count"] = (
        f"{_STATE} select count(*) as n from (select i.qid from items i join files f on f.qid = i.qid group by i.qid)"
    )
    q["backlog_new"] = f"{_STATE} select qid, component from fresh"
    q["backlog_retry"] = f"{_STATE} select qid, component from retry order by qid, component"
    packaged = """packaged as (
  select qid, component, n // 10 as package, n % 10 as position
  from (select *, row_number() over (order by qid, component) - 1 as n from retry))"""
    q["work_packages"] = f"{_STATE}, {packaged} select qid, component, package, position from packaged where package < 20"
    q["backlog_batches"] = f"{_STATE}, {packaged} select qid, component, package, position from packaged"
    q["plan_documents"] = f"""{_STATE}, {packaged}
select 'plan_localworker_' || case when package < 9 then '0' else '' end || (package + 1) as package_id,
  '{{"planner_version":"1.0","created_at":"2024-01-01T00:00:00+00:00","state_db_checksum":"none","package_id":"plan_localworker_'
  || case when package < 9 then '0' else '' end || (package + 1) || '","entries":['
  || string_agg('{{"qid":"' || qid || '","component":"' || component || '","document_type":"CRAN_PACKAGE"}}', ',' order by position)
  || ']}}' as body
from packaged group by package"""
    q["plan_files"] = f"""{_STATE},
placed as (select qid, component, row_number() over (order by qid, component) - 1 as n from retry)
select 'plan_localworker_' || case when n // 100 < 9 then '0' else '' end || (n // 100 + 1) as package_id,
  n % 100 as position, qid, component from placed"""
    q["plan_entries"] = f"""{_STATE}
select qid, k as component, qid is not null as is_valid from listed"""
    q["status_upsert"] = f"""{_STATE}, {packaged},
planned as (select qid, component from packaged where package < 20)
select s.qid, s.component, strftime(s.updated_at, '%Y-%m-%d %H:%M:%S') as updated_at, s.status
from status s anti join planned p on p.qid = s.qid and p.component = s.component
union all select qid, component, '2024-01-01 00:00:00', 'planned' from planned"""
    latest = f"""{_EVENTS}
select qid, component, strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f') as updated_at, status from (
  select *, row_number() over (partition by qid, component order by updated_at desc, status desc) as rn from events_status)
where rn = 1"""
    q["status_latest_events"] = latest
    counts = """counts as (
  select 'software_index' as tbl, 0 as pos, count(*) as n from items
  union all select 'component_index', 1, count(*) from files
  union all select 'embeddings_index', 2, count(*) from status),
before as (
  select 'software_index' as tbl, count(*) as n from items where c_acctbal > 0
  union all select 'component_index', count(*) from files where o_orderdate < timestamp '1998-01-01'),
deltas as (select c.tbl, pos, c.n, c.n - coalesce(b.n, 0) as delta from counts c left join before b using (tbl))"""
    q["state_counts"] = f"{_STATE}, {counts} select tbl as \"table\", n, delta from deltas"
    q["state_message"] = f"""{_STATE}, {counts}
select 'Updated state tables [' || string_agg(tbl || ':' || n || ' (' || case when delta >= 0 then '+' else '' end || delta || ')',
  '; ' order by pos) || ']' as message from deltas"""
    q["max_updated_freshness"] = f"""{_STATE}
select strftime(max(updated_at), '%Y-%m-%d %H:%M:%S') as updated_at,
  max(updated_at) > timestamp '2001-08-01 00:30:00' - interval 1 hour as is_fresh
from status"""
    q["state_publish"] = f"{_STATE}, {counts} select tbl as \"table\", n from counts"
    q["table_fingerprint"] = f"{_STATE} select count(*) as n, true as stable, true as sensitive from status"
    q["package_version"] = """
with named as (
  select p_partkey,
    'lib/' || replace(p_name, ' ', '_') || case when p_size % 3 = 0 then '' else '_' || p_size || '.0' end || '.tar.pdf' as component,
    case when p_size % 2 = 0 then p_brand || ' : ' || p_type else p_type end as title
  from part),
stems as (select *, regexp_replace(string_split(component, '/')[-1], '\\.[^.]*$', '') as stem from named)
select p_partkey,
  case when regexp_full_match(stem, '(?s).+_[0-9][^_]*') then regexp_extract(stem, '(?s)^(.+)_([0-9][^_]*)$', 1)
       when contains(title, ':') then trim(string_split(title, ':')[1]) else 'unknown' end as package,
  case when regexp_full_match(stem, '(?s).+_[0-9][^_]*') then regexp_extract(stem, '(?s)^(.+)_([0-9][^_]*)$', 2)
       else 'unknown' end as version
from stems"""
    q["doc_page_stats"] = f"""with {_TALKS}
select qid, component, count(*) as n_pages, sum(length(text))::bigint as n_chars from talks group by all"""
    q["page_guard_status"] = f"""with {_TALKS}
select qid, component, count(*) as n_pages, 'failed - PDF too large (' || count(*) || ' pages)' as status
from talks group by qid, component having count(*) > 5"""
    q["pages_within_limit"] = f"""with {_TALKS}
select qid, component, page from talks
where (qid, component) not in (select (qid, component) from talks group by qid, component having count(*) > 5)"""
    q["fixed_chunks"] = f"""with {_DOCS}, {_windows("docs", "qid, component", 1600, 100)}
select qid, component, pos as chunk_index, length(piece) as n_chars, md5(piece) as text_md5 from pieces"""
    q["chunk_outliers"] = f"""with {_DOCS}, {_windows("docs", "qid, component", 1600, 100)}
select count(*) filter (n < 900 or n > 1600) as n_outliers, count(*) as n_chunks,
  min(n) filter (n < 900 or n > 1600) as shortest, max(n) filter (n < 900 or n > 1600) as longest
from (select length(piece) as n from pieces)"""
    numbered = f"""numbered as (
  select *, row_number() over (partition by qid, component order by page, pos) - 1 as chunk_index from pieces)"""
    normal = f"""normal as (
  select * replace (regexp_replace(text, '([.?!]){_SPACE}+', '\\1 ', 'g') as text) from talks)"""
    q["default_chunks"] = f"""with {_TALKS}, {normal}, {_windows("normal", "qid, component, page", 1600, 100)}, {numbered}
select qid, component, page, chunk_index, md5(piece) as text_md5 from numbered"""
    summed = f"""embedded as (select *, {_PREFIX} || piece as text, qid || '-' || pos as point from pieces),
{_hashed("v", "embedded", "point")},
sums as (select point, round(sum(w * (b + 1)), 4) as vector_sum from v group by point)"""
    pieces = _windows("docs", "qid, component, package, version, document_type, title", 1600, 100)
    q["chunk_points"] = f"""with {_DOCS}, {pieces}, {summed}
select {_uuid5("point")} as id, qid, pos::varchar as chunk_index, package, version, document_type, md5(piece) as text_md5,
  coalesce(vector_sum, 0) as vector_sum
from embedded left join sums using (point)"""
    q["points_upsert"] = f"""with {_DOCS}, {pieces}, {summed}
select {_uuid5("point")} as id, qid, md5(piece) as text_md5, coalesce(vector_sum, 0) as vector_sum
from embedded left join sums using (point)"""
    q["embedding_prefix"] = f"""with {_DOCS}
select doc_id, {_PREFIX} as prefix, md5({_PREFIX} || text) as embedded_md5 from docs"""
    q["html_pages"] = f"""
with visible as (
  select page_id, html, regexp_replace(regexp_replace(html,
    '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<title\\b.*?</title\\s*>', ' ', 'g'),
    '<[^>]*>', ' ', 'g') as t,
    regexp_extract(html, '(?is)<title[^>]*>(.*?)</title\\s*>', 1) as title
  from pages),
decoded as (
  select page_id,
    replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)),
      '&nbsp;', ' '), '&amp;', '&') as t,
    replace(replace(replace(replace(replace(replace(title, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)),
      '&nbsp;', ' '), '&amp;', '&') as title
  from visible)
select page_id, nullif(regexp_replace(title, '^{_SPACE}+|{_SPACE}+$', '', 'g'), '') as title,
  md5(regexp_replace(regexp_replace(t, '{_SPACE}+', ' ', 'g'), '^ | $', '', 'g')) as text_md5
from decoded"""
    q["file_roundtrip"] = f"""
select p.page_id, 'Q' || (p.page_id % 97) as qid, strlen(p.html) as size, md5(p.html) as content_md5, h.title, h.text_md5
from pages p join ({q["html_pages"]}) h using (page_id)"""
    q["hash_embedding"] = f"""
with {_hashed("v", "conversations", "conv_id, turn")}
select conv_id, turn, b as bucket, round(w, 6) as weight from v"""
    q["embed_repeated"] = f"""
with {_hashed("v", "documents", "doc_id")},
sums as (select doc_id, round(sum(w * (b + 1)), 4) as total from v group by 1),
texts as (select coalesce(text, '') as t, bool_and(doc_id % 2 <> 0) as late from documents group by 1)
select doc_id, (select count(*) from texts where late) as n_given, coalesce(total, 0) as vector_sum
from documents left join sums using (doc_id)"""
    q["vector_normalize"] = """
with vectors as (select vec_id, label, embedding::double[] as e from embeddings),
scaled as (select vec_id, list_transform(e, lambda x: x * (label + 2)) as e from vectors)
select vec_id, unnest(range(0, len(e))) as at,
  round(unnest(list_transform(e, lambda x: (x / sqrt(list_sum(list_transform(e, lambda y: y * y))))::float::double)), 6) as value
from scaled"""
    q["knn_cosine"] = _knn("list_cosine_similarity(q.e, c.e)", "desc", 30)
    q["knn_dot"] = _knn("list_inner_product(q.e, c.e)", "desc", 30)
    q["knn_euclid"] = _knn("list_distance(q.e, c.e)", "asc", 30)
    q["knn_manhattan"] = _knn(
        "list_sum(list_transform(list_zip(q.e, c.e), lambda p: abs(p[1] - p[2])))", "asc", 30
    )
    q["knn_blocked"] = _knn("list_cosine_similarity(q.e, c.e)", "desc", 10)
    q["retrieve_text"] = f"""{_RETRIEVED}
select query_id, id, score, rank, md5(text) as text_md5 from ranked join documents on doc_id = id where rank <= 30"""
    q["retrieve_with_vectors"] = f"""{_RETRIEVED}
select query_id, id, rank, coalesce(total, 0) as vector_sum, md5(text) as text_md5
from ranked join documents on doc_id = id left join (select doc_id as of, round(sum(w * (b + 1)), 4) as total from d group by 1) on of = id
where rank <= 5"""
    q["rag_context"] = f"{_RETRIEVED} select query_id, context from contexts"
    q["rag_prompt"] = f"""{_RETRIEVED}
select query_id, {_prompt_sql()} as prompt from questions left join contexts using (query_id)"""
    tokens = """
tokens as (
  select distinct doc_id, tok from (
    select doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) as tok from documents)
  where tok <> '')"""
    wanted = """
wanted as (
  select distinct item_id, tok from (
    select item_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) as tok from benchmark)
  where tok <> ''),
sizes as (select item_id, count(*) as n from wanted group by 1),
matched as (select item_id as query_id, doc_id as id, count(*) as n_matched from wanted join tokens using (tok) group by all)"""
    q["text_postings"] = f"with {tokens} select tok as token, doc_id as id from tokens"
    q["token_frequency"] = f"with {tokens} select tok as token, count(*) as n_docs from tokens group by 1"
    q["lexical_match_all"] = f"""with {tokens}, {wanted}
select query_id, id, n_matched from matched join sizes on item_id = query_id where n_matched = n"""
    q["text_index_lookup"] = q["lexical_match_all"]
    q["lexical_match_any"] = f"""with {tokens}, {wanted},
frequency as (select tok, count(*) as df from tokens group by 1),
scored as (
  select item_id as query_id, doc_id as id, count(*) as n_matched, round(sum(1.0::double / df), 9) as score
  from wanted join tokens using (tok) join frequency using (tok) group by all),
best as (select *, row_number() over (partition by query_id order by score desc, id) as rank from scored)
select query_id, id, n_matched, score, rank from best where rank <= 20"""
    q["lexical_bm25"] = f"with {_bm25(20)} select query_id, id, score, rank from b_ranked"
    q["hybrid_search"] = f"""
with items as (select item_id as query_id, text from benchmark),
{_hashed("q", "items", "query_id")}, {_hashed("d", "documents", "doc_id")},
q_len as (select query_id, sqrt(sum(w * w)) as n from q group by 1),
d_len as (select doc_id, sqrt(sum(w * w)) as n from d group by 1),
dots as (select query_id, doc_id, sum(q.w * d.w) as s from q join d using (b) group by all),
near as (
  select i.query_id, dd.doc_id as id, round(coalesce(s / (ql.n * dl.n), 0), 6) as score
  from items i cross join documents dd
  left join dots on dots.query_id = i.query_id and dots.doc_id = dd.doc_id
  left join q_len ql on ql.query_id = i.query_id left join d_len dl on dl.doc_id = dd.doc_id),
both_ranks as (
  select query_id, id::varchar as id, row_number() over (partition by query_id order by score desc, id::varchar) as rank from near qualify rank <= 30
  union all
  select query_id, id::varchar, row_number() over (partition by query_id order by score desc, id::varchar) as rank
  from ({{bm}}) qualify rank <= 30),
summed as (select query_id, id, round(sum(1.0::double / (rank + 60)), 9) as score from both_ranks group by all)
select *, row_number() over (partition by query_id order by score desc, id) as rank from summed qualify rank <= 10""".replace(
        "{bm}", f"with {_bm25(1_000_000)} select * from b_scored"
    )
    q["collection_lexical"] = """
with texts as (
  select doc_id::varchar as id, case when doc_id % 3 = 0 then 'rewritten ' || text else text end as t from documents),
words as (select distinct id, unnest(regexp_split_to_array(lower(t), '[^\\p{L}\\p{N}]+')) as tok from texts)
select 1 as query_id, id, 1::bigint as n_matched from words where tok = 'rewritten'
union all select 2, id, 2 from words where tok in ('the', 'of') group by id having count(*) = 2"""
    q["knn_lsh"] = """
with e as (select vec_id, embedding::double[] as e from embeddings),
planes as (
  select t, b, list(case when md5(t || ':' || b || ':' || d)[1] >= '8' then 1.0::double else -1.0::double end order by d) as s
  from range(8) a(t), range(6) x(b), range(64) y(d) group by t, b),
codes as (
  select vec_id, t, sum(case when list_inner_product(e, s) > 0 then 1 << b::int else 0 end) as code
  from e, planes group by vec_id, t),
near as (select distinct q.vec_id as query_id, c.vec_id as id from codes q join codes c on q.t = c.t and q.code = c.code),
scored as (
  select query_id, id, round(list_cosine_similarity(a.e, c.e), 6) as score
  from near join e a on a.vec_id = query_id join e c on c.vec_id = id),
ranked as (select *, row_number() over (partition by query_id order by score desc, id) as rank from scored)
select query_id, id, score, rank from ranked where rank <= 10"""
    q["collection_retrieve"] = """
with c as (
  select vec_id::varchar as id, label, case when vec_id % 2 = 0 then list_transform(embedding::double[], lambda x: -x)
    else embedding::double[] end as e from embeddings),
q as (select vec_id::varchar as query_id, embedding::double[] as e from embeddings where vec_id % 50 = 0),
pairs as (select query_id, id, label, round(list_cosine_similarity(q.e, c.e), 6) as score from q, c),
ranked as (select *, row_number() over (partition by query_id order by score desc, id) as rank from pairs)
select query_id, id, score, rank, 'text ' || id as page_content, label::varchar as label from ranked where rank <= 10"""
    q["payload_metadata"] = """
with lines as (select doc_id, string_split(text, chr(10)) as l from documents where lang <> 'en'),
pages as (select doc_id, len(l) as n, unnest(range(0, len(l))) as page from lines)
select 'Q' || doc_id as qid, n::varchar as lines, page::varchar as page, 'line ' || page as producer from pages"""
    q["chunk_min_length"] = f"""with {_DOCS}, {_windows("docs", "qid, component", 1600, 30)}
select qid, component, pos as chunk_index, md5(piece) as text_md5, length(piece) < 120 or length(piece) > 1600 as is_outlier
from pieces"""
    q["embed_no_text"] = """
select 'Q' || doc_id as qid, case when has then 'ok' end as status, has as has_points, true as all_added
from (select doc_id, doc_id % 3 <> 0 and coalesce(text, '') <> '' as has from documents)"""
    q["stream_rate_limit"] = """
select 'Q' || (page_id % 97) as qid, 'main/Q' || (page_id % 97) || '/components/' || page_id || '.html' as component,
  (n + cap - 1) // cap as n_batches, least(n, cap) as largest
from pages, (select count(*) as n, (count(*) + 3) // 4 as cap from pages)"""
    q["embed_second_run"] = """
select 'Q' || doc_id as qid, case when lang = 'de' then 'quarantined' else 'ok' end as status,
  case when lang = 'de' then null when doc_id % 2 = 0 then '2024-01-01' else '2024-01-02' end as run_day
from documents"""
    q["run_from_package"] = """
with files as (
  select 'Q' || doc_id as qid, 'main/Q' || doc_id || '/components/' || source || '_1.' || doc_id || '.'
    || case lang when 'en' then 'txt' when 'de' then 'bin' else 'pdf' end as component, lang = 'de' as unread from documents),
placed as (select *, row_number() over (order by qid, component) - 1 as n from files)
select qid, component, case when n between 50 and 99 and not unread then 'ok' else 'planned' end as status,
  case when n between 50 and 99 and not unread then true end as has_points
from placed where n < 150"""
    q["stream_embed_two_batches"] = """
select 'Q' || doc_id as qid, 'main/Q' || doc_id || '/components/' || source || '_1.' || doc_id || '.txt' as component,
  'ok' as status, true as has_points
from documents"""
    q["publish_twice"] = f"""{_STATE}
select step, step <> 'same' as changed, (select count(*) from status) as n_former,
  (select count(*) from status where status like 'failed%') as n_now
from (values ('first'), ('same'), ('changed')) v(step)"""
    q["state_diff"] = f"""{_STATE}
select qid, component, case when status = 'planned' then 'removed' else 'changed' end as change from status
  where status = 'planned' or status like 'failed%'
union all select qid, component || '.new', 'added' from status where status = 'ok'"""
    q["collection_recreate"] = f"""with {_DOCS}, {_windows("docs", "qid, component, package", 1600, 100)}
select {_uuid5("qid || '-' || pos")} as id, qid from pieces where package = 'src1'"""
    q["semantic_chunks"] = f"""{_semantic(300, 0.8)}
select doc_id, chunk as position, start_index, md5(text) as text_md5 from chunked"""
    q["run_summary"] = f"""{_EVENTS}
select string_split(status, ' - ')[1] as status_kind, count(*) as n from events_status group by 1"""
    q["run_progress"] = f"""
with steps as (
  select event_type, time_bucket(interval 1 hour, ts) as b, count(*) as n from events group by all),
so_far as (
  select event_type, b + interval 1 hour as step_end, sum(n) over w as completed, min(b) over w as began,
    sum(n) over (partition by event_type) as total
  from steps window w as (partition by event_type order by b rows unbounded preceding)),
rates as (
  select *, (epoch_us(step_end) - epoch_us(began)) / 1e6 as elapsed, total - completed as remaining from so_far),
etas as (select *, remaining / (completed / elapsed) as s from rates)
select event_type, strftime(step_end, '%Y-%m-%d %H:%M:%S') as step_end, completed::bigint as completed,
  remaining::bigint as remaining, round(completed / elapsed, 9) as per_second, {_DURATION} as eta
from etas"""
    q["embed_user_model"] = "select doc_id, length(text)::double as value from documents"
    q["embed_backlog"] = """
select 'Q' || doc_id as qid,
  case when lang = 'de' then 'quarantined'
       when lang <> 'en' and len(string_split(text, chr(10))) > 20
         then 'failed - PDF too large (' || len(string_split(text, chr(10))) || ' pages)'
       else 'ok' end as status
from documents"""
    q["incremental_run"] = """
select 'Q' || doc_id as qid, case when lang <> 'de' then 'ok' end as status, case when lang <> 'de' then true end as has_points,
  case when lang <> 'de' then 'main/Q' || doc_id || '/components/' || source || '_1.' || doc_id || '.'
    || case when lang = 'en' then 'txt' else 'pdf' end end as component
from documents"""
    q["stream_file_index"] = q["file_index"]
    q["stream_status_latest"] = latest
    q["stream_embed"] = """
select 'Q' || doc_id as qid, 'main/Q' || doc_id || '/components/' || source || '_1.' || doc_id || '.txt' as component,
  'ok' as status
from documents"""
    return q
