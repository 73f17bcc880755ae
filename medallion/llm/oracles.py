"""The results of those queries that SQL can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

CHAT = r"""
with given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked as (
  select *, replace(replace(replace(text, '\', '\\'), '<turn>', '\<turn>'), '</turn>', '\</turn>') as escaped
  from given
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(length('<turn>' || role || chr(10) || escaped || '</turn>' || chr(10))) as bigint) as formatted_chars
from marked group by conv_id
"""

WARC = """
with payloads as (
  select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as digest from pages
), firsts as (select digest, min(page_id) as first_page from payloads group by digest)
select page_id, octet_length(encode(payload)) as payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    cast((cast('0x' || substr(digest, cast(5 * (i // 4) as bigint) + 1, 5) as bigint) >> cast(5 * (3 - i % 4) as integer)) & 31 as bigint) + 1,
    1)), 'string_agg', '') as payload_digest,
  case when page_id = first_page then 'response' else 'revisit' end as record_type,
  case when page_id = first_page then null else first_page end as refers_to
from payloads join firsts using (digest)
"""

NEAR = f"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') as w
  from documents
), shingles as (
  select distinct doc_id, list_slice(w, i, i + 4) as s
  from words, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) as t(i)
), sizes as (select doc_id, count(*) as n from shingles group by doc_id
), links as (
  select a.doc_id as x, b.doc_id as y from shingles a join shingles b using (s)
  join sizes n on n.doc_id = a.doc_id join sizes m on m.doc_id = b.doc_id
  where a.doc_id != b.doc_id
  group by a.doc_id, b.doc_id, n.n, m.n having 100 * count(*) >= 75 * (n.n + m.n - count(*))
), reach(x, y) as (
  select doc_id, doc_id from documents
  union select r.x, l.y from reach r join links l on r.y = l.x
), parts as (select x as doc_id, min(y) as component_id from reach group by x)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d left join sizes on sizes.doc_id = d.doc_id join parts on parts.doc_id = d.doc_id
"""

TOPK = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
  from vectors q join vectors c on q.vec_id % 20 = 0 and c.vec_id != q.vec_id
), ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

LINKED = """
with recursive vectors as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x != 0)) > 0
), links as (
  select a.vec_id as x, b.vec_id as y from vectors a join vectors b
  on a.r != b.r and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.9
), reach(x, y) as (
  select distinct vec_id, vec_id from embeddings
  union select r.x, l.y from reach r join links l on r.y = l.x
), parts as (select x as vec_id, min(y) as component_id from reach group by x
), counts as (select x as vec_id, count(*) as n from links group by x)
select e.vec_id, coalesce(n, 0) as n_links, component_id, e.vec_id = component_id as kept
from embeddings e left join counts on counts.vec_id = e.vec_id join parts on parts.vec_id = e.vec_id
"""

MINED = """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
    cast(list_inner_product(a.e, c.e) as bigint) as score
  from vectors a join vectors c on a.vec_id % 100 = 0 and c.vec_id != a.vec_id
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
), ranked as (
  select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
    cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank
  from positives join scored using (anchor_id)
  where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ranked where rank <= 10
"""

ORACLES = {
    "op1_chat_trees": CHAT,
    "op3_warc_captures": WARC,
    "op5_minhash_dedup": NEAR,
    "op9_exact_topk": TOPK,
    "op12_flat_graph": LINKED,
    "op13_hard_negatives": MINED,
}
