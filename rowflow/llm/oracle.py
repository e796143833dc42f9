"""SQL forms of the queries that SQL can express, for the same Parquet tables."""

from __future__ import annotations

from .sharding import SHARD_BYTES

# The plain words of a text, and the words of letters, digits and non-ASCII after lower-casing A-Z.
_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"
_BARE = (
    r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


def sharding_sql(limit: int = SHARD_BYTES) -> str:
    """A document's bucket is its shortest prefix that fits the limit."""
    return f"""
with docs as (
  select doc_id, coalesce(strlen(text), 0) as n_bytes, ('0x' || md5(coalesce(cast(doc_id as varchar), ''))[1:15])::bigint as h
  from documents),
nodes as (
  select d.depth, h >> (60 - d.depth) as p, cast(sum(n_bytes) as bigint) as shard_bytes, count(*) as shard_docs
  from docs, (select unnest(range(0, 61)) as depth) d group by all
  having shard_bytes <= {limit} or min(h) = max(h) or d.depth = 60),
leaves as (
  select h, min(depth) as depth from (select distinct h from docs), nodes
  where h >> (60 - depth) = p group by h)
select doc_id, n_bytes, lpad(case when l.depth = 0 then '' else bin(p) end, l.depth::int, '0') as shard, l.depth::int as shard_depth,
  shard_docs, shard_bytes, shard_bytes > {limit} as oversize
from docs join leaves l using (h) join nodes n on n.depth = l.depth and n.p = h >> (60 - l.depth)"""


QUALITY = rf"""
with texts as (
  select row_number() over () as r, doc_id, {_WORDS.format("text")} as ws, regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]') as symbols,
    regexp_extract_all(coalesce(text, ''), '\p{{Lu}}') as capitals,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from documents),
windows as (
  select r, i, count(*) over (partition by r, w) as n from (
    select r, unnest(range(0, len(ws) - 4)) as i, unnest(list_transform(range(0, len(ws) - 4), lambda k: ws[k + 1 : k + 5])) as w
    from texts where len(ws) >= 5)),
repeated as (
  select r, count(distinct i + k) as n from windows, (select unnest(range(0, 5)) as k) where n > 1 group by r),
counts as (
  select doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars, len(symbols)::bigint as n_symbols,
    (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words, len(ls)::bigint as n_lines,
    len(capitals)::bigint as n_capitals
  from texts left join repeated using (r)),
bits as (
  select *, ((n_words < 10)::int + 2 * (100 * n_repeat_words > 20 * n_words)::int + 4 * (100 * n_symbols > 10 * n_words)::int
    + 8 * (100 * n_dup_lines > 30 * n_lines)::int + 16 * (100 * n_capitals > 50 * word_chars)::int)::bigint as failures
  from counts)
select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed, failures = 0 as kept from bits"""


DECONTAMINATION = rf"""
with docs as (select row_number() over () as r, doc_id, {_BARE.format("text")} as ws from documents),
items as (select item_id::varchar as item, {_BARE.format("text")} as ws from benchmark),
wins as (
  select item, least(len(ws), 10) as size, unnest(list_transform(range(0, greatest(len(ws) - 9, 1)),
    lambda i: array_to_string(ws[i + 1 : i + 10], ' '))) as w
  from items where len(ws) > 0),
spots as (
  select r, size, unnest(range(0, len(ws) - size + 1)) as i,
    unnest(list_transform(range(0, len(ws) - size + 1), lambda k: array_to_string(ws[k + 1 : k + size], ' '))) as w
  from docs, (select distinct size from wins) where len(ws) >= size),
hits as (select r, i, s.size, item from spots s join wins using (size, w)),
words as (select r, count(distinct k) as n_hit from (select distinct r, unnest(range(i, i + size)) as k from hits) group by r),
found as (
  select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as names from hits group by r)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join words using (r) left join found using (r)"""

# Base32 takes five bits per character: four characters out of five hexadecimal digits.
WARC = """
with rows as (select page_id, encode(coalesce(html, '')) as payload from pages),
roles as (select *, sha1(payload) as hex, min(page_id) over (partition by payload) as first from rows)
select page_id, octet_length(payload)::bigint as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, (k // 4) * 5 + 1, 5))::bigint >> (15 - 5 * (k % 4))) & 31)::int + 1, 1)), '') as payload_digest,
  case when first is null or page_id = first then 'response' else 'revisit' end as record_type,
  case when first is not null and page_id is distinct from first then first end as refers_to
from roles"""

HARD_NEGATIVES = """
with vecs as (
  select vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
pairs as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, cast(list_dot_product(a.v, b.v) as bigint) as score
  from vecs a, vecs b where a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
positives as (
  select anchor_id, other_id as positive_id, score as positive_score from pairs where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select p.anchor_id, p.positive_id, cast(row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.other_id) as integer) as rank,
  n.other_id as negative_id, p.positive_score, n.score as negative_score
from positives p join pairs n on n.anchor_id = p.anchor_id and not n.same
where 50 * p.positive_score <= 100 * n.score and 100 * n.score <= 95 * p.positive_score
qualify rank <= 3"""


# The table of the CRC-32 by its rule (reflected polynomial 0xEDB88320), then one step per byte of every distinct word.
RESAMPLING = rf"""
with steps as (
  select list(c order by b) as t from (
    select b, list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end) as c
    from (select unnest(range(0, 256)) as b))),
docs as (select row_number() over () as r, doc_id, {_BARE.format("text")} as ws from documents),
target as (select unnest({_BARE.format("text")}) as w from benchmark),
words as (select r, unnest(ws) as w from docs),
source_counts as (select w, count(*) as n from words group by 1),
target_counts as (select w, count(*) as n from target group by 1),
vocabulary as (select w from source_counts union select w from target_counts),
bytes as (select w, list_transform(range(1, len(hex(encode(w))) + 1, 2), lambda i: ('0x' || hex(encode(w))[i : i + 1])::bigint) as bs from vocabulary),
hashed as (
  select w, xor(list_reduce(list_prepend(4294967295, bs), lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % 10000 as bucket
  from bytes, steps),
s as (select bucket, sum(n) as n from source_counts join hashed using (w) group by 1),
t as (select bucket, sum(n) as n from target_counts join hashed using (w) group by 1),
totals as (select coalesce((select sum(n) from s), 0)::bigint as s_all, coalesce((select sum(n) from t), 0)::bigint as t_all),
gains as (
  select h.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * (s_all + 10000) / ((coalesce(s.n, 0) + 1)::double * (t_all + 10000))))::bigint as gain
  from (select distinct bucket from hashed) h left join s using (bucket) left join t using (bucket), totals),
weights as (
  select r, count(*) as n, floor(sum(gain)::double / count(*))::bigint as weight
  from words join hashed using (w) join gains using (bucket) group by r),
scored as (
  select doc_id, len(ws)::bigint as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(doc_id::varchar, 'null'))[1:8])::bigint + 0.5) / 4294967296.0)))::bigint as score
  from docs left join weights using (r)),
drawn as (select *, row_number() over (order by score desc, doc_id nulls last, n_features) as k, count(*) over () as n from scored where n_features >= 20)
select doc_id, n_features, weight, score, case when k <= n * 10 // 100 then k end as rank from drawn
union all select doc_id, n_features, weight, score, null from scored where n_features < 20"""


ORACLE: dict[str, str] = {
    "op1_sharding": sharding_sql(),
    "op4_warc": WARC,
    "op5_decontamination": DECONTAMINATION,
    "op6_quality_rules": QUALITY,
    "op12_resampling": RESAMPLING,
    "op13_hard_negatives": HARD_NEGATIVES,
}
