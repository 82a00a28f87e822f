"""SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from tidemark.llm.decontamination import WIDTH
from tidemark.llm.line_frequency import RATIO
from tidemark.llm.spelling import MIN_COUNT, MIN_LENGTH, SLIP_EVERY
from tidemark.llm.spelling import RATIO as VARIANT_RATIO

_SITE_LINES = f"""
with pages as (
  select distinct source as host, md5(text) as page, text from documents where text is not null
), per_host as (
  select host, count(*) as total from pages group by host
), holds as (
  select distinct host, page, trim(line, ' ') as line
  from (select host, page, unnest(string_split(text, chr(10))) as line from pages)
), bad as (
  select h.host, h.line
  from holds h join per_host t on h.host is not distinct from t.host
  where h.line <> '' group by h.host, h.line, t.total
  having count(*) > 1 and count(*) > {RATIO}::double * t.total
), parts as (
  select d.doc_id, d.host, u.at, u.line, b.line is not null as gone
  from (select doc_id, source as host, row_number() over () as nr, string_split(text, chr(10)) as lines
        from documents where text is not null) d,
       lateral (select unnest(d.lines) as line, generate_subscripts(d.lines, 1) as at) u
  left join bad b on b.host is not distinct from d.host and b.line = trim(u.line, ' ')
)
select d.doc_id, d.source as host,
       case when d.text is null then null
            else coalesce(string_agg(p.line, chr(10) order by p.at) filter (where not p.gone), '') end as text,
       count(p.at) as n_lines, count(p.at) filter (where p.gone) as n_dropped
from documents d left join parts p on p.doc_id = d.doc_id
group by d.doc_id, d.source, d.text
"""

_TOP_PRODUCTS = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(x::double * 1024)) as e from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), s as (
  select q.vec_id as query_id, x.vec_id, list_dot_product(q.e, x.e)::bigint as score
  from v q join v x on q.vec_id <> x.vec_id where q.vec_id % 100 = 0
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from s qualify rank <= 10
"""

_PAYLOADS = """
select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes,
       payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from (
  select page_id, html, max(page_id) over (partition by coalesce(html, '')) as first, d.digest as payload_digest
  from pages, lateral (
    select string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + bits::int, 1), '' order by i) as digest
    from (
      select i, ('0x' || substr(lpad(sha1(coalesce(html, '')), 40, '0'), 1 + 5 * (i // 4), 5))::bigint
                // (1 << (15 - 5 * (i % 4)))::bigint % 32 as bits
      from range(32) r(i)
    )
  ) d
)
"""

_SPELLING = f"""
with recursive bits as (
  select range as b, list_reduce(list_prepend(range, range(8)),
    lambda c, i: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c from range(256)
), crc as (
  select list(c order by b) as crc_of from bits
), runs as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
  from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as run from documents)
), per_doc as (
  select coalesce(doc_id::varchar, 'null') || ':' || run as marked, run, count(*) as c
  from runs where length(run) >= {MIN_LENGTH} group by all
), hashed as (
  select run, c, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(octet_length(encode(marked))),
      lambda i: ('0x' || substr(hex(encode(marked)), 2 * i + 1, 2))::bigint)),
    lambda h, x: xor(h >> 8, crc_of[1 + xor(h & 255, x)]))) as h
  from per_doc, crc
), slipped as (
  select case when h % {SLIP_EVERY} = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2)
              else run end as word, c from hashed
), words as (
  select word, sum(c)::bigint as n from slipped where length(word) >= {MIN_LENGTH} group by word having sum(c) >= {MIN_COUNT}
), holes as (
  select word, n, i, left(word, i - 1) as a, substr(word, i + 1) as z
  from (select word, n, unnest(range(1, length(word) + 1)) as i from words)
), pairs as (
  select x.word, y.word as other, y.n as other_n
  from holes x join holes y on x.i = y.i and x.a = y.a and x.z = y.z and x.word <> y.word
  union
  select h.word, w.word, w.n from holes h join words w on w.word = h.a || h.z
  union
  select w.word, h.word, h.n from holes h join words w on w.word = h.a || h.z
), near as (
  select word, count(*) as n_near, min((-other_n, other)) as best from pairs group by word
), formed as (
  select w.word, w.n, coalesce(n_near, 0) as n_near,
         case when -best[1] >= {VARIANT_RATIO} * w.n then best[2] end as form,
         case when -best[1] >= {VARIANT_RATIO} * w.n then -best[1] end as form_n
  from words w left join near using (word)
), chain as (
  select word, word as place, form as further from formed
  union all
  select c.word, f.word, f.form from chain c join formed f on f.word = c.further
)
select f.word, n, n_near, form, form_n::bigint as form_n, c.place as root
from formed f join chain c on c.word = f.word and c.further is null
"""

_NEGATIVES = """
with v as (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(x::double * 256)) as e
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), s as (
  select a.id as anchor_id, x.id, a.label = x.label as same, list_dot_product(a.e, x.e)::bigint as score
  from v a join v x on a.id <> x.id where a.id % 100 = 0
), p as (
  select anchor_id, id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select p.anchor_id, positive_id, row_number() over (partition by p.anchor_id, positive_id order by score desc, s.id)::int as rank,
       s.id as negative_id, positive_score, score as negative_score
from p join s on s.anchor_id = p.anchor_id and not same
  and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify rank <= 5
"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_BENCHMARK = f"""
with docs as (
  select row_number() over () as nr, doc_id, coalesce({_WORDS}, []) as w from documents
), items as (
  select distinct item_id, {_WORDS} as w from benchmark where item_id is not null and text is not null
), windows as (
  select distinct item_id, least(len(w), {WIDTH}) as m, w[i : i + least(len(w), {WIDTH}) - 1] as p
  from (select item_id, w, unnest(range(1, greatest(len(w) - {WIDTH} + 1, 1) + 1)) as i from items where len(w) > 0)
), places as (
  select nr, m, i, w[i : i + m - 1] as p
  from (select nr, w, m, unnest(range(1, len(w) - m + 2)) as i from docs, (select distinct m from windows))
), hits as (
  select distinct nr, i, m, item_id from places join windows using (m, p)
), hit as (
  select nr, count(distinct j) as n_hit from (select nr, unnest(range(i, i + m)) as j from hits) group by nr
), found as (
  select nr, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct nr, item_id::varchar as item from hits) group by nr
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, n_hit is not null as contaminated
from docs left join hit using (nr) left join found using (nr)
"""

ORACLE_SQL: dict[str, str] = {
    "op3_top_products": _TOP_PRODUCTS,
    "op5_warc_index": _PAYLOADS,
    "op10_site_lines": _SITE_LINES,
    "op11_spelling_variants": _SPELLING,
    "op12_angular_negatives": _NEGATIVES,
    "op13_wu_manber": _BENCHMARK,
}
