"""DuckDB twins of the corpus queries, where SQL can express them."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
with d as (
  select doc_id, {_WORD.format(_LOWER.format("coalesce(text, '')"))} as w,
         row_number() over () as r
  from documents),
b as (select item_id, {_WORD.format(_LOWER.format("coalesce(text, '')"))} as w from benchmark),
bw as (
  select distinct item_id, least(len(w), 13) as n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') as win
  from (select item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) as i from b where len(w) > 0)),
ns as (select distinct n from bw),
dw as (
  select r, n, i, array_to_string(w[i:i + n - 1], ' ') as win
  from (select r, w, unnest(generate_series(1, len(w))) as i from d where len(w) > 0), ns
  where i + n - 1 <= len(w)),
hit as (select dw.r, dw.i, dw.n, bw.item_id from dw join bw on dw.n = bw.n and dw.win = bw.win),
pos as (select r, count(distinct p) as n_hit
        from (select r, unnest(generate_series(i, i + n - 1)) as p from hit) group by r),
its as (select r, list_sort(list_distinct(list(cast(item_id as varchar)))) as ids from hit group by r)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(pos.n_hit, 0) as bigint) as n_hit,
       cast(coalesce(len(its.ids), 0) as bigint) as n_items,
       sha256(coalesce(array_to_string(its.ids, ','), '')) as items_sha256,
       coalesce(pos.n_hit, 0) > 0 and 20 * coalesce(pos.n_hit, 0) >= len(d.w) as contaminated
from d left join pos using (r) left join its using (r)
"""

_KEY = _LOWER.format(r"regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '')")

OP7 = f"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) as i
  from documents),
k as (select doc_id, i, line, {_KEY} as key from l),
f as (select key, min(doc_id) as keep from k where length(key) >= 10
      group by key having count(distinct doc_id) > 1),
m as (select k.*, f.key is not null and k.doc_id > f.keep as gone from k left join f on k.key = f.key)
select doc_id, count(*) as n_lines, cast(count(*) filter (where gone) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from m group by doc_id
"""

#: Components: reach is closed by repeated squaring of the links, which suits small tables.
OP3 = f"""
with recursive d as (
  select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (
  select distinct doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') || case when len(w) < 5 then chr(10) else '' end as g
  from (select doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
f as (select g from s group by g having count(*) > 1),
o as (
  select a.doc_id as x, b.doc_id as y, count(*) as common
  from (s join f using (g)) a join (s join f using (g)) b on a.g = b.g and a.doc_id < b.doc_id group by all),
e as (
  select x, y from o join n nx on nx.doc_id = x join n ny on ny.doc_id = y
  where 100 * common >= 75 * (nx.n + ny.n - common)),
e2 as (select x, y from e union select y, x from e),
r as (select x, y from e2 union select r.x, e2.y from r join e2 on r.y = e2.x)
select d.doc_id, coalesce(n.n, 0) as n_shingles,
       least(d.doc_id, coalesce(c.m, d.doc_id)) as component_id
from d left join n using (doc_id) left join (select x, min(y) as m from r group by x) c on c.x = d.doc_id
"""

#: The level of the targets lies below the first breakpoint cap / weight at which the filled total suffices.
OP5 = r"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         md5(coalesce(cast(doc_id as varchar), '') || ':mix-1') as k
  from documents),
s as (select source, sum(size) as S from d group by source),
w as (
  select source, S, 2.0::double * S as cap,
         (array[5.0::double, 2.0, 1.0])[cast((row_number() over (order by encode(source) nulls last) - 1) % 3 as int) + 1] as w
  from s),
f as (select a.cap / a.w as r, sum(least(b.cap, a.cap / a.w * b.w)) as filled from w a, w b group by a.source, a.cap, a.w),
x as (select min(r) as r from f where filled >= (select 1.5::double * sum(S) from w)),
v as (
  select ((select 1.5::double * sum(S) from w) - coalesce(sum(cap) filter (where cap / w < r), 0))
         / sum(w) filter (where cap / w >= r) as level
  from w, x),
t as (select source, cast(S as bigint) as S, least(cap, w * level) as target from w, v),
q as (
  select d.doc_id, d.source, d.size, t.S, t.target,
         sum(d.size) over (partition by d.source order by d.k, d.doc_id, d.size rows between unbounded preceding and current row) as u
  from d join t on d.source is not distinct from t.source),
c as (
  select size, cast(u + e * S as double) / target as v from q, (select unnest([0, 1]) as e) where size > 0 and target > 0),
o as (select v, sum(size) over (order by v) as upto from c),
z as (select max(v) as last from o where upto <= (select sum(target) from t))
select doc_id, size, S as source_size, target,
       cast(size * (case when size > 0 and target > 0 then
         (cast(u as double) / target <= coalesce(last, -1))::int + (cast(u + S as double) / target <= coalesce(last, -1))::int
         else 0 end) as bigint) as taken
from q, z
"""

OP8 = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as h from pages),
w as (select h, max(page_id) as m from p group by h),
d as (
  select h, list_aggregate(list_transform(generate_series(0, 31), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      cast((cast('0x' || substr(h, cast(5 * i // 4 + 1 as int), 2) as int) >> cast(3 - (5 * i) % 4 as int)) & 31 as int) + 1, 1)
    ), 'string_agg', '') as b
  from w)
select page_id, cast(n as bigint) as payload_bytes, b as payload_digest,
       case when page_id = m then 'response' else 'revisit' end as record_type,
       case when page_id = m then null else m end as refers_to
from p join w using (h) join d using (h)
"""

ORACLES = {"op8_warc": OP8, "op5_fair_mixing": OP5, "op3_ngram_jaccard": OP3, "op1_decontaminate": OP1, "op7_line_dedup": OP7}
