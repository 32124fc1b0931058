"""SQL counterparts of the corpus queries that SQL can express, for the same tables."""

SIZES = r"""
with sized as (
  select doc_id, source, md5(coalesce(doc_id::varchar, '')) h,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint size
  from documents
)"""

OP9 = SIZES + """,
by_source as (
  select source, sum(size)::bigint source_size, row_number() over (order by source nulls last) - 1 source_id
  from sized group by source
),
weighed as (
  select *, [5, 2, 1][(source_id % 3 + 1)::int] weight, 3 * source_size cap from by_source
),
shares as (
  select *,
    sum(source_size) over () - coalesce(sum(cap) over (order by cap / weight::double, source_id
      rows between unbounded preceding and 1 preceding), 0) spare,
    sum(weight) over () - coalesce(sum(weight) over (order by cap / weight::double, source_id
      rows between unbounded preceding and 1 preceding), 0) heft
  from weighed
),
best as (select spare, heft from shares order by spare / heft::double desc limit 1),
targets as (
  select s.source, s.source_id, s.source_size, least(s.cap::double, (s.weight * b.spare)::double / b.heft::double) target
  from shares s, best b
),
queued as (
  select d.doc_id, d.size, t.source_size, t.target, t.source_id, row_number() over () "row",
    greatest(32, ceil(t.target / 1024)::bigint) packet,
    sum(d.size) over (partition by t.source order by h, d.doc_id, d.size rows unbounded preceding) - d.size ahead
  from sized d join targets t on d.source is not distinct from t.source
),
packets as (
  select q."row", q.target, q.source_id, least(q.packet, q.size - f."first") words,
    q.ahead + e.epoch * q.source_size + f."first" + least(q.packet, q.size - f."first") served
  from queued q, (values (0), (1), (2)) e(epoch), lateral (select unnest(range(0, q.size, q.packet)) "first") f
),
in_order as (
  select "row", words, sum(words) over (order by served / target, source_id, served rows unbounded preceding) - words ahead
  from packets
),
served as (
  select "row", sum(greatest(0, least(words, (select sum(size) from sized) - ahead)))::bigint taken from in_order group by "row"
)
select q.doc_id, q.size, q.source_size, q.target, coalesce(s.taken, 0)::bigint taken
from queued q left join served s using ("row")
"""

OP3 = """
with fine as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) v from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
  select q.vec_id query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::bigint score
  from fine q join fine c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 50 = 0
),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int "rank" from scored
)
select query_id, "rank", vec_id, score from ranked where "rank" <= 5
"""

OP2 = """
with recursive fine as (
  select vec_id, list_transform(embedding, lambda x: x::double) v,
         sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))) norm
  from embeddings
  where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links as materialized (
  select a.vec_id a, b.vec_id b from fine a join fine b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) / (a.norm * b.norm) >= 0.95
),
reach as (
  select vec_id node, vec_id root from fine
  union
  select l.b, r.root from reach r join links l on r.node = l.a
),
grouped as (select node, min(root) root from reach group by node)
select e.vec_id, (select count(*) from links l where l.a = e.vec_id)::bigint n_links,
       coalesce(g.root, e.vec_id) component_id, coalesce(g.root, e.vec_id) = e.vec_id kept
from embeddings e left join grouped g on g.node = e.vec_id
"""

OP1 = r"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents
),
windows as (
  select doc_id, unnest(generate_series(1, len(w) - 34)) s, w from words where len(w) >= 35
),
hashed as (select doc_id, s, md5(array_to_string(w[s:s + 34], ' ')) h from windows),
again as (select h from hashed group by h having count(*) > 1),
gone as (
  select doc_id, list_distinct(flatten(list(generate_series(s, s + 34)))) g
  from hashed where h in (select h from again) group by doc_id
)
select w.doc_id, len(w.w)::bigint n_words, coalesce(len(g.g), 0)::bigint n_removed,
  sha256(array_to_string(list_transform(list_filter(generate_series(1, len(w.w)),
    lambda i: g.g is null or not list_contains(g.g, i)), lambda i: w.w[i]), ' ')) kept_sha256
from words w left join gone g using (doc_id)
"""

OP5 = r"""
with split as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) l from documents
),
keyed as (
  select doc_id, l, list_transform(l, lambda x: translate(regexp_replace(regexp_replace(x, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) k from split
),
common as (
  select key from (select unnest(list_distinct(k)) key from keyed) where key <> '' group by key having count(*) >= 10
),
lists as (select coalesce(list(key), []) c from common),
stay as (
  select doc_id, l, list_filter(generate_series(1, len(l)), lambda i: not list_contains(c, k[i])) i from keyed, lists
)
select doc_id, len(l)::bigint n_lines, (len(l) - len(i))::bigint n_dropped,
  sha256(coalesce(array_to_string(list_transform(i, lambda x: l[x]), chr(10)), '')) kept_sha256
from stay
"""

OP11 = r"""
with split as (
  select doc_id, coalesce(lang, '') part, coalesce(text, '') t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w
  from documents
),
marks as (
  select doc_id, coalesce(max(quality = 1), false) good, coalesce(max(toxic = 1), false) toxic from labels group by doc_id
),
masked as (
  select part, coalesce(good, false) good, coalesce(toxic, false) toxic,
    (len(w) < 100)::int + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::int
    + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t))::int
    + 8 * regexp_matches(t, '[#$%&*|]')::int
    + 16 * coalesce(s.doc_id > min(s.doc_id) over (partition by t), false)::int m
  from split s left join marks using (doc_id)
),
folded as (
  select part, m, count(*) n, count(*) filter (good) g, count(*) filter (toxic) x from masked group by part, m
),
filters as (select i, 1 << i::int b, substr('ABCDE', i + 1, 1) c from range(5) r(i)),
orders as (
  select a.c || b.c || c.c || d.c || e.c filter_order, [a.b, b.b, c.b, d.b, e.b] bits
  from filters a, filters b, filters c, filters d, filters e where a.b + b.b + c.b + d.b + e.b = 31
    and len(list_distinct([a.b, b.b, c.b, d.b, e.b])) = 5
),
steps as (
  select filter_order, s::int step, bits[s] b, coalesce(list_sum(bits[1:s - 1]), 0)::int before
  from orders, range(1, 6) r(s)
),
told as (
  select part, filter_order, step, b,
    coalesce(sum(n) filter (m & (before | b) = 0), 0) kept,
    coalesce(sum(n) filter (m & before = 0 and m & b <> 0), 0) removed,
    coalesce(sum(n) filter (m & before <> 0 and m & b <> 0), 0) redundant,
    coalesce(sum(n) filter (m = b), 0) unique_fails,
    coalesce(sum(g) filter (m & before = 0 and m & b <> 0), 0) good_lost,
    coalesce(sum(x) filter (m & before = 0 and m & b <> 0), 0) toxic_lost
  from folded, steps group by part, filter_order, step, b
)
select part, filter_order, step, kept::bigint kept, removed::bigint removed, redundant::bigint redundant,
  unique_fails::bigint unique_fails, good_lost::bigint good_lost, toxic_lost::bigint toxic_lost,
  (sum(removed) over (partition by part, b))::bigint shapley
from told
"""

OP13 = r"""
with words as (
  select row_number() over () d, coalesce(lang, '') lang, coalesce(source, '') source, unnest(list_transform(
    regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'),
    lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) term
  from documents
),
kept as materialized (select lang, term, count(*) n from words group by lang, term having count(distinct d) >= 3),
counted as materialized (select lang, source, term, count(*) n from words semi join kept using (lang, term) group by all),
langs as (select lang, sum(n) total, count(*) v from kept group by lang),
groups as materialized (
  select g.lang, g.source, coalesce(l.v, 0) v, coalesce(l.total, 0) lang_total,
    coalesce((select sum(n) from counted c where c.lang = g.lang and c.source = g.source), 0) total
  from (select distinct coalesce(lang, '') lang, coalesce(source, '') source from documents) g left join langs l using (lang)
),
shares as materialized (
  select g.lang, g.source, k.term, coalesce(c.n, 0) n,
    1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (g.total + g.v)::hugeint p,
    1 + (1000000000::hugeint * (k.n + 1)) // (g.lang_total + g.v)::hugeint q
  from groups g join kept k using (lang) left join counted c on c.lang = g.lang and c.source = g.source and c.term = k.term
),
summed as (
  select a.lang, a.source, b.source item, sum((a.p - b.p) * (a.p - b.p) // b.p) value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
),
pairs as (
  select a.lang, a.source, b.source item, coalesce(s.value, 0)::bigint value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join summed s on s.lang = a.lang and s.source = a.source and s.item = b.source
),
terms as (
  select lang, source, term item, ((p - q) * (p - q) // q)::bigint value from shares where n > 0 and p > q
),
ranked as (
  select lang, source, 'pair' part, item, value,
    row_number() over (partition by lang, source order by value desc, item)::int "rank" from pairs
  union all
  select lang, source, 'term', item, value,
    row_number() over (partition by lang, source order by value desc, item)::int "rank" from terms
)
select * from ranked where part = 'pair' or "rank" <= 200
"""

ORACLE = {"op1_substrings": OP1, "op5_lines": OP5, "op2_embeddings": OP2, "op3_topk": OP3, "op9_mixing": OP9, "op11_filters": OP11, "op13_divergence": OP13}
