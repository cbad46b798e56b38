"""DuckDB twins of the queries that SQL can express."""

ORACLES = {
    "op2_exact_dedup": """
with t as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm
  from documents),
n as (
  select doc_id, norm, row_number() over (partition by norm order by doc_id desc nulls last) as pos from t)
select doc_id, max(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
       pos = 1 as kept, sha256(norm) as text_sha256
from n
""",
    "op9_topk": """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as e
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 10
""",
    "op12_divergence": r"""
with d as (select row_number() over () as i, coalesce(lang, '') as lang, coalesce(source, '') as source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
w as (select i, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
k as (select lang, term from w group by lang, term having count(distinct i) >= 3),
v as (select lang, count(*)::hugeint as v from k group by lang),
c as (select lang, source, term, count(*)::hugeint as n from w semi join k using (lang, term) group by all),
g as (select d.lang, d.source, coalesce(max(s), 0)::hugeint as s, coalesce(max(v), 0)::hugeint as v
      from (select distinct lang, source from d) d
      left join (select lang, source, sum(n) as s from c group by all) using (lang, source) left join v using (lang) group by all),
l as (select lang, sum(s)::hugeint as s from g group by lang),
t as (select lang, term, sum(n)::hugeint as n from c group by all),
p as (select g.lang, g.source, k.term, coalesce(n, 0) as n, 1 + (1000000000 * (coalesce(n, 0) + 1)) // (s + v) as p
      from g join k using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
pr as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0)::bigint as value
       from g a join g b on a.lang = b.lang and a.source <> b.source
       left join p x on x.lang = a.lang and x.source = a.source left join p y on y.lang = b.lang and y.source = b.source and y.term = x.term
       group by all),
q as (select lang, term, 1 + (1000000000 * (n + 1)) // (s + v) as q from t join l using (lang) join v using (lang)),
tr as (select p.lang, p.source, 'term' as part, p.term as item, ((p - q) * (p - q) // q)::bigint as value
       from p join q using (lang, term) where n > 0 and p > q),
r as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from (select * from pr union all select * from tr))
select lang, source, part, item, value, rank::int as rank from r where part = 'pair' or rank <= 200
""",
    "op13_lexical": r"""
with d as (select row_number() over () as i, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
h as (select i, doc_id, terms, len(terms)::bigint as n from d where len(terms) > 0),
s as (select count(*)::bigint as n, sum(n)::bigint as l from h),
b as (select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
a as (select item_id, term, count(*)::bigint as r from b group by all),
o as (select i, unnest(terms) as term from h),
f as (select i, term, count(*)::bigint as tf from o semi join b using (term) group by all),
w as (select term, floor(1000 * ln((2 * s.n + 2)::double / (2 * count(*) + 1)::double))::bigint as w from f, s group by term, s.n),
x as (select item_id, doc_id, i, sum(r * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * h.n * s.n) // s.l))))::bigint as score
      from a join f using (term) join w using (term) join h using (i), s group by all),
k as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from x where score > 0)
select item_id, rank::int as rank, doc_id, score from k where rank <= 20
""",
}
