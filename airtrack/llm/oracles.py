"""The same results as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

OP6 = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""


OP11 = r"""
with words as (
  select doc, lang, source, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term
  from (select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
               unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as w from documents)
), kept as (
  select lang, term from words group by lang, term having count(distinct doc) >= 30
), found as (
  select lang, source, term, count(*) as n from words semi join kept using (lang, term) group by all
), groups as (
  select distinct coalesce(lang, '') as lang, coalesce(source, '') as source from documents
), sizes as (
  select lang, count(*) as v from kept group by lang
), whole as (
  select lang, term, sum(n) as n, sum(sum(n)) over (partition by lang) as total from found group by lang, term
), part as (
  select g.lang, g.source, k.term, coalesce(f.n, 0) as n, sum(coalesce(f.n, 0)) over (partition by g.lang, g.source) as total
  from groups g join kept k using (lang) left join found f using (lang, source, term)
), priced as (
  select p.lang, p.source, p.term, p.n, 1 + (1000000000::hugeint * (p.n + 5)) // (p.total + 5 * s.v) as p,
         1 + (1000000000::hugeint * (w.n + 5)) // (w.total + 5 * s.v) as q
  from part p join sizes s using (lang) join whole w using (lang, term)
), pairs as (
  select g.lang, g.source, 'pair' as part, o.source as item, coalesce(f.value, 0) as value
  from groups g join groups o on g.lang = o.lang and g.source <> o.source
  left join (select a.lang, a.source, b.source as other, sum(abs(a.p - b.p)) as value
             from priced a join priced b using (lang, term) group by all) f
  on f.lang = g.lang and f.source = g.source and f.other = o.source
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from (select * from pairs union all
        select lang, source, 'term', term, p - q from priced where n > 0 and p > q)
)
select lang, source, part, item, value::bigint as value, rank::integer as rank from ranked where part = 'pair' or rank <= 50
"""


OP12 = r"""
with words as (
  select doc, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term
  from (select row_number() over () as doc,
               unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as w from documents)
), ids as (
  select row_number() over () as doc, doc_id from documents
), queries as (
  select item_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term, count(*) as repeats
  from (select item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as w from benchmark)
  group by all
), sizes as (
  select doc, count(*) as n from words group by doc
), whole as (
  select count(*) as docs, sum(n)::bigint as total from sizes
), found as (
  select doc, term, count(*) as tf from words semi join queries using (term) group by all
), weights as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint as w from found, whole group by term, docs
), scores as (
  select item_id, doc, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::bigint as score
  from queries join weights using (term) join found using (term) join sizes using (doc), whole group by item_id, doc
), ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score
  from scores join ids using (doc) where score > 0
)
select item_id, rank::integer as rank, doc_id, score from ranked where rank <= 20
"""


def statements() -> dict[str, str]:
    return {"op6_exact_dedup": OP6, "op11_source_divergence": OP11, "op12_lexical_search": OP12}
