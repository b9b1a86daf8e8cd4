"""SQL for those queries of this subpackage that SQL can express on whole tables."""

_SOURCE_AUDIT = r"""
with docs as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents
),
words as (
  select row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from docs
),
kept as (
  select lang, term, count(*) as lang_n from words group by all having count(distinct row) >= 30
),
langs as (select lang, count(*) as v, sum(lang_n)::bigint as total from kept group by lang),
groups as (
  select g.lang, g.source, coalesce(v, 0) as v, coalesce(l.total, 0) as lang_total
  from (select distinct lang, source from docs) g left join langs l using (lang)
),
counted as (
  select lang, source, term, lang_n, count(*) as n
  from words join kept using (lang, term) group by all
),
totals as (select lang, source, sum(n)::bigint as total from counted group by all),
every as (
  select g.lang, g.source, k.term, k.lang_n, coalesce(c.n, 0) as n, g.v, g.lang_total,
    coalesce(t.total, 0) as total
  from groups g join kept k using (lang) left join counted c using (lang, source, term)
  left join totals t using (lang, source)
),
rated as (
  select lang, source, term, n,
    1 + (1000000000::hugeint * (n + 5)) // (total + 5 * v) as p,
    1 + (1000000000::hugeint * (lang_n + 5)) // (lang_total + 5 * v) as q
  from every
),
sums as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from rated a join rated b using (lang, term) group by all
),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item,
    coalesce(s.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source
),
terms as (
  select lang, source, 'term' as part, term as item, (p - q)::bigint as value
  from rated where n > 0 and p > q
)
select lang, source, part, item, value,
  (row_number() over (partition by lang, source, part order by value desc, item))::int as rank
from (select * from pairs union all select * from terms)
qualify part = 'pair' or rank <= 50
"""

SQL: dict[str, str] = {"op11_source_audit": _SOURCE_AUDIT}
