"""DuckDB SQL for the registered queries, written against the same test tables."""

# The test tables as enriched posts, as ``binding`` sees them.
_BASE = """
base as (
  select e.event_id as id, d.text, d.source, d.lang, d.n_chars as favorite_count, e.ts as date,
    e.event_type as aidr_label,
    l.quality = 1 as verified, l.toxic = 1 as possibly_sensitive,
    cast(v.embedding[1] as double) * 180 as longitude,
    cast(v.embedding[2] as double) * 90 as latitude,
    c.c_name as name, lower(c.c_name) as screen_name,
    case when r.r_name in ('AMERICA', 'ASIA') then 'US' else 'XX' end as country_code,
    case when e.event_type in ('view', 'click') then 'admin'
         when e.event_type in ('error', 'signup') then 'city' else 'poi' end as place_type,
    case when e.event_type in ('view', 'click') then n.n_name || ', USA'
         else c.c_mktsegment || ', N' || cast(n.n_nationkey as varchar) end as place_name,
    case when n.n_regionkey <> 4 then cast(n.n_nationkey as double) * 2.5 - 90 end as place_longitude,
    case when n.n_regionkey <> 4 then cast(n.n_regionkey as double) * 7.25 + 10 end as place_latitude,
    e.value / 50 - 1 as sentiment_polarity,
    e.value / (e.value + 50) as sentiment_subjectivity
  from events e left join documents d on d.doc_id = e.event_id
  left join labels l on l.doc_id = e.event_id
  left join embeddings v on v.vec_id = e.event_id
  left join customer c on c.c_custkey = e.user_id
  left join nation n on n.n_nationkey = c.c_nationkey
  left join region r on r.r_regionkey = n.n_regionkey
),
posts as (
  select b.*,
    case when country_code = 'US' and place_type = 'admin' then m.code
         when country_code = 'US' and place_type = 'city'
           then nullif(split_part(place_name, ', ', 2), '') end as place_state,
    cast(case when date < timestamp '2024-01-02 00:00:00' then 0
              when date <= timestamp '2024-01-03 00:00:00' then 1 else 2 end as int) as phase,
    cast(hour(date) + 1 as int) as timerange_end,
    strftime(date, '%Y-%m-%d %H:%M:%S') as date_text
  from base b left join (
    select n_name, 'N' || cast(n_nationkey as varchar) as code from nation where n_nationkey <> 21
  ) m on m.n_name = split_part(b.place_name, ', ', 1)
)"""

# Raw posts: dates as text, reposts and truncated posts included; then as derived.
_RAW = f"""{_BASE},
raw as (
  select *, verified as truncated, source || ' ' || text as full_text,
    case when aidr_label = 'signup' then strftime(date, '%a, %d %b %Y %H:%M:%S') || ' -0600'
         when aidr_label = 'error' then 'about ' || strftime(date, '%a %b %d')
         else strftime(date, '%a %b %d %H:%M:%S') || ' +0200 ' || strftime(date, '%Y')
    end as created_at
  from posts
),
derived as (
  select * exclude (date, text, phase, timerange_end),
    case when truncated then full_text else text end as text,
    case when aidr_label <> 'error' then date_trunc('second', date) end as date
  from raw
)"""

_LABEL_ROWS = """
label_rows as (
  select event_id as id, strftime(ts, '%Y-%m-%d') as date, event_type as aidr_label,
    '0.5' as aidr_confidence from events
  union all
  select doc_id, '', 'quality_' || cast(quality as varchar), null from labels
  union all
  select null, 'x', 'y', '0' from documents where lang not in ('en', 'fr')
)"""


def _scored(source: str) -> str:
    """Word scores of the ``id, text`` rows of a table, one row per id."""
    return f"""
lexicon(word, p, s) as (
  values ('the', 0.5::double, 0.4::double), ('of', -0.6, 0.9), ('and', 0.1, 0.2), ('in', -0.2, 0.5)
),
hits as (
  select id, avg(p) as p, avg(s) as s
  from (select id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}]+')) as word from {source})
  join lexicon using (word) group by id
),
scored as (
  select t.id, case when text is not null then coalesce(p, 0.0) end as polarity,
    case when text is not null then coalesce(s, 0.0) end as subjectivity
  from {source} t left join hits using (id)
)"""


_NAME = (
    r"(\p{Lu}[\p{L}\p{M}]+(?: \p{Lu}[\p{L}\p{M}]+)*)"
    r"|\p{Lu}|[\p{Ll}\p{Lt}\p{Lm}\p{Lo}\p{M}][\p{L}\p{M}]*"
)

_MENTIONS = f"""
mentions as (
  select doc_id, lang, pos, entity,
    coalesce(case entity when 'The' then 'ART' when 'Of' then 'PREP' when 'Ción' then 'LOC'
                         when 'Orre' then 'PER' end, 'MISC') as type
  from (
    select doc_id, lang, unnest(list) as entity, generate_subscripts(list, 1) as pos
    from (select doc_id, lang, regexp_extract_all(text, '{_NAME}', 1) as list from documents)
  ) where entity <> ''
),
canonical as (
  select doc_id, lang,
    case when lower(entity) in ('the', 'of') then 'The'
         when lower(entity) = 'orre' then 'Orre' else entity end as "Entity",
    case when lower(entity) in ('the', 'of') then 'WORD'
         when lower(entity) = 'orre' then 'NAME' else type end as "Type"
  from mentions
)"""

_MENTION_LISTS = f"""
with {_MENTIONS}
select d.doc_id, cast(count(entity) as int) as n,
  coalesce(string_agg(entity, ' ' order by pos), '') as entities,
  coalesce(string_agg(type, ' ' order by pos), '') as types
from documents d left join mentions m using (doc_id)
where d.text is not null group by d.doc_id
"""

_MENTION_COUNTS = f"""
with {_MENTIONS}
select "Entity", "Type", count(*) as count from canonical group by 1, 2
"""

_TOTALS = f"""
with {_MENTIONS},
runs as (
  select lang, "Entity" as entity,
    case when "Type" in ('WORD', 'NAME') then "Type" else upper(lang) end as type, count(*) as n
  from canonical group by all
)
select entity, type, cast(sum(n) as bigint) as total_count from runs group by all
"""

_SCORES = f"""
with docs as (select doc_id as id, text from documents), {_scored("docs")}
select id as doc_id, round(polarity, 8) as sentiment_polarity,
  round(subjectivity, 8) as sentiment_subjectivity
from scored
"""

# The state machine of scores with scope, folded over the tokens that mean something.
_SCOPED_SCORES = """
with docs as (select doc_id as id, text from documents),
meaning(word, p, s, negate, boost) as (
  values ('the', 0.5::double, 0.4::double, null::double, null::double), ('of', -0.6, 0.9, null, null),
    ('and', 0.1, 0.2, null, null), ('in', -0.2, 0.5, null, null), ('of the', -0.9, 0.3, null, null),
    ('of the and', 0.7, 0.8, null, null), ('that', 0.3, 0.6, null, 1.25), ('to', null, null, -0.5, null),
    ('by', null, null, -0.8, null), ('is', null, null, null, 1.5), ('was', null, null, null, 0.5)
),
listed as (
  select id, regexp_extract_all(lower(text), '([\\p{L}\\p{M}]+(?:[''’][\\p{L}\\p{M}]+)*|[.,;:!?])') as list
  from docs
),
placed as (select id, unnest(list) as word, generate_subscripts(list, 1) - 1 as pos from listed),
token as (
  select *, lead(word) over (partition by id order by pos) as second,
    lead(word, 2) over (partition by id order by pos) as third
  from placed
),
spans as (
  select id, pos, 1 as n, word from token
  union all select id, pos, 2, word || ' ' || second from token
  union all select id, pos, 3, word || ' ' || second || ' ' || third from token
),
event as (
  select id, pos, n, false as mark, p, s, negate, boost from spans join meaning using (word)
  union all
  select id, pos, 1, true, null, null, null, null from token where word in ('.', ',', ';', ':', '!', '?')
),
folded as (
  select id, list_reduce(
    list({'pos': pos, 'n': n, 'mark': mark, 'p': p, 's': s, 'negate': negate, 'boost': boost} order by pos, n desc),
    lambda a, e: case
      when e.mark then {'covered': a.covered, 'negate': 1.0::double, 'until': -1::bigint, 'boost': 1.0::double,
        'boost_at': -1::bigint, 'p': a.p, 's': a.s, 'n': a.n}
      when e.pos < a.covered then a
      else {'covered': e.pos + e.n,
        'negate': case when e.negate is null then a.negate
          else e.negate * case when e.pos <= a.until then a.negate else 1.0::double end end,
        'until': case when e.negate is null then a.until else e.pos + e.n + 2 end,
        'boost': case when e.boost is null then a.boost
          else e.boost * case when e.pos = a.boost_at then a.boost else 1.0::double end end,
        'boost_at': case when e.boost is null then a.boost_at else e.pos + e.n end,
        'p': a.p + case when e.p is null then 0.0::double else greatest(-1.0::double, least(1.0::double, e.p
            * case when e.pos = a.boost_at then a.boost else 1.0::double end
            * case when e.pos <= a.until then a.negate else 1.0::double end)) end,
        's': a.s + case when e.s is null then 0.0::double else greatest(0.0::double, least(1.0::double, e.s
            * case when e.pos = a.boost_at then a.boost else 1.0::double end)) end,
        'n': a.n + case when e.p is null then 0 else 1 end} end,
    {'covered': 0::bigint, 'negate': 1.0::double, 'until': -1::bigint, 'boost': 1.0::double,
     'boost_at': -1::bigint, 'p': 0.0::double, 's': 0.0::double, 'n': 0::bigint}) as a
  from event group by id
)
select d.id as doc_id,
  round(case when text is not null then case when a.n > 0 then a.p / a.n else 0.0 end end, 8) as sentiment_polarity,
  round(case when text is not null then case when a.n > 0 then a.s / a.n else 0.0 end end, 8) as sentiment_subjectivity
from docs d left join folded f using (id)
"""

# The tagger: tags 0 for words outside of names, then two for each of the five types.
_TAGGED = """
with listed as (
  select doc_id, regexp_extract_all(text,
    '([\\p{L}\\p{M}]+(?:[''’-][\\p{L}\\p{M}]+)*|[.!?]+|[^\\s\\p{L}\\p{M}])') as list
  from documents where text is not null
),
placed as (select doc_id, unnest(list) as w, generate_subscripts(list, 1) - 1 as i from listed),
token as (
  select *, regexp_matches(w, '^\\p{Lu}') as cap,
    i = 0 or regexp_matches(lag(w) over (partition by doc_id order by i), '^[.!?]') as begins
  from placed
),
known(name, kind) as (
  values ('The', 0), ('Of', 3), ('Ción', 1), ('Orre', 2), ('Éèpa Éèpa', 1), ('Is Of', 2), ('And', 2)
),
open_token as (
  select doc_id, i, w, i - row_number() over (partition by doc_id order by i) as run
  from token where cap and not begins
),
open_run as (
  select doc_id, run, string_agg(w, ' ' order by i) as name, min(i) as start from open_token group by all
),
judged as (
  select o.doc_id, o.i, r.start, o.run, k.kind as whole, s.kind as single,
    lag(s.kind) over (partition by o.doc_id, o.run order by o.i) as single_before
  from open_token o join open_run r using (doc_id, run)
  left join known k on k.name = r.name left join known s on s.name = o.w
),
inside as (
  select doc_id, i, case
    when whole is not null then 2 * whole + case when i = start then 1 else 2 end
    when single is not null then 2 * single + 1
    when i > start and single_before is null then 10 else 9 end as tag
  from judged
),
tagged as (
  select t.doc_id, t.i, t.w, t.cap, case when t.cap then n.tag else 0 end as tag
  from token t left join inside n using (doc_id, i)
),
step as (
  select a, b, count(*) as n from (
    select tag as a, lead(tag) over (partition by doc_id order by i) as b from tagged
  ) where a is not null and b is not null group by all
),
counted as (
  select lower(w) as word, tag, count(*) as n, bool_or(cap) as cap
  from tagged where regexp_matches(w, '^\\p{L}') group by 1, 2
),
vocabulary as (select greatest(count(distinct word), 1) as v from counted where tag is not null),
tags as (select range as t from range(11)),
total as (
  select t, coalesce(sum(n), 0) as n, greatest(count(word), 1) as k
  from tags left join counted on tag = t group by t
),
capital as (select word from counted group by word having bool_or(cap)),
step_sum as (
  select *, sum(n) over (partition by a) + count(*) filter (where allowed) over (partition by a) as whole from (
    select x.t as a, y.t as b, coalesce(n, 0) as n,
      y.t = 0 or y.t % 2 = 1 or ((y.t - 1) // 2 = (x.t - 1) // 2 and x.t > 0) as allowed
    from tags x cross join tags y left join step on a = x.t and b = y.t
  )
),
step_score as (
  select list(scores order by a) as st from (
    select a, list(case when allowed then cast(round(1000 * ln(cast(n + 1 as double) / whole)) as bigint)
      else -1000000000 end order by b) as scores
    from step_sum group by a
  )
),
exact as (
  select p.word, p.t, coalesce(c.n, 0) as n from (select word, t from capital cross join tags) p
  left join counted c on c.word = p.word and c.tag = p.t
),
scored as (
  select word, list(cast(round(1000 * ln(
    cast(e.n * v + k as double) / cast((total.n + k) * v as double))) as bigint) order by e.t) as scores
  from exact e join total on total.t = e.t cross join vocabulary group by word
),
candidate as (
  select doc_id, i, w, i - row_number() over (partition by doc_id order by i) as run,
    list_transform(scores, lambda x, j: x + case when j = 1 and not begins then within else 0 end) as scores
  from token join scored on word = lower(w), (select cast(round(1000 * ln(1 / 100::double)) as bigint) as within)
  where cap
),
decoded as (
  select doc_id, run, words, list_reduce(lists, lambda s, x: {
      'best': list_transform(range(1, 12), lambda t: x[t]
        + list_max(list_transform(range(1, 12), lambda a: s.best[a] + st[a][t]))),
      'path': list_transform(range(1, 12), lambda t: s.path[list_position(
        list_transform(range(1, 12), lambda a: s.best[a] + st[a][t]),
        list_max(list_transform(range(1, 12), lambda a: s.best[a] + st[a][t])))] || ',' || t)},
    {'best': [0::bigint] || list_transform(range(10), lambda r: -1000000000000::bigint),
     'path': list_transform(range(11), lambda r: '')}) as s, st
  from (
    select doc_id, run, list(scores order by i) as lists, list({'i': i, 'w': w} order by i) as words
    from candidate group by all
  ) cross join step_score
),
chosen as (
  select doc_id, run, unnest(words) as word, cast(unnest(string_split(s.path[list_position(
      list_transform(range(1, 12), lambda a: s.best[a] + st[a][1]),
      list_max(list_transform(range(1, 12), lambda a: s.best[a] + st[a][1])))][2:], ',')) as int) - 1 as tag
  from decoded
),
grouped as (
  select *, sum(tag % 2) over (partition by doc_id, run order by word.i) as nth from chosen where tag > 0
),
mention as (
  select doc_id, min(word.i) as i, string_agg(word.w, ' ' order by word.i) as entity,
    ['ART', 'LOC', 'PER', 'PREP', 'MISC'][(min(tag) + 1) // 2] as type
  from grouped group by doc_id, run, nth
)
select d.doc_id, cast(count(entity) as int) as n,
  coalesce(string_agg(entity, ' ' order by i), '') as entities,
  coalesce(string_agg(type, ' ' order by i), '') as types
from documents d left join mention m using (doc_id) where d.text is not null group by d.doc_id
"""

_LABEL_DOMAIN = """
domain as (
  select * from (values (0, 'click'), (1, 'error'), (2, 'nosuch'), (3, 'purchase'), (4, 'signup'),
                        (5, 'view')) t(position, member)
)"""

_STATE_DOMAIN = """
domain as (
  select cast(range as int) as position, 'N' || cast(range as varchar) as member from range(26)
)"""

_BAND = """case when sentiment_polarity < -0.3 then 'red'
  when sentiment_polarity <= 0.3 then 'blue' else 'green' end"""


def _means_by(column: str, domain: str) -> str:
    return f"""
with {_BASE}, {domain},
means as (
  select {column}, avg(sentiment_polarity) as p, avg(sentiment_subjectivity) as s
  from posts group by 1
)
select position, member as {column}, round(p, 8) as polarity, round(s, 8) as subjectivity
from domain left join means on {column} = member
"""


_MEAN_ALL = f"""
with {_BASE},
chosen as (
  select * from posts where cast(date as date) between date '2024-01-01' and date '2024-01-02'
),
domain as (
  select 'overall' as dimension, 0 as position, 'overall' as member
  union all
  select 'aidr_label', * from (values (0, 'click'), (1, 'error'), (2, 'nosuch'), (3, 'purchase'),
                                      (4, 'signup'), (5, 'view'))
  union all
  select 'place_state', cast(range as int), 'N' || cast(range as varchar) from range(26)
),
grouped as (
  select 'overall' as dimension, 'overall' as member, avg(sentiment_polarity) as p,
    avg(sentiment_subjectivity) as s from chosen
  union all
  select 'aidr_label', aidr_label, avg(sentiment_polarity), avg(sentiment_subjectivity)
  from chosen group by 2
  union all
  select 'place_state', place_state, avg(sentiment_polarity), avg(sentiment_subjectivity)
  from chosen group by 2
),
means as (
  select dimension, position, member, p as polarity, s as subjectivity
  from domain left join grouped using (dimension, member)
)"""

_PYRAMID = f"""{_BASE},
cells as (
  select least(greatest(cast(floor((longitude + 180) / 360.0::double * 256) as bigint), 0), 255) as x,
    least(greatest(cast(floor((90 - latitude) / 180.0::double * 256) as bigint), 0), 255) as y, *
  from (select *, {_BAND} as band from posts where latitude is not null and longitude is not null)
),
pyramid as (
  select cast(level as int) as level, x >> cast(8 - level as int) as x, y >> cast(8 - level as int) as y,
    count(*) as n,
    count(*) filter (where band = 'red') as n_red, count(*) filter (where band = 'blue') as n_blue,
    count(*) filter (where band = 'green') as n_green, count(*) as n_scored,
    sum(sentiment_polarity) as sum_polarity, sum(sentiment_subjectivity) as sum_subjectivity,
    sum(latitude) as sum_latitude, sum(longitude) as sum_longitude
  from cells cross join (select range as level from range(9)) group by all
)"""

_X_BIN = """cast(least(greatest(floor((sentiment_polarity + 1) / 2.0::double * 40), 0), 39) as int)"""
_Y_BIN = """cast(least(greatest(floor(sentiment_subjectivity / 1.0::double * 40), 0), 39) as int)"""


def _histogram(column: str) -> str:
    return f"""with {_BASE}
select {column}, {_X_BIN} as x_bin, count(*) as n, round(sum(sentiment_polarity), 6) as total
from posts group by all"""


_ENRICHED = f"""with {_RAW}, {_LABEL_ROWS}, {_scored("derived")}
select d.id, d.name, d.screen_name, d.verified, d.text, d.possibly_sensitive, d.favorite_count,
  strftime(d.date, '%Y-%m-%d %H:%M:%S') as date,
  round(s.polarity, 8) as sentiment_polarity, round(s.subjectivity, 8) as sentiment_subjectivity,
  r.aidr_label, d.place_latitude, d.place_longitude, d.place_name, d.longitude, d.latitude,
  d.place_state,
  cast(case when d.date < timestamp '2024-01-02 00:00:00' then 0
            when d.date <= timestamp '2024-01-03 00:00:00' then 1
            when d.date is not null then 2 end as int) as phase,
  cast(hour(d.date) + 1 as int) as timerange_end
from derived d join label_rows r on r.id = d.id join scored s on s.id = d.id
where d.aidr_label <> 'purchase'"""

_FILTERED = f"""with {_BASE}
select id, aidr_label, verified, possibly_sensitive, date_text as date, place_state, phase,
  sentiment_polarity, sentiment_subjectivity
from posts where aidr_label in ('view', 'click', 'error') and verified and not possibly_sensitive
  and cast(date as date) between date '2024-01-01' and date '2024-01-02' and phase in (0, 1)"""

SQL: dict[str, str] = {
    "parse_labels": f"with {_LABEL_ROWS} select * from label_rows",
    "reject_labels": f"with {_LABEL_ROWS} select * from label_rows where id is null",
    "project_flatten": f"""with {_RAW}
select id, name, screen_name, verified, text, full_text, created_at,
  case when aidr_label = 'purchase' then id end as reposted_id, truncated, possibly_sensitive,
  favorite_count, place_name, longitude as first_coordinate from raw""",
    "drop_reposts": f"with {_RAW} select id from raw where aidr_label <> 'purchase'",
    "effective_text": f"with {_RAW} select id, text from derived",
    "parse_post_date": f"""with {_RAW}
select id, strftime(date, '%Y-%m-%d %H:%M:%S') as date from derived""",
    "place_point": f"with {_RAW} select id, place_latitude, place_longitude from derived",
    "exact_point": f"with {_RAW} select id, longitude, latitude from derived",
    "place_state": f"with {_RAW} select id, place_name, place_state from derived",
    "phase_bucket": f"with {_BASE} select id, phase from posts",
    "hour_bucket": f"with {_BASE} select id, timerange_end from posts",
    "label_join": f"""with {_LABEL_ROWS}
select d.doc_id as id, d.lang, r.aidr_label
from documents d join label_rows r on r.id = d.doc_id""",
    "label_join_bucketed": f"""with {_LABEL_ROWS}
select d.doc_id as id, d.lang, r.aidr_label
from documents d join label_rows r on r.id = d.doc_id""",
    "enrich_posts": _ENRICHED,
    "enrich_arriving": _ENRICHED,
    "reject_posts": f"""with {_RAW}
select id, created_at,
  case when text is null or (truncated and full_text is null) then 'no text'
    else 'unreadable date' end as reason
from raw where aidr_label <> 'purchase'
  and (text is null or (truncated and full_text is null) or aidr_label = 'error')""",
    "sentiment_score": _SCORES,
    "sentiment_score_joined": _SCORES,
    "tag_names": _TAGGED,
    "sentiment_scoped": _SCOPED_SCORES,
    "sentiment_scoped_joined": _SCOPED_SCORES,
    "extract_mentions": _MENTION_LISTS,
    "extract_mentions_joined": _MENTION_LISTS,
    "explode_mentions": f'with {_MENTIONS} select entity as "Entity", type as "Type" from mentions',
    "canonical_mentions": f'with {_MENTIONS} select "Entity", "Type" from canonical',
    "mention_counts": _MENTION_COUNTS,
    "mention_counts_stepwise": _MENTION_COUNTS,
    "merge_counts": _TOTALS,
    "entity_table": _TOTALS,
    "filter_labels": f"""with {_BASE}
select id, aidr_label from posts where aidr_label in ('view', 'signup')""",
    "filter_day": f"""with {_BASE}
select id, date_text as date from posts where cast(date as date) = date '2024-01-03'""",
    "filter_day_range": f"""with {_BASE}
select id, date_text as date, phase from posts
where cast(date as date) >= date '2024-01-02' and cast(date as date) <= date '2024-01-03'""",
    "filter_place": f"""with {_BASE}
select id, place_state from posts where place_state in ('N1', 'N7', 'N21')""",
    "filter_verified": f"with {_BASE} select id, verified from posts where verified",
    "filter_sensitive": f"""with {_BASE}
select id, possibly_sensitive from posts where not possibly_sensitive""",
    "filter_phase": f"with {_BASE} select id, phase from posts where phase in (1, 2)",
    "filter_posts": _FILTERED,
    "filter_clustered": _FILTERED,
    "refine_twice": f"""with {_BASE}
select id, aidr_label, place_state, date_text as date, phase
from posts where aidr_label = 'click' and phase = 0 and place_state in ('N1', 'N2', 'N6', 'N11')""",
    "selection_count": f"with {_BASE} select count(*) as n from posts where phase = 0",
    "mean_overall": f"""with {_BASE}
select round(avg(sentiment_polarity), 8) as polarity,
  round(avg(sentiment_subjectivity), 8) as subjectivity from posts where phase = 1""",
    "mean_by_label": _means_by("aidr_label", _LABEL_DOMAIN),
    "mean_by_state": _means_by("place_state", _STATE_DOMAIN),
    "mean_all": f"""{_MEAN_ALL}
select dimension, position, member, round(polarity, 8) as polarity,
  round(subjectivity, 8) as subjectivity from means""",
    "mean_captions": f"""{_MEAN_ALL}
select dimension, position, member,
  case when polarity is null then null when polarity < -0.3 then 'red'
       when polarity <= 0.3 then 'blue' else 'green' end as band,
  case when polarity is null then 'no data'
       else printf('%.4f, %.4f', polarity, subjectivity) end as caption from means""",
    "rollup_cells": f"""with {_BASE}
select aidr_label, place_state, phase, strftime(date_trunc('day', date), '%Y-%m-%d %H:%M:%S') as date,
  verified, possibly_sensitive, count(*) as posts,
  round(sum(sentiment_polarity), 8) as sum_polarity, count(sentiment_polarity) as count_polarity,
  round(sum(sentiment_subjectivity), 8) as sum_subjectivity,
  count(sentiment_subjectivity) as count_subjectivity
from posts group by all""",
    "rollup_all_means": f"""{_MEAN_ALL}
select dimension, position, member, round(polarity, 8) as polarity,
  round(subjectivity, 8) as subjectivity from means""",
    "rollup_size": f"""with {_BASE}
select count(*) as n from posts where phase = 0 and verified and not possibly_sensitive""",
    "sentiment_band": f"with {_BASE} select id, sentiment_polarity, {_BAND} as band from posts",
    "markers_exact": f"""with {_BASE}
select latitude, longitude, {_BAND} as band, sentiment_polarity, sentiment_subjectivity
from posts where latitude is not null and longitude is not null""",
    "markers_place": f"""with {_BASE}
select place_latitude, place_longitude, {_BAND} as band, sentiment_polarity,
  sentiment_subjectivity, place_name
from posts where place_latitude is not null and place_longitude is not null""",
    "points_pol_subj": f"with {_BASE} select sentiment_polarity, sentiment_subjectivity from posts",
    "points_label_pol": f"with {_BASE} select aidr_label, sentiment_polarity from posts",
    "points_state_pol": f"with {_BASE} select place_state, sentiment_polarity from posts",
    "result_table": f"""with {_BASE}
select aidr_label, name, screen_name, date_text as date, verified, latitude, longitude, place_name,
  place_latitude, place_longitude, possibly_sensitive, sentiment_polarity, sentiment_subjectivity,
  favorite_count, text, phase from posts""",
    "result_pages": f"""with {_BASE}
select cast((row_number() over (order by date nulls first, id) - 1) // 40 + 1 as int) as page, id,
  date_text as date, aidr_label
from posts where aidr_label in ('view', 'click') order by posts.date nulls first, id limit 200""",
    "map_tiles": f"""with {_PYRAMID}
select level, x, y, n, n_red, n_blue, n_green, n_scored, round(sum_polarity, 6) as sum_polarity,
  round(sum_subjectivity, 6) as sum_subjectivity, round(sum_latitude, 6) as sum_latitude,
  round(sum_longitude, 6) as sum_longitude from pyramid""",
    "map_box": f"""with {_PYRAMID}
select level, x, y, n, n_red, n_blue, n_green, round(sum_latitude / n, 8) as latitude,
  round(sum_longitude / n, 8) as longitude, round(sum_polarity / n_scored, 8) as polarity,
  round(sum_subjectivity / n_scored, 8) as subjectivity
from pyramid where level = 4 and x between 4 and 12 and y between 4 and 12""",
    "density_pol_subj": f"""with {_BASE}
select {_X_BIN} as x_bin, {_Y_BIN} as y_bin, count(*) as n, count(*) as n_pairs,
  round(sum(sentiment_polarity), 6) as sum_x, round(sum(sentiment_subjectivity), 6) as sum_y,
  round(sum(sentiment_polarity ** 2), 6) as sum_xx, round(sum(sentiment_subjectivity ** 2), 6) as sum_yy,
  round(sum(sentiment_polarity * sentiment_subjectivity), 6) as sum_xy
from posts group by 1, 2""",
    "density_label_pol": _histogram("aidr_label"),
    "density_state_pol": _histogram("place_state"),
    "correlation_by_label": f"""with {_BASE}
select aidr_label, count(*) as n, count(*) as n_pairs,
  round(corr(sentiment_polarity, sentiment_subjectivity), 6) as correlation
from posts group by 1""",
}
