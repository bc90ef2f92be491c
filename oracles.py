"""DuckDB SQL giving the expected result of each registered query, over the driver's tables."""

from __future__ import annotations

import re

from fixtures import MIN_SIMILARITY, NAME_GENDER, SEGMENT_WANTED, SITE, WANTED
from sitescout.functions.text import ENGLISH_STOP_WORDS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _texts(values) -> str:
    return ", ".join(map(_text, values))


def _distance(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"6371 * acos(greatest(-1.0::double, least(1.0::double, cos(radians({lat1})) * cos(radians({lat2}))"
        f" * cos(radians({lon2}) - radians({lon1})) + sin(radians({lat1})) * sin(radians({lat2})))))"
    )


_WORD_SPLIT = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def _words(text: str) -> str:
    bare = rf"regexp_replace({text}, '[!-/:-@\[-`{{-~]', '', 'g')"
    return f"unnest(string_split_regex({bare}, '{_WORD_SPLIT}'))"


_DAY_NO = """case {day} when 'Sunday' then 1 when 'Monday' then 2 when 'Tuesday' then 3 when 'Wednesday' then 4
  when 'Thursday' then 5 when 'Friday' then 6 when 'Saturday' then 7 end"""

_SEGMENT_LISTS = " ".join(
    f"when {_text(segment)} then [{_texts(names)}]" for segment, names in SEGMENT_WANTED.items()
)

_BAG = "string_agg(word || ':' || n, ' ' order by word)"

CTES = {
    "business": """
select o_orderkey as business_id, concat('Order#', o_orderkey) as name, n_name as city, r_name as state,
       43.60::double + ((o_orderkey * 37) % 1000) * 0.004::double as latitude,
       -79.50::double + ((o_orderkey * 53) % 1000) * 0.005::double as longitude,
       1.0::double + 0.5::double * (o_orderkey % 9) as stars,
       cast((o_orderkey * 7) % 300 as int) as review_count,
       cast(case when o_orderstatus <> 'F' then 1 else 0 end as int) as is_open
from orders join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "business_categories": """
select distinct l_orderkey as business_id, unnest([p_name, p_name || ' ' || p_brand]) as category
from lineitem join part on l_partkey = p_partkey""",
    "checkin_hourly": """
select user_id + 15 * (event_id % 100) as business_id, dayname(ts) as day_of_week, concat(hour(ts), ':00') as day_hour,
       count(*) as check_in
from events group by 1, 2, 3""",
    "checkin_daily": """
select business_id, day_of_week, cast(sum(check_in) as bigint) as check_in
from checkin_hourly group by 1, 2""",
    "tip_tokens": f"""
select business_id, word
from (select case when substr(source, 4) = '0' then 0 else cast(substr(source, 4) as bigint) + 20 * (doc_id % 75) end
      as business_id, {_words('text')} as word from documents) as t
where word <> '' and lower(word) not in ({_texts(ENGLISH_STOP_WORDS)})""",
    "lexicon": f"""
select distinct word, case when length(word) <= 4 then 1 when length(word) <= 6 then -1 else 0 end as sentiment
from (select {_words('text')} as word from benchmark) as t where word <> ''""",
    "sentiment_words": """
select t.business_id, t.word, l.sentiment, count(*) as n
from tip_tokens as t join lexicon as l on t.word = l.word
where l.sentiment in (1, -1) group by 1, 2, 3""",
    "users": """
select c_custkey as user_id, c_name as name, cast(min(o_orderdate) as date) as yelp_since,
       count(case when o_orderstatus = 'F' then 1 end) as fans, count(o_orderkey) as review_count
from customer left join orders on c_custkey = o_custkey group by 1, 2""",
    "radius_search": f"""
select * from (
  select latitude, longitude, city, business_id, name, stars, review_count,
         {_distance(f"{SITE['lat']}::double", f"{SITE['lon']}::double", 'latitude', 'longitude')} as distance
  from business) as t
where distance < {SITE['km']}""",
    "category_containment": f"""
select business_id,
       count(distinct case when category in ({_texts(WANTED)}) then category end) / {len(WANTED)}::double as score
from business_categories group by business_id""",
    "competitors": """
select r.*, c.score
from radius_search as r join category_containment as c on r.business_id = c.business_id
where c.score >= 0.5""",
    "top_competitors": """
select business_id, name, distance, stars, review_count
from competitors order by stars desc, distance, business_id limit 5""",
    "weekday_profile": f"""
select {_DAY_NO.format(day='day_of_week')} as day_no, day_of_week as day, avg(check_in) as check_ins
from checkin_daily where business_id in (select business_id from competitors) group by 1, 2""",
    "hour_profile": """
select cast(split_part(day_hour, ':', 1) as int) as hour_no, day_hour as hour, avg(check_in) as check_ins
from checkin_hourly where business_id in (select business_id from competitors) group by 1, 2""",
    "word_counts": """
select sentiment, word as text, cast(sum(n) as bigint) as size
from sentiment_words where business_id in (select business_id from competitors) group by 1, 2""",
    "sites": f"""
select c_custkey as site_id,
       43.6015::double + ((c_custkey * 29) % 1000) * 0.004::double as lat,
       -79.4985::double + ((c_custkey * 41) % 1000) * 0.005::double as lon,
       5.0::double + c_nationkey as km,
       case c_mktsegment {_SEGMENT_LISTS} end as wanted
from customer""",
    "site_wants": "select site_id, unnest(wanted) as category, len(wanted) as wants from sites",
    "site_scores": """
select w.site_id, p.business_id, count(*) / cast(min(w.wants) as double) as score
from site_wants as w join business_categories as p on p.category = w.category
group by 1, 2 having count(*) / cast(min(w.wants) as double) >= 0.5""",
    "batch_competitors": f"""
select * from (
  select s.site_id, b.*, {_distance('s.lat', 's.lon', 'b.latitude', 'b.longitude')} as distance, c.score, s.km
  from site_scores as c join sites as s on s.site_id = c.site_id
  join business as b on b.business_id = c.business_id) as t
where distance < km""",
    "batch_word_counts": """
select k.site_id, s.sentiment, s.word as text, cast(sum(s.n) as bigint) as size
from batch_competitors as k join sentiment_words as s on s.business_id = k.business_id group by 1, 2, 3""",
    "category_profiles": """
select business_id, sha256(string_agg(category, chr(31) order by category)) as profile_id, count(*) as n
from business_categories group by business_id""",
    "profile_sizes": """
select profile_id, min(n) as n, count(*) as businesses, min(business_id) as member
from category_profiles group by profile_id""",
    "profile_categories": """
select s.profile_id, c.category from profile_sizes as s join business_categories as c on c.business_id = s.member""",
    "shared_categories": """
select a.profile_id as profile_id1, b.profile_id as profile_id2, count(*) as k
from profile_categories as a join profile_categories as b
  on a.category = b.category and a.profile_id < b.profile_id group by 1, 2""",
    "pairwise_jaccard": f"""
select * from (
  select k.profile_id1, k.profile_id2, x.businesses as businesses1, y.businesses as businesses2,
         k.k / cast(x.n + y.n - k.k as double) as jaccard
  from shared_categories as k join profile_sizes as x on x.profile_id = k.profile_id1
  join profile_sizes as y on y.profile_id = k.profile_id2) as t
where jaccard >= {MIN_SIMILARITY}""",
    "batch_ranked": """
select site_id, business_id, name, round(distance, 3) as distance, stars, review_count,
       cast(row_number() over (partition by site_id order by stars desc, round(distance, 3), business_id) as int) as rank
from batch_competitors""",
}


def _with(body: str) -> str:
    """``body`` after the definitions it needs, directly or through others."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", text):
                needed.add(name)
                pending.append(CTES[name])
    listed = ",\n".join(f"{name} as ({sql}\n)" for name, sql in CTES.items() if name in needed)
    return f"with {listed}\n{body}" if listed else body


_PLACE = "latitude, longitude, city, business_id, name, stars, review_count, round(distance, 4) as distance"

_BODIES = {
    "json_props_parse": "select event_id, cast(json_extract_string(props, '$.k') as int) as k from events",
    "json_inferred": """
select event_id, case when event_type = 'click' then value end as amount, case when event_type <> 'click' then user_id end as visitor,
       cast(json_extract_string(props, '$.k') as bigint) as k,
       case when event_id % 2 = 0 then '' else 'u' end || user_id as mark from events""",
    "literal_id_list_join": "select business_id, name from business where business_id in (1, 2, 3)",
    "keyed_upsert": """
with src as (select business_id, 1.0::double as stars from business where is_open = 0
             union all select cast(-1 as bigint), 5.0::double)
select business_id, name, stars, review_count from (
  select s.business_id, b.name, s.stars, b.review_count
  from src as s left join business as b on s.business_id = b.business_id
  union all
  select b.business_id, b.name, b.stars, b.review_count
  from business as b where not exists (select 1 from src where src.business_id = b.business_id)) as t""",
    "report_map_rows": f"""
select 'competitor' as kind, name, review_count, stars, round(distance, 4) as distance, latitude, longitude from competitors
union all
select 'site', 'Your Location', cast(null as int), cast(null as double), 0.0::double,
       {SITE['lat']}::double, {SITE['lon']}::double""",
    "business_directory": "select * from business",
    "user_directory": "select user_id, name, yelp_since, fans, review_count, cast(null as varchar) as gender from users",
    "radius_search": f"select {_PLACE} from radius_search",
    "category_containment": "select * from category_containment",
    "competitors": f"select {_PLACE}, score from competitors",
    "top_competitors": "select business_id, name, round(distance, 4) as distance, stars, review_count from top_competitors",
    "category_explode": "select business_id, category from business_categories",
    "category_sets": """
select business_id, string_agg(category, ', ' order by category) as categories
from business_categories group by business_id""",
    "business_id_list": "select business_id from business_categories",
    "category_dictionary": "select distinct category from business_categories",
    "category_search": """
select distinct category from business_categories where contains(category, 'bolt') or contains(category, 'Bolt')""",
    "category_search_indexed": """
select distinct category from business_categories where contains(category, 'bolt') or contains(category, 'Bolt')""",
    "category_cardinality": """
select count(distinct business_id) as businesses, count(distinct category) as categories from business_categories""",
    "category_cardinality_by_city": """
with placed as (select b.state, b.city, c.category, b.business_id from business as b join business_categories as c on b.business_id = c.business_id)
select 'city' as level, state, city, cast(null as varchar) as category, count(distinct business_id) as businesses from placed group by state, city
union all select 'state', state, null, null, count(distinct business_id) from placed group by state
union all select 'all', null, null, null, count(distinct business_id) from placed
union all select 'category', null, null, category, count(distinct business_id) from placed group by category""",
    "city_directory": """
select distinct concat(upper(substring(city, 1, 1)), lower(substring(city, 2))) as city, state from business""",
    "category_profiles": "select business_id, profile_id from category_profiles",
    "pairwise_jaccard": "select * from pairwise_jaccard",
    "similar_businesses": f"""
with sizes as (select business_id, count(*) as n from business_categories group by 1),
     met as (select a.business_id as business_id1, b.business_id as business_id2, count(*) as k
             from business_categories as a join business_categories as b
             on a.category = b.category and a.business_id <> b.business_id
             where a.business_id % 50 = 0 group by 1, 2)
select * from (select business_id1, business_id2, k / cast(x.n + y.n - k as double) as similarity
  from met join sizes as x on x.business_id = business_id1 join sizes as y on y.business_id = business_id2) as t
where similarity >= {MIN_SIMILARITY / 2}""",
    "checkin_hourly": "select * from checkin_hourly",
    "checkin_flatten_nested": "select * from checkin_hourly",
    "checkin_flatten_json": "select * from checkin_hourly",
    "checkin_daily": "select * from checkin_daily",
    "checkin_daily_delta": """
select business_id, day_of_week, cast(sum(check_in) as bigint) as check_in from (
  select business_id, day_of_week,
         check_in + case when day_of_week in ('Saturday', 'Sunday') then 1 else 0 end as check_in from checkin_hourly
  union all select business_id, 'Holiday', 1 from business where is_open = 1) as t
group by 1, 2""",
    "weekday_profile": "select * from weekday_profile",
    "hour_profile": "select * from hour_profile",
    "tip_tokens": "select business_id, word from tip_tokens",
    "business_tip_bag": """
select b.business_id, t.word, count(t.word) as n
from business as b left join tip_tokens as t on t.business_id = b.business_id group by 1, 2""",
    "business_word_lists": f"""
with listed as (
  select doc_id, case when substr(source, 4) = '0' then 0 else cast(substr(source, 4) as bigint) + 20 * (doc_id % 75) end as business_id,
         list_filter(string_split_regex(regexp_replace(text, '[!-/:-@\\[-`{{-~]', '', 'g'), '{_WORD_SPLIT}'),
                     lambda w: w <> '' and lower(w) not in ({_texts(ENGLISH_STOP_WORDS)})) as words from documents),
numbered as (
  select business_id, word, row_number() over (partition by business_id order by doc_id, i) - 1 as number
  from (select business_id, doc_id, unnest(words) as word, unnest(range(len(words))) as i from listed) as t)
select business_id, number // 1000 as chunk_no, count(*) as n, string_agg(word, ' ' order by number) as words
from numbered group by 1, 2""",
    "lexicon_join": "select t.business_id, t.word, l.sentiment from tip_tokens as t join lexicon as l on t.word = l.word",
    "lexicon_split": """
select 'positive' as side, word, sentiment from lexicon where sentiment = 1
union all select 'negative', word, sentiment from lexicon where sentiment = -1""",
    "lexicon_union": "select word, sentiment from lexicon where sentiment in (1, -1)",
    "business_sentiment": f"""
select b.business_id, coalesce(c.n_tokens, 0) as n_tokens, s.avg_sentiments,
       case when s.avg_sentiments > 0 then 1.0::double when s.avg_sentiments <= 0 then 0.0::double end as predicted,
       p.pos_words, q.neg_words
from (select distinct business_id from business) as b
left join (select business_id, count(*) as n_tokens from tip_tokens group by 1) as c on c.business_id = b.business_id
left join (select business_id, sum(n * sentiment) / cast(sum(n) as double) as avg_sentiments
           from sentiment_words group by 1) as s on s.business_id = b.business_id
left join (select business_id, {_BAG} as pos_words from sentiment_words where sentiment = 1 group by 1) as p
  on p.business_id = b.business_id
left join (select business_id, {_BAG} as neg_words from sentiment_words where sentiment = -1 group by 1) as q
  on q.business_id = b.business_id""",
    "positive_word_counts": "select text, size from word_counts where sentiment = 1",
    "negative_word_counts": "select text, size from word_counts where sentiment = -1",
    "name_enrichment": f"""
with dim as (select * from (values {', '.join(f'({_texts(row)})' for row in NAME_GENDER)}) as d(name, gender)),
     one as (select name, min(gender) as gender from dim group by name having count(distinct gender) = 1)
select c.c_custkey as user_id, c.c_mktsegment as name, one.gender
from customer as c left join one on one.name = c.c_mktsegment""",
    "sql_competitors": f"select {_PLACE}, score from competitors",
    "sql_weekday_profile": "select day, check_ins from weekday_profile",
    "site_report": f"""
with sections as (
  select 'weekday' as section, day as label, cast(day_no as int) as position, check_ins as value,
         null as name, null as distance, null as stars, null as review_count, null as latitude, null as longitude
  from weekday_profile
  union all select 'hour', hour, hour_no, check_ins, null, null, null, null, null, null from hour_profile
  union all select 'competitor', cast(business_id as varchar), null, round(distance, 4),
                   name, round(distance, 2), stars, review_count, null, null from competitors
  union all select 'top', cast(business_id as varchar), null, stars,
                   name, round(distance, 2), stars, review_count, null, null from top_competitors
  union all select case sentiment when 1 then 'positive' else 'negative' end, text, null, cast(size as double),
                   null, null, null, null, null, null from word_counts
  union all select 'map', 'competitor', null, round(distance, 4),
                   name, round(distance, 2), stars, review_count, latitude, longitude from competitors
  union all select 'map', 'site', null, 0.0, 'Your Location', 0.0, null, null, {SITE['lat']}, {SITE['lon']})
select section, label, position, cast(value as double) as value, cast(name as varchar) as name,
       cast(distance as double) as distance, cast(stars as double) as stars, cast(review_count as int) as review_count,
       cast(latitude as double) as latitude, cast(longitude as double) as longitude from sections""",
    "batch_competitors": "select site_id, business_id, name, stars, round(distance, 3) as distance, score from batch_competitors",
    "batch_top_competitors": "select * from batch_ranked where rank <= 5",
    "batch_nearest": f"""
select site_id, business_id, distance, cast(rank as int) as rank from (
  select *, row_number() over (partition by site_id order by distance, business_id) as rank from (
    select s.site_id, b.business_id, round({_distance('s.lat', 's.lon', 'b.latitude', 'b.longitude')}, 3) as distance
    from sites as s cross join business as b) as d) as t
where rank <= 5""",
    "batch_weekday_profile": f"""
select k.site_id, {_DAY_NO.format(day='d.day_of_week')} as day_no, d.day_of_week as day, avg(d.check_in) as check_ins
from checkin_daily as d join batch_competitors as k on k.business_id = d.business_id group by 1, 2, 3""",
    "batch_hour_profile": """
select k.site_id, cast(split_part(h.day_hour, ':', 1) as int) as hour_no, h.day_hour as hour, avg(h.check_in) as check_ins
from checkin_hourly as h join batch_competitors as k on k.business_id = h.business_id group by 1, 2, 3""",
    "batch_positive_word_counts": "select site_id, text, size from batch_word_counts where sentiment = 1",
    "batch_negative_word_counts": "select site_id, text, size from batch_word_counts where sentiment = -1",
}


def _whole(body: str) -> str:
    body = body.strip()
    prelude = re.match(r"with\s", body)
    if not prelude:
        return _with(body)
    # The body brings definitions of its own: put the shared ones in front of them.
    shared = _with(body)
    return re.sub(r"\)\s*\nwith\s", "),\n", shared, count=1)


ORACLES = {name: _whole(body) for name, body in _BODIES.items()}
