"""Listing, searching and looking up places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeloom.functions import hours
from placeloom.functions.geo import in_box
from placeloom.functions.scores import age_days, first_full, legs, place_rank, richness, tier
from placeloom.functions.text import dedupe_name, search_text
from placeloom.operators.ranking import keep_first
from placeloom.operators.spatial import within
from placeloom.queries import query, table
from placeloom.sources.sinks import detail_shards, name_shards, pins

NOW = "2031-03-01 00:00:00"

#: Days and ranges of map syntax: v (id, h), told (id, with any day), wk (id, n, o, c).
_WEEKS = r"""
WITH v AS (SELECT DISTINCT id, opening_hours_osm AS h FROM verify_positions WHERE opening_hours_osm IS NOT NULL),
days AS (SELECT * FROM (VALUES (1, 'Mo'), (2, 'Tu'), (3, 'We'), (4, 'Th'), (5, 'Fr'), (6, 'Sa'), (7, 'Su')) AS t(n, day)),
u AS (SELECT id, unnest(range(1, len(rs) + 1)) AS k, unnest(rs) AS rule FROM (SELECT id, string_split(h, ';') AS rs FROM v WHERE NOT regexp_matches(h, '24\s*/\s*7'))),
p AS (SELECT id, k, regexp_extract(regexp_replace(rule, '^\s+|\s+$', '', 'g'), '^(\S+)\s+(.+)$', ['d', 't']) AS g FROM u),
q AS (SELECT id, k, string_split(g.d, ',') AS ds, string_split(g.t, ',') AS ts FROM p WHERE g.d <> ''),
good AS (SELECT * FROM q WHERE len(list_filter(ds, lambda x: NOT regexp_matches(x, '^[A-Za-z]{2}(-[A-Za-z]{2})?$'))) = 0),
ends AS (SELECT id, k, upper(substr(x, 1, 1)) || lower(substr(x, 2, 1)) AS a, upper(substr(x, len(x) - 1, 1)) || lower(substr(x, len(x), 1)) AS b FROM (SELECT id, k, unnest(ds) AS x FROM good)),
named AS (SELECT DISTINCT id, k, d.n FROM ends JOIN days a ON a.day = ends.a JOIN days b ON b.day = ends.b JOIN days d ON CASE WHEN a.n <= b.n THEN d.n BETWEEN a.n AND b.n ELSE d.n >= a.n OR d.n <= b.n END),
spans AS (SELECT id, k, unnest(ts) AS t FROM good),
shut AS (SELECT DISTINCT id, k FROM spans WHERE NOT regexp_matches(t, '\d{1,2}:\d{2}\s*-\s*\d{1,2}:\d{2}') AND regexp_matches(t, '(?i)off|closed')),
r AS (SELECT id, k, regexp_extract(t, '(\d{1,2}):(\d{2})\s*-\s*(\d{1,2}):(\d{2})', ['a', 'b', 'c', 'd']) AS x FROM spans WHERE regexp_matches(t, '\d{1,2}:\d{2}\s*-\s*\d{1,2}:\d{2}')),
w AS (SELECT id, n, x.a::INT * 60 + x.b::INT AS o, CASE WHEN x.c::INT * 60 + x.d::INT = 0 THEN 1440 ELSE x.c::INT * 60 + x.d::INT END AS c FROM r JOIN named USING (id, k) ANTI JOIN shut USING (id, k)),
wk AS (SELECT id, n, o, c FROM w UNION ALL SELECT id, n, 0, 1440 FROM v, days WHERE regexp_matches(h, '24\s*/\s*7')),
told AS (SELECT DISTINCT id FROM named UNION SELECT id FROM v WHERE regexp_matches(h, '24\s*/\s*7'))
"""


def pois(spark: SparkSession, d: str) -> DataFrame:
    """One record an id, with the age of its last touch, its evidence, tier and rank."""
    v = keep_first(table(spark, d, "verify_positions"), "id", F.asc("loaded_at"))
    touched = F.when(F.col("osm_touched").rlike(r"^\d{4}-\d{2}-\d{2}T"), F.try_to_timestamp(F.replace("osm_touched", F.lit("Z"), F.lit("+00:00"))))
    days = age_days(touched, F.lit(NOW).cast("timestamp"))
    v = v.withColumn("touched_days", days).withColumn("evidence", legs(F.col("sources"), F.col("touched_days")))
    v = v.withColumn("tier", tier(F.col("evidence")))
    return v.withColumn("p_rank", place_rank(F.col("tier"), F.lit(None).cast("double")))


_POIS = r"""
WITH v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at) AS nth FROM verify_positions) WHERE nth = 1),
a AS (SELECT *, CASE WHEN regexp_matches(osm_touched, '^\d{4}-\d{2}-\d{2}T') THEN CAST(floor((1930089600 - epoch(TRY_CAST(replace(osm_touched, 'Z', '+00:00') AS TIMESTAMPTZ))) / 86400) AS INTEGER) END AS days FROM v),
w AS (SELECT *, CASE WHEN sources[1] = 'fsa' THEN 1.0 WHEN sources[1] = 'servicemap' THEN 1.0 WHEN sources[1] IN ('ch', 'atp') THEN 0.8 WHEN sources[1] = 'nhs' THEN 0.7 WHEN sources[1] = 'osm' THEN CASE WHEN days < 182 THEN 0.7 ELSE 0.7 * greatest(0.0, least(1.0, 1 - (coalesce(least(days, 547), 547) - 182) / 365.0)) + 0.3 * (1 - greatest(0.0, least(1.0, 1 - (coalesce(least(days, 547), 547) - 182) / 365.0))) END ELSE 0.0 END::DOUBLE AS weight FROM a),
p AS (SELECT *, round_even(least(weight, 3.0), 1) AS tier FROM w)
"""


def hidden(df: DataFrame) -> Column:
    """Records that listings leave out: without a position, or map records nobody touched for long and nothing vouches for."""
    alone = F.col("sources") == F.array(F.lit("osm"))
    stale = alone & (F.coalesce(F.col("touched_days"), F.lit(10_000)) >= 547) & ~F.col("category").isin("hotel")
    return F.col("lat").isNull() | F.col("lng").isNull() | F.coalesce(stale, F.lit(False))


_HIDDEN = "(lat IS NULL OR lng IS NULL OR (sources = ['osm'] AND coalesce(days, 10000) >= 547 AND coalesce(category <> 'hotel', false)))"


@query(_POIS + f"SELECT id, name, category, tier, round_even(tier * 10, 2) AS p_rank FROM p WHERE NOT {_HIDDEN} AND lat BETWEEN 50 AND 64 AND lng BETWEEN -3 AND 5")
def browse_ranked(spark: SparkSession, d: str) -> DataFrame:
    """Visible places of a box, best evidence first."""
    p = pois(spark, d)
    box = in_box(F.col("lat"), F.col("lng"), (50.0, -3.0, 64.0, 5.0))
    return p.where(~hidden(p) & box).select("id", "name", "category", "tier", "p_rank").orderBy(F.desc("tier"), "id")


@query(_POIS + "SELECT id, days, tier FROM p WHERE sources[1] = 'osm'")
def evidence_tier(spark: SparkSession, d: str) -> DataFrame:
    """Trust in map records as their last touch grows old."""
    return pois(spark, d).where(F.get("sources", F.lit(0)) == "osm").select("id", F.col("touched_days").alias("days"), "tier")


@query(_POIS + f"SELECT category, count(*) AS n, count(*) FILTER ({_HIDDEN}) AS hidden FROM p GROUP BY category")
def hidden_counts(spark: SparkSession, d: str) -> DataFrame:
    p = pois(spark, d)
    return p.groupBy("category").agg(F.count("*").alias("n"), F.count_if(hidden(p)).alias("hidden"))


@query(_POIS + "SELECT tier, count(*) AS n FROM p GROUP BY tier")
def tier_histogram(spark: SparkSession, d: str) -> DataFrame:
    return pois(spark, d).groupBy("tier").agg(F.count("*").alias("n"))


@query("""
SELECT id, name FROM (SELECT DISTINCT id, name, lower(concat_ws(' ', coalesce(name, ''), coalesce(category, ''), coalesce(address, ''))) AS t FROM verify_positions) WHERE contains(t, 'station road') ORDER BY id LIMIT 10""")
def text_search(spark: SparkSession, d: str) -> DataFrame:
    """The first ten records that hold the words looked for."""
    v = table(spark, d, "verify_positions").select("id", "name", search_text("name", "category", "address").alias("t")).where(F.contains("t", F.lit("station road")))
    return v.select("id", "name").distinct().orderBy("id").limit(10)


@query("""
SELECT id, CAST(round(100.0 * ((CASE WHEN coalesce(phone, '') <> '' THEN 1 ELSE 0 END) + (CASE WHEN coalesce(website, '') <> '' THEN 1 ELSE 0 END) + (CASE WHEN coalesce(address, '') <> '' THEN 1 ELSE 0 END) + (CASE WHEN coalesce(opening_hours_osm, '') <> '' THEN 1 ELSE 0 END) + (CASE WHEN len(coalesce(sources, [])) > 0 THEN 1 ELSE 0 END)) / 5) AS INTEGER) AS richness
FROM (SELECT DISTINCT ON (id) * FROM verify_positions ORDER BY id, loaded_at)""")
def richness_scores(spark: SparkSession, d: str) -> DataFrame:
    """How much of a record is filled, per cent."""
    v = keep_first(table(spark, d, "verify_positions"), "id", F.asc("loaded_at"))
    return v.select("id", richness({"phone": "string", "website": "string", "address": "string", "opening_hours_osm": "string", "sources": "array<string>"}).alias("richness"))


@query("""
WITH v AS (SELECT DISTINCT id, name, lat, lng, sources[1] AS s, regexp_replace(lower(coalesce(name, '')), '[^a-z0-9åäö]', '', 'g') AS k FROM verify_positions WHERE lat IS NOT NULL AND lng IS NOT NULL),
c AS (SELECT * FROM v WHERE s <> 'osm'), l AS (SELECT * FROM v WHERE s = 'osm')
SELECT id, 'curated' AS origin FROM c UNION ALL SELECT id, 'live' FROM l WHERE NOT EXISTS (SELECT 1 FROM c WHERE abs(c.lat - l.lat) < 0.01 AND abs(c.lng - l.lng) < 0.01
  AND sqrt(((c.lat - l.lat) * 111320) * ((c.lat - l.lat) * 111320) + ((c.lng - l.lng) * 62500) * ((c.lng - l.lng) * 62500)) < 60 AND (contains(c.k, substr(l.k, 1, 6)) OR contains(l.k, substr(c.k, 1, 6))))""")
def combined_listing(spark: SparkSession, d: str) -> DataFrame:
    """Curated records and those of a live layer that stand for no curated one nearby."""
    v = table(spark, d, "verify_positions").where("lat is not null and lng is not null").select("id", "lat", "lng", F.get("sources", F.lit(0)).alias("s"), dedupe_name("name").alias("k")).distinct()
    c, live = v.where("s <> 'osm'"), v.where("s = 'osm'")
    same = F.contains("r_k", F.substring("l_k", 1, 6)) | F.contains("l_k", F.substring("r_k", 1, 6))
    known = within(live, c, 60).where((F.col("dist_m") < 60) & same).select(F.col("l_id").alias("id")).distinct()
    return c.select("id", F.lit("curated").alias("origin")).unionByName(live.join(known, "id", "left_anti").select("id", F.lit("live").alias("origin")))


@query("SELECT id, coalesce(nullif(trim(phone), ''), nullif(trim(website), '')) AS contact FROM (SELECT id, max(phone) AS phone, max(website) AS website FROM verify_positions GROUP BY id)")
def first_contact(spark: SparkSession, d: str) -> DataFrame:
    """The first contact of a record that is filled."""
    v = table(spark, d, "verify_positions").groupBy("id").agg(F.max("phone").alias("phone"), F.max("website").alias("website"))
    return v.select("id", first_full(F.col("phone"), F.col("website")).alias("contact"))


@query(_WEEKS + "SELECT id, day, o, c FROM wk JOIN days USING (n)")
def hours_parsed(spark: SparkSession, d: str) -> DataFrame:
    """Opening hours as ranges of minutes, one row a day and range."""
    v = table(spark, d, "verify_positions").where("opening_hours_osm is not null").select("id", "opening_hours_osm").distinct().select("id", hours.week(F.col("opening_hours_osm")).alias("week"))
    # Outer, as a plain explode would first ask for the size of the week and read the text once more for it.
    days = v.select("id", F.explode_outer("week").alias("day", "ranges")).where("day is not null")
    return days.select("id", "day", F.explode("ranges").alias("r")).select("id", "day", "r.o", "r.c")


@query(_WEEKS + """SELECT id, CASE WHEN id IN (SELECT id FROM wk WHERE n = 4 AND o <= 750 AND (750 < c OR c < o) UNION ALL SELECT id FROM wk WHERE n = 3 AND c < o AND 750 < c) THEN 'open' WHEN id IN (SELECT id FROM told) THEN 'closed' ELSE 'unknown' END AS state FROM v""")
def open_at_noon(spark: SparkSession, d: str) -> DataFrame:
    """Which records are open on a Thursday at 12:30."""
    v = table(spark, d, "verify_positions").where("opening_hours_osm is not null").select("id", "opening_hours_osm").distinct()
    return v.select("id", hours.open_at(hours.week(F.col("opening_hours_osm")), F.lit("Th"), F.lit(750)).alias("state"))


@query(_WEEKS + """
, sa AS (SELECT id, bool_or(o <= 90 AND (90 < c OR c < o)) AS late, bool_or(o <= 90 AND 90 < c) AS strict, min(CASE WHEN o <= 90 AND 90 < c THEN c END) AS ends, min(CASE WHEN o > 90 THEN o END) AS begins FROM wk WHERE n = 6 GROUP BY id),
fr AS (SELECT id, bool_or(c < o AND 90 < c) AS late FROM wk WHERE n = 5 GROUP BY id)
SELECT v.id, CASE WHEN told.id IS NULL THEN 'unknown' WHEN sa.late OR fr.late THEN 'open' ELSE 'closed' END AS state, CASE WHEN told.id IS NULL THEN 'unknown' WHEN sa.strict THEN 'open' ELSE 'closed' END AS strict, coalesce(sa.ends, sa.begins) AS next
FROM v LEFT JOIN told USING (id) LEFT JOIN sa USING (id) LEFT JOIN fr USING (id)""")
def open_late_on_friday(spark: SparkSession, d: str) -> DataFrame:
    """Open at half past one in the night to Saturday, when Friday's hours run past midnight; and as a strict reader sees it."""
    v = table(spark, d, "verify_positions").where("opening_hours_osm is not null").select("id", "opening_hours_osm").distinct().select("id", hours.week(F.col("opening_hours_osm")).alias("week"))
    at = (F.col("week"), F.lit("Sa"), F.lit(90))
    return v.select("id", hours.open_at(*at).alias("state"), hours.open_at(*at, strict=True).alias("strict"), hours.next_change(*at).alias("next"))


@query(f"""
WITH n AS (SELECT coalesce(fsa_id, TRY_CAST(nullif(regexp_extract(osm_fhrs_id, '^\\s*0*([0-9]{{1,18}})\\s*$', 1), '') AS BIGINT)) AS number, opening_hours_osm AS h FROM verify_positions WHERE regexp_matches(opening_hours_osm, '[0-9]:[0-9]')),
two AS (SELECT number, min(h) AS a, max(h) AS b FROM n WHERE number IS NOT NULL GROUP BY number HAVING min(h) <> max(h)),
{_WEEKS.replace("WITH v AS (SELECT DISTINCT id, opening_hours_osm AS h FROM verify_positions WHERE opening_hours_osm IS NOT NULL)", "v AS (SELECT a AS id, a AS h FROM two UNION SELECT b, b FROM two)").strip()},
alld AS (SELECT DISTINCT id, n FROM named UNION SELECT id, n FROM wk),
dayed AS (SELECT a.id, a.n, list_sort(list((o, c)) FILTER (WHERE o IS NOT NULL)) AS rs FROM alld a LEFT JOIN wk ON wk.id = a.id AND wk.n = a.n GROUP BY a.id, a.n),
tab AS (SELECT v.id, coalesce(list_sort(list((n, coalesce(rs::VARCHAR, ''))) FILTER (WHERE n IS NOT NULL))::VARCHAR, '') AS t FROM v LEFT JOIN dayed USING (id) GROUP BY v.id),
pr AS (SELECT id, k, regexp_extract(regexp_replace(rule, '^\\s+|\\s+$', '', 'g'), '^([A-Za-z,\\-]+)\\s+(\\d{{2}}:\\d{{2}}-\\d{{2}}:\\d{{2}})', ['d', 't']) AS g FROM (SELECT id, unnest(range(1, len(rs) + 1)) AS k, unnest(rs) AS rule FROM (SELECT id, string_split(h, ';') AS rs FROM v))),
pe AS (SELECT id, k, t, upper(substr(a, 1, 1)) || lower(substr(a, 2, 1)) AS a, upper(substr(b, 1, 1)) || lower(substr(b, 2, 1)) AS b FROM (SELECT id, k, t, split_part(x, '-', 1) AS a, CASE WHEN contains(x, '-') THEN split_part(x, '-', 2) ELSE x END AS b FROM (SELECT id, k, g.t AS t, unnest(string_split(g.d, ',')) AS x FROM pr WHERE g.d <> ''))),
pd AS (SELECT DISTINCT id, k, t, d.n FROM pe JOIN days a ON a.day = pe.a JOIN days b ON b.day = pe.b JOIN days d ON CASE WHEN a.n <= b.n THEN d.n BETWEEN a.n AND b.n ELSE d.n >= a.n OR d.n <= b.n END),
pt AS (SELECT v.id, coalesce(list_sort(list((n, ts)) FILTER (WHERE n IS NOT NULL))::VARCHAR, '') AS t FROM v LEFT JOIN (SELECT id, n, list_sort(list(t))::VARCHAR AS ts FROM pd GROUP BY id, n) USING (id) GROUP BY v.id)
SELECT number, x.t = y.t AS same_table, regexp_replace(a, '\\s+', '', 'g') = regexp_replace(b, '\\s+', '', 'g') AS same_text, p.t = q.t AS same_plain FROM two JOIN tab x ON x.id = a JOIN tab y ON y.id = b JOIN pt p ON p.id = a JOIN pt q ON q.id = b""")
def hours_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Register numbers whose records state different hours, compared as tables and as texts."""
    v = table(spark, d, "verify_positions").where("opening_hours_osm rlike '[0-9]:[0-9]'")
    number = F.coalesce("fsa_id", F.regexp_extract("osm_fhrs_id", r"^\s*0*(\d{1,18})\s*$", 1).try_cast("bigint"))
    two = v.withColumn("number", number).where("number is not null").groupBy("number").agg(F.min("opening_hours_osm").alias("a"), F.max("opening_hours_osm").alias("b")).where("a <> b")
    return two.select("number", hours.same_hours(hours.week(F.col("a")), hours.week(F.col("b"))).alias("same_table"), hours.same_text(F.col("a"), F.col("b")).alias("same_text"), hours.same_hours(hours.week(F.col("a"), "plain"), hours.week(F.col("b"), "plain")).alias("same_plain"))


@query()
def spoken_hours(spark: SparkSession, d: str) -> DataFrame:
    """Schedules in running text."""
    t = table(spark, d, "documents").where("text is not null").select("doc_id", F.explode(hours.spoken(F.col("text"))).alias("h"))
    return t.select("doc_id", "h.rule", "h.raw", "h.kind")


@query("""
SELECT DISTINCT id, unnest(list_distinct(list_filter(string_split(trim(regexp_replace(regexp_replace(translate(lower(coalesce(name, '')), 'àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿšžœ', 'aaaaaaaceeeeiiiinoooooouuuuyyszo'), '[^a-z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g')), ' '), lambda w: w <> ''))) AS token FROM crawl_sites""")
def name_index(spark: SparkSession, d: str) -> DataFrame:
    """Words of names and the shards they are kept in."""
    return name_shards(table(spark, d, "crawl_sites").select("id", "name").distinct(), "id", "name").select("id", "token").distinct()


@query()
def map_pins(spark: SparkSession, d: str) -> DataFrame:
    """GeoJSON features with the shard of their details."""
    p = pois(spark, d)
    p = detail_shards(p.where(~hidden(p) & (F.abs("lat") < 85)))
    return p.select("id", "shard").join(pins(p, ["id", "tier", "category"]).select(F.get_json_object("feature", "$.properties.id").alias("id"), "feature"), "id")
