"""Places near places, in areas, along lines, and on tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeloom.functions.geo import box_overlap, haversine_m, in_box, padded, parse_box, tile
from placeloom.operators.proximity import near_join, near_pairs, points_in_regions, ring_of_box
from placeloom.operators.spatial import attach_host, best_each, create_unmatched, nearest_segment, one_to_one, path_segments, within, without
from placeloom.queries import query, table

_PLACED = "lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon) AND abs(lat) <= 90 AND NOT (lat = 0 AND lon = 0)"
_D = "sqrt(((l.lat - r.lat) * 111320) * ((l.lat - r.lat) * 111320) + ((l.lng - r.lng) * 62500) * ((l.lng - r.lng) * 62500))"
#: Register and map records with positions, one row an id.
_SIDES = """
l AS (SELECT DISTINCT id, name, category, lat, lng FROM verify_positions WHERE sources[1] = 'fsa' AND lat IS NOT NULL AND lng IS NOT NULL),
r AS (SELECT DISTINCT id, name, category, lat, lng FROM verify_positions WHERE sources[1] = 'osm' AND lat IS NOT NULL AND lng IS NOT NULL)"""


def sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Register records and map records with a position."""
    v = table(spark, d, "verify_positions")
    pick = lambda s: v.where((F.get("sources", F.lit(0)) == s) & F.col("lat").isNotNull() & F.col("lng").isNotNull()).select("id", "name", "category", "lat", "lng").distinct()
    return pick("fsa"), pick("osm")


@query(f"""
WITH p AS (SELECT DISTINCT id, lat, lon, CAST(floor(lat * 1000) AS BIGINT) AS band FROM overture WHERE {_PLACED}),
q AS (SELECT id, lat, lon, unnest([band - 1, band, band + 1]) AS band FROM p)
SELECT DISTINCT p.id AS id_a, q.id AS id_b FROM p JOIN q ON p.band = q.band AND p.id < q.id
WHERE 2 * 6371008.8 * asin(least(1, sqrt(pow(sin(radians(q.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(q.lat)) * pow(sin(radians(q.lon - p.lon) / 2), 2)))) <= 25""")
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of places at most 25 m apart."""
    return near_pairs(table(spark, d, "overture"), 25.0).select("id_a", "id_b")


@query(f"""
WITH p AS (SELECT DISTINCT id, lat, lon FROM overture WHERE {_PLACED})
SELECT id, area_id FROM p JOIN areas ON lon >= bbox[1] AND lon < bbox[3] AND lat >= bbox[2] AND lat < bbox[4]""")
def p1_regions(spark: SparkSession, d: str) -> DataFrame:
    """The area whose box holds each place."""
    areas = table(spark, d, "areas").withColumn("ring", ring_of_box("bbox"))
    places = table(spark, d, "overture").select("id", "lat", "lon").distinct()
    return points_in_regions(places, areas, "area_id", "ring").withColumnRenamed("region_id", "area_id")


@query(f"""
WITH p AS (SELECT DISTINCT id, lat, lon, CAST(floor(lat * 1000) AS BIGINT) AS band FROM overture WHERE {_PLACED}),
v AS (SELECT DISTINCT id, lat, lng AS lon, CAST(floor(lat * 1000) AS BIGINT) AS band FROM verify_positions WHERE {_PLACED.replace("lon", "lng")}),
q AS (SELECT id, lat, lon, unnest([band - 1, band, band + 1]) AS band FROM v)
SELECT DISTINCT p.id AS place_id, q.id AS record_id FROM p JOIN q ON p.band = q.band
WHERE 2 * 6371008.8 * asin(least(1, sqrt(pow(sin(radians(q.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(q.lat)) * pow(sin(radians(q.lon - p.lon) / 2), 2)))) <= 40""")
def p1_near(spark: SparkSession, d: str) -> DataFrame:
    """Records of the register, the map and others within 40 m of each place."""
    records = table(spark, d, "verify_positions").select("id", "lat", F.col("lng").alias("lon"))
    return near_join(table(spark, d, "overture"), records, 40.0).select(F.col("left_id").alias("place_id"), F.col("right_id").alias("record_id"))


@query(f"""
WITH {_SIDES}
SELECT fsa, osm, round(d, 3) AS dist_m FROM (
  SELECT l.id AS fsa, r.id AS osm, {_D} AS d, row_number() OVER (PARTITION BY l.id ORDER BY {_D}, r.id) AS n
  FROM l JOIN r ON abs(l.lat - r.lat) < 0.01 AND abs(l.lng - r.lng) < 0.01 WHERE {_D} <= 500) WHERE n = 1""")
def spatial_argmin(spark: SparkSession, d: str) -> DataFrame:
    """The nearest map record of each register record within 500 m."""
    a, b = sides(spark, d)
    best = best_each(within(a, b, 500), "l_id", F.asc("dist_m"), F.asc("r_id"))
    return best.select(F.col("l_id").alias("fsa"), F.col("r_id").alias("osm"), F.round("dist_m", 3).alias("dist_m"))


@query(f"""
WITH {_SIDES}
SELECT l.id FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE abs(l.lat - r.lat) < 0.01 AND abs(l.lng - r.lng) < 0.02 AND r.category = l.category AND {_D} <= 1000)""")
def spatial_anti(spark: SparkSession, d: str) -> DataFrame:
    """Register records without a map record of their category within 1000 m."""
    a, b = sides(spark, d)
    return without(a, within(a, b, 1000).where("l_category = r_category"), "id", "l_id").select("id")


@query(f"""
WITH {_SIDES}
SELECT l.id, count(*) AS candidates FROM l JOIN r ON abs(l.lat - r.lat) < 0.01 AND abs(l.lng - r.lng) < 0.02 WHERE {_D} <= 800 GROUP BY l.id""")
def spatial_candidates(spark: SparkSession, d: str) -> DataFrame:
    """How many map records stand around each register record."""
    a, b = sides(spark, d)
    return within(a, b, 800).groupBy(F.col("l_id").alias("id")).agg(F.count("*").alias("candidates"))


@query(f"""
WITH RECURSIVE {_SIDES},
p AS (SELECT l.id AS a, r.id AS b, {_D} AS d FROM l JOIN r ON abs(l.lat - r.lat) < 0.01 AND abs(l.lng - r.lng) < 0.02 WHERE l.category = r.category AND {_D} <= 800),
n AS (SELECT *, row_number() OVER (ORDER BY d, a, b) AS n FROM p),
g AS (SELECT 0::BIGINT AS n, []::VARCHAR[] AS ls, []::VARCHAR[] AS rs, NULL::VARCHAR AS a, NULL::VARCHAR AS b, NULL::DOUBLE AS d
  UNION ALL SELECT g.n + 1, CASE WHEN list_contains(ls, n.a) OR list_contains(rs, n.b) THEN ls ELSE list_append(ls, n.a) END, CASE WHEN list_contains(ls, n.a) OR list_contains(rs, n.b) THEN rs ELSE list_append(rs, n.b) END,
  CASE WHEN list_contains(ls, n.a) OR list_contains(rs, n.b) THEN NULL ELSE n.a END, n.b, n.d FROM g JOIN n ON n.n = g.n + 1)
SELECT a AS fsa, b AS osm, round(d, 3) AS dist_m FROM g WHERE a IS NOT NULL""")
def greedy_one_to_one(spark: SparkSession, d: str) -> DataFrame:
    """Register and map records of one category paired best first, none twice."""
    a, b = sides(spark, d)
    pairs = within(a, b, 800).where("l_category = r_category").select("l_id", "r_id", (-F.col("dist_m")).alias("score"))
    return one_to_one(pairs, "l_id", "r_id", "score").select(F.col("l_id").alias("fsa"), F.col("r_id").alias("osm"), F.round(-F.col("score"), 3).alias("dist_m"))


@query(f"""
WITH RECURSIVE {_SIDES},
p AS (SELECT l.id AS a, r.id AS b, {_D} AS d FROM l JOIN r ON abs(l.lat - r.lat) < 0.01 AND abs(l.lng - r.lng) < 0.02 WHERE l.category = r.category AND {_D} <= 800),
n AS (SELECT *, row_number() OVER (ORDER BY a, d, b) AS n FROM p),
g AS (SELECT 0::BIGINT AS n, []::VARCHAR[] AS ls, []::VARCHAR[] AS rs, NULL::VARCHAR AS a, NULL::VARCHAR AS b, NULL::DOUBLE AS d
  UNION ALL SELECT g.n + 1, CASE WHEN list_contains(ls, n.a) OR list_contains(rs, n.b) THEN ls ELSE list_append(ls, n.a) END, CASE WHEN list_contains(ls, n.a) OR list_contains(rs, n.b) THEN rs ELSE list_append(rs, n.b) END,
  CASE WHEN list_contains(ls, n.a) OR list_contains(rs, n.b) THEN NULL ELSE n.a END, n.b, n.d FROM g JOIN n ON n.n = g.n + 1)
SELECT a AS fsa, b AS osm FROM g WHERE a IS NOT NULL""")
def sequential_one_to_one(spark: SparkSession, d: str) -> DataFrame:
    """The same pairs, register records choosing in the order of their ids."""
    a, b = sides(spark, d)
    pairs = within(a, b, 800, on="category").select("l_id", "r_id", (-F.col("dist_m")).alias("score"))
    return one_to_one(pairs, "l_id", "r_id", "score", mode="in_order").select(F.col("l_id").alias("fsa"), F.col("r_id").alias("osm"))


@query(f"""
WITH RECURSIVE c AS (SELECT DISTINCT id, category, lat, lng FROM verify_positions WHERE sources[1] = 'atp' AND lat IS NOT NULL AND lng IS NOT NULL),
o AS (SELECT DISTINCT id, category, lat, lng FROM verify_positions WHERE sources[1] = 'osm' AND lat IS NOT NULL AND lng IS NOT NULL),
fresh AS (SELECT * FROM c l WHERE NOT EXISTS (SELECT 1 FROM o r WHERE abs(l.lat - r.lat) < 0.01 AND abs(l.lng - r.lng) < 0.02 AND l.category = r.category AND {_D} <= 250)),
e AS (SELECT l.id, list(r.id) AS earlier FROM fresh l JOIN fresh r ON r.id < l.id AND abs(l.lat - r.lat) < 0.01 AND abs(l.lng - r.lng) < 0.02 AND l.category = r.category AND {_D} <= 250 GROUP BY l.id),
n AS (SELECT fresh.id, category, coalesce(earlier, []) AS earlier, row_number() OVER (ORDER BY fresh.id) AS n FROM fresh LEFT JOIN e USING (id)),
g AS (SELECT 0::BIGINT AS n, []::VARCHAR[] AS made, NULL::VARCHAR AS id UNION ALL SELECT g.n + 1, CASE WHEN len(list_intersect(made, n.earlier)) > 0 THEN made ELSE list_append(made, n.id) END, CASE WHEN len(list_intersect(made, n.earlier)) > 0 THEN NULL ELSE n.id END FROM g JOIN n ON n.n = g.n + 1)
SELECT id, category FROM g JOIN n USING (id)""")
def created_places(spark: SparkSession, d: str) -> DataFrame:
    """Chain records that no map record and no earlier created one of their category matches within 250 m."""
    v = table(spark, d, "verify_positions").where("lat is not null and lng is not null")
    pick = lambda s: v.where(F.get("sources", F.lit(0)) == s).select("id", "name", "category", "lat", "lng").distinct()
    return create_unmatched(pick("atp"), pick("osm"), 250, F.col("l_category") == F.col("r_category")).select("id", "category")


@query("""
WITH g AS (SELECT DISTINCT id, lower(replace(postcode, ' ', '')) AS pc, nullif(lower(regexp_extract(address, '^\\s*(\\d+[A-Za-z]?)', 1)), '') AS hn, sources[1] AS s, category FROM verify_positions WHERE postcode IS NOT NULL AND trim(postcode) <> ''),
h AS (SELECT pc, hn, min(id) AS host FROM g WHERE s = 'osm' AND hn IS NOT NULL GROUP BY pc, hn HAVING count(*) = 1)
SELECT g.id, h.host AS hosted_in FROM g LEFT JOIN h ON g.pc = h.pc AND g.hn = h.hn WHERE g.s = 'fsa'""")
def exactly_one_host(spark: SparkSession, d: str) -> DataFrame:
    """The one map record at a register record's postcode and number; two are none."""
    hn = F.nullif(F.lower(F.regexp_extract("address", r"^\s*(\d+[A-Za-z]?)", 1)), F.lit(""))
    v = table(spark, d, "verify_positions").where("postcode is not null and trim(postcode) <> ''")
    g = v.select("id", F.lower(F.replace("postcode", F.lit(" "), F.lit(""))).alias("pc"), hn.alias("hn"), F.get("sources", F.lit(0)).alias("s"), "category").distinct()
    return attach_host(g.where("s = 'fsa'"), g.where("s = 'osm'"), ["pc", "hn"], "id").select("id", "hosted_in")


@query("""
WITH s AS (SELECT area_id, bbox[2] AS lat1, bbox[1] AS lng1, bbox[2] AS lat2, bbox[3] AS lng2 FROM areas),
p AS (SELECT DISTINCT id, lat, lng FROM verify_positions WHERE lat IS NOT NULL AND lng IS NOT NULL),
t AS (SELECT p.id, p.lat, p.lng, s.*, greatest(0.0, least(1.0, ((lng - lng1) * 62500.0 * ((lng2 - lng1) * 62500.0) + (lat - lat1) * 111320.0 * ((lat2 - lat1) * 111320.0)) / (((lng2 - lng1) * 62500.0) * ((lng2 - lng1) * 62500.0) + ((lat2 - lat1) * 111320.0) * ((lat2 - lat1) * 111320.0)))) AS u FROM p JOIN s ON abs(lat - lat1) < 0.05),
e AS (SELECT id, (lng - lng1) * 62500.0 - u * ((lng2 - lng1) * 62500.0) AS ex, (lat - lat1) * 111320.0 - u * ((lat2 - lat1) * 111320.0) AS ey FROM t)
SELECT id, round(min(sqrt(ex * ex + ey * ey)), 3) AS dist_m FROM e WHERE sqrt(ex * ex + ey * ey) <= 2000 GROUP BY id""")
def nearest_line(spark: SparkSession, d: str) -> DataFrame:
    """Distance from each record to the nearest southern border of an area, within 2 km."""
    w, s, e = (F.col("bbox")[i] for i in range(3))
    lines = path_segments(table(spark, d, "areas").select("area_id", F.array(F.array(w, s), F.array(e, s)).alias("path")), "area_id", "path")
    p = table(spark, d, "verify_positions").where("lat is not null and lng is not null").select("id", "lat", "lng").distinct()
    return nearest_segment(p, lines, "id", metres=2000, size=0.05).select("id", F.round("dist_m", 3).alias("dist_m"))


@query("""
SELECT DISTINCT id, CAST(floor((lng + 180) / 360 * 16384) AS INTEGER) AS x, CAST(floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / 3.141592653589793) / 2 * 16384) AS INTEGER) AS y
FROM verify_positions WHERE abs(lat) < 85 AND lng IS NOT NULL""")
def tile_z14(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "verify_positions").where("abs(lat) < 85 and lng is not null").select("id", tile(F.col("lat"), F.col("lng")).alias("t"))
    return v.select("id", "t.x", "t.y").distinct()


@query("""
SELECT a.area_id AS a, b.area_id AS b, round(greatest(0, least(a.bbox[3] + (a.bbox[3] - a.bbox[1]) * 0.03 + 0.002, b.bbox[3]) - greatest(a.bbox[1] - (a.bbox[3] - a.bbox[1]) * 0.03 - 0.002, b.bbox[1])) * greatest(0, least(a.bbox[4] + (a.bbox[4] - a.bbox[2]) * 0.03 + 0.002, b.bbox[4]) - greatest(a.bbox[2] - (a.bbox[4] - a.bbox[2]) * 0.03 - 0.002, b.bbox[2])), 9) > 0 AS meets
FROM areas a JOIN areas b ON a.area_id < b.area_id AND a.bbox_source IS NOT DISTINCT FROM b.bbox_source AND a.fsa + 1 = b.fsa""")
def padded_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Whether an area's box, padded, meets the next one's."""
    t = table(spark, d, "areas")
    a, b = (t.select(F.col("area_id").alias(n), F.col("bbox").alias(f"{n}_box"), F.col("bbox_source").alias(f"{n}_s"), F.col("fsa").alias(f"{n}_f")) for n in "ab")
    both = a.join(b, F.col("a_f") + 1 == F.col("b_f")).where("a < b and a_s <=> b_s")
    return both.select("a", "b", (F.round(box_overlap(padded(F.col("a_box")), F.col("b_box")), 12) > 0).alias("meets"))


@query("""
SELECT DISTINCT id FROM verify_positions WHERE lat BETWEEN 50 AND 60 AND lng BETWEEN -1 AND 4 AND category = 'pub'""")
def in_box_category(spark: SparkSession, d: str) -> DataFrame:
    box = tuple(map(float, "50,-1,60,4".split(",")))
    return table(spark, d, "verify_positions").where(in_box(F.col("lat"), F.col("lng"), box) & (F.col("category") == "pub")).select("id").distinct()


@query("""
SELECT area_id, list_transform(list_transform(string_split(b, ','), lambda x: trim(x)), lambda x: TRY_CAST(x AS DOUBLE)) AS box FROM (SELECT area_id, array_to_string(bbox, ', ') AS b FROM areas)""")
def parsed_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Boxes read back from text."""
    return table(spark, d, "areas").select("area_id", parse_box(F.array_join(F.transform("bbox", lambda v: v.cast("string")), ", ")).alias("box"))


@query("""
WITH a AS (SELECT id, lat, lon, release FROM overture WHERE lat IS NOT NULL AND lon IS NOT NULL),
o AS (SELECT id, max(lat) AS lat, max(lon) AS lon FROM a WHERE release = (SELECT min(release) FROM overture) GROUP BY id),
n AS (SELECT id, max(lat) AS lat, max(lon) AS lon FROM a WHERE release = (SELECT max(release) FROM overture) GROUP BY id),
j AS (SELECT coalesce(o.id, n.id) AS id, o.id AS oid, n.id AS nid, 2 * 6371000 * asin(least(1, sqrt(pow(sin(radians(n.lat - o.lat) / 2), 2) + cos(radians(o.lat)) * cos(radians(n.lat)) * pow(sin(radians(n.lon - o.lon) / 2), 2)))) AS m FROM o FULL JOIN n ON o.id = n.id)
SELECT id, CASE WHEN oid IS NULL THEN 'added' WHEN nid IS NULL THEN 'removed' ELSE 'moved' END AS change, CASE WHEN oid IS NOT NULL AND nid IS NOT NULL THEN round(m) END AS metres FROM j WHERE oid IS NULL OR nid IS NULL OR m > 25""")
def release_difference(spark: SparkSession, d: str) -> DataFrame:
    """What the newest release of places added, removed and moved against the oldest."""
    from placeloom.operators.ranking import difference

    o = table(spark, d, "overture")
    first, last = o.agg(F.min("release"), F.max("release")).first()
    a = o.where("lat is not null and lon is not null")
    pick = lambda r: a.where(F.col("release") == r).groupBy("id").agg(F.max("lat").alias("lat"), F.max("lon").alias("lng"))
    return difference(pick(first), pick(last), "id", haversine_m(F.col("o_lat"), F.col("o_lng"), F.col("n_lat"), F.col("n_lng")), ["lat", "lng"])
