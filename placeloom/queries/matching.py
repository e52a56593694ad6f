"""Duplicates, occupants, verified positions and aliases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeloom.functions.text import BRAND_STOP
from placeloom.operators import cascade, premises
from placeloom.operators.components import components
from placeloom.operators.ranking import keep_first
from placeloom.operators.spatial import best_each, only_one, within
from placeloom.queries import query, table
from placeloom.queries import sqltext as Q
from placeloom.queries.near import sides


def _records(spark: SparkSession, d: str) -> DataFrame:
    return keep_first(table(spark, d, "verify_positions"), "id", F.asc("loaded_at")).withColumn("source", F.get("sources", F.lit(0)))


@query(f"""
WITH RECURSIVE {Q.RECORDS},
k AS (SELECT id, name, fsa_rating_date AS rated, pc, hn FROM rec WHERE source = 'fsa'),
l AS (SELECT a.id AS a, b.id AS b FROM k a JOIN k b ON a.pc = b.pc AND a.hn = b.hn AND a.id < b.id WHERE len(list_intersect({Q.words(Q.normal("a.name"), 3)}, {Q.words(Q.normal("b.name"), 3)})) > 0 AND {Q.brand("a.name", "b.name", BRAND_STOP)}),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT id AS a, id AS b FROM k UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
g AS (SELECT a AS id, min(b) AS g FROM reach GROUP BY a)
SELECT id, first_value(id) OVER (PARTITION BY g ORDER BY rated DESC NULLS LAST, id) AS winner FROM k JOIN g USING (id)""")
def register_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Register rows of one business at one premises, and the one that stays."""
    return premises.register_duplicates(_records(spark, d).where("source = 'fsa'"), "id", "name", "fsa_rating_date")


@query(f"""
WITH {Q.RECORDS},
k AS (SELECT *, {Q.normal("name")} AS nm FROM rec WHERE source = 'osm' AND lat IS NOT NULL),
c AS (SELECT nm, min(id) AS a, max(id) AS b FROM k WHERE length(nm) >= 6 GROUP BY nm HAVING count(*) = 2 AND min(id) <> max(id))
SELECT c.a AS kept, c.b AS absorbed FROM c JOIN k l ON l.id = c.a JOIN k r ON r.id = c.b
WHERE {Q.METRES} < 250 AND (l.pc IS NULL OR r.pc IS NULL OR l.pc = r.pc) AND (l.hn IS NULL OR r.hn IS NULL OR l.hn = r.hn) AND l.category IS NOT DISTINCT FROM r.category""")
def map_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Map records that stand twice."""
    return premises.map_duplicates(_records(spark, d).where("source = 'osm' and lat is not null"), "id", "name", "category", "lat", "lng")


@query(f"""
WITH {Q.RECORDS},
c AS (SELECT * FROM rec WHERE source IN ('fsa', 'servicemap') AND pc IS NOT NULL AND hn IS NOT NULL QUALIFY count(*) OVER (PARTITION BY pc, hn) = 1)
SELECT o.id, c.id AS superseded_by FROM rec o JOIN c ON o.pc = c.pc AND o.hn = c.hn
WHERE o.source = 'osm' AND o.id <> c.id AND NOT {Q.brand("o.name", "c.name", BRAND_STOP)} AND (o.category = c.category OR (o.category IN ('restaurant', 'cafe', 'pub') AND c.category IN ('restaurant', 'cafe', 'pub')))""")
def former_occupants(spark: SparkSession, d: str) -> DataFrame:
    """Map records at the premises of exactly one registered business of another brand and the same kind."""
    r = _records(spark, d).select("id", "name", "category", "address", "postcode", "source")
    food = ("restaurant", "cafe", "pub")
    family = (F.col("o_category") == F.col("c_category")) | (F.col("o_category").isin(*food) & F.col("c_category").isin(*food))
    return premises.former_occupants(r.where("source = 'osm'"), r.where("source in ('fsa', 'servicemap')"), "id", "name", family)


@query(f"""
WITH {Q.RECORDS},
k AS (SELECT *, {Q.normal("name")} AS nm, {Q.words(Q.normal("address"), 5)} AS ws, coalesce(fsa_id::VARCHAR, nullif(regexp_extract(osm_fhrs_id, '^\\s*0*([0-9]+)\\s*$', 1), '')) AS num FROM rec),
f AS (SELECT * FROM k WHERE source = 'fsa'), o AS (SELECT * FROM k WHERE source = 'osm'),
att AS (SELECT l.id AS fsa, r.id AS osm, {Q.METRES} AS d FROM f l JOIN o r ON l.num = r.num AND l.nm = r.nm WHERE length(l.nm) >= 6),
att1 AS (SELECT * FROM att QUALIFY count(*) OVER (PARTITION BY osm) = 1), att2 AS (SELECT * FROM att1 QUALIFY count(*) OVER (PARTITION BY fsa) = 1),
f1 AS (SELECT * FROM f WHERE length(nm) >= 6 QUALIFY count(*) OVER (PARTITION BY nm) = 1), o1 AS (SELECT * FROM o WHERE length(nm) >= 6 QUALIFY count(*) OVER (PARTITION BY nm) = 1),
pre AS (SELECT l.id AS fsa, r.id AS osm, {Q.METRES} AS d FROM f1 l JOIN o1 r ON l.nm = r.nm WHERE l.pc = r.pc OR (l.hn = r.hn AND len(list_intersect(l.ws, r.ws)) > 0)),
t AS (SELECT DISTINCT id, merge_osm FROM aliases WHERE trim(coalesce(merge_osm, '')) <> '' AND len(evidence) > 0),
ali AS (SELECT l.id AS fsa, r.id AS osm, {Q.METRES} AS d FROM t JOIN f l ON l.id = t.id JOIN o r ON r.id = t.merge_osm),
u AS (SELECT *, 'attested' AS via, 0 AS k FROM att2 UNION ALL SELECT *, 'premises', 1 FROM pre UNION ALL SELECT *, 'alias', 2 FROM ali),
x AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY fsa ORDER BY k, fsa, osm) = 1)
SELECT fsa, osm, via, round(d) AS moved_m FROM x QUALIFY row_number() OVER (PARTITION BY osm ORDER BY k, fsa, osm) = 1""")
def verified_positions(spark: SparkSession, d: str) -> DataFrame:
    """Register records that take a map record's position, by which rule, and how far they move."""
    r = _records(spark, d)
    number = F.coalesce(F.col("fsa_id").cast("string"), F.nullif(F.regexp_extract("osm_fhrs_id", r"^\s*0*(\d+)\s*$", 1), F.lit("")))
    r = r.withColumn("number", number).select("id", "name", "address", "postcode", "lat", "lng", "number", "source")
    return premises.verified_positions(r.where("source = 'fsa'"), r.where("source = 'osm'"), table(spark, d, "aliases"))


_ALIASES = f"""
WITH {Q.RECORDS},
j AS (SELECT a.alias_id, a.id, a.alias_name, a.registered_name, a.loaded_at, a.absorb, rec.pc, CASE WHEN rec.id IS NULL THEN 'no record' WHEN {Q.normal("rec.name")} <> {Q.normal("a.registered_name")} THEN 'name has changed' WHEN trim(coalesce(a.alias_name, '')) = '' THEN 'no alias' END AS reason FROM aliases a LEFT JOIN rec ON rec.id = a.id)"""


@query(_ALIASES + """,
n AS (SELECT id, arg_max(alias_name, (loaded_at, alias_id)) AS alias, arg_max(registered_name, (loaded_at, alias_id)) AS registered FROM j WHERE reason IS NULL GROUP BY id),
g AS (SELECT DISTINCT x.gone FROM (SELECT pc, unnest(absorb) AS gone FROM j WHERE reason IS NULL) x JOIN rec ON rec.id = x.gone WHERE rec.pc = x.pc)
SELECT rec.id, coalesce(n.alias, rec.name) AS name, n.registered AS registered_name FROM rec LEFT JOIN n ON n.id = rec.id WHERE rec.id NOT IN (SELECT gone FROM g)""")
def applied_aliases(spark: SparkSession, d: str) -> DataFrame:
    """Records under their verified names, absorbed ones left out."""
    out, _ = premises.apply_aliases(_records(spark, d).select("id", "name", "postcode"), table(spark, d, "aliases"))
    return out.select("id", "name", "registered_name")


@query(_ALIASES + " SELECT alias_id, id, reason FROM j WHERE reason IS NOT NULL")
def refused_aliases(spark: SparkSession, d: str) -> DataFrame:
    """Aliases that no longer fit their record, and why."""
    return premises.apply_aliases(_records(spark, d).select("id", "name", "postcode"), table(spark, d, "aliases"))[1]


@query("""
WITH RECURSIVE n AS (SELECT DISTINCT id AS s, coalesce(fsa_id, TRY_CAST(trim(osm_fhrs_id) AS BIGINT)) AS g FROM verify_positions WHERE coalesce(fsa_id, TRY_CAST(trim(osm_fhrs_id) AS BIGINT)) IS NOT NULL)
SELECT s AS node, min(s) OVER (PARTITION BY g) AS component FROM n""")
def connected_records(spark: SparkSession, d: str) -> DataFrame:
    """Components of the graph that links each record to the first of its register number."""
    g = F.coalesce("fsa_id", F.trim("osm_fhrs_id").try_cast("bigint"))
    n = table(spark, d, "verify_positions").select(F.col("id").alias("a"), g.alias("g")).where("g is not null").distinct()
    hub = n.groupBy("g").agg(F.max("a").alias("b"))
    return components(n.join(hub, "g").select("a", "b"))


@query("""
WITH n AS (SELECT DISTINCT id, trim(lower(name)) AS k FROM verify_positions WHERE name IS NOT NULL AND length(trim(name)) >= 6 AND sources[1] = 'osm')
SELECT min(id) AS a, max(id) AS b FROM n GROUP BY k HAVING count(*) = 2""")
def groups_of_two(spark: SparkSession, d: str) -> DataFrame:
    """Names that exactly two map records have."""
    n = table(spark, d, "verify_positions").where("name is not null and length(trim(name)) >= 6").where(F.get("sources", F.lit(0)) == "osm").select("id", F.trim(F.lower("name")).alias("k")).distinct()
    return n.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).where("n = 2").select("a", "b")


@query("""
WITH f AS (SELECT DISTINCT id, trim(lower(name)) AS k FROM verify_positions WHERE sources[1] = 'fsa' AND name IS NOT NULL), o AS (SELECT DISTINCT id, trim(lower(name)) AS k FROM verify_positions WHERE sources[1] = 'osm' AND name IS NOT NULL)
SELECT f.id AS fsa, o.id AS osm FROM f JOIN o USING (k) WHERE k IN (SELECT k FROM f GROUP BY k HAVING count(*) = 1) AND k IN (SELECT k FROM o GROUP BY k HAVING count(*) = 1)""")
def unique_both_sides(spark: SparkSession, d: str) -> DataFrame:
    """Records whose name is unique among the register's and among the map's."""
    v = table(spark, d, "verify_positions").where("name is not null").withColumn("s", F.get("sources", F.lit(0)))
    side = lambda s, n: only_one(v.where(F.col("s") == s).select(F.col("id").alias(n), F.trim(F.lower("name")).alias("k")).distinct(), ["k"])
    return side("fsa", "fsa").join(side("osm", "osm"), "k").select("fsa", "osm")


@query(f"""
WITH l AS (SELECT DISTINCT id, name, lat, lng FROM verify_positions WHERE sources[1] = 'fsa' AND lat IS NOT NULL AND lng IS NOT NULL), r AS (SELECT DISTINCT id, name, lat, lng FROM verify_positions WHERE sources[1] = 'osm' AND lat IS NOT NULL AND lng IS NOT NULL),
p AS (SELECT l.id AS fsa, r.id AS osm, {Q.METRES} AS d, {Q.score("l.name", "r.name")} AS ns, {Q.normal("l.name")} = {Q.normal("r.name")} AND length({Q.normal("l.name")}) >= 6 AS exact FROM l JOIN r ON abs(l.lat - r.lat) < 0.01 AND abs(l.lng - r.lng) < 0.02 WHERE {Q.METRES} <= 500),
s AS (SELECT *, CASE WHEN exact THEN 2.0 - d / 1e5 ELSE ns + CASE WHEN d < 50 THEN 0.1 ELSE 0 END END AS score FROM p WHERE exact OR ns >= 0.5 OR (ns >= 0.34 AND d < 60))
SELECT fsa, osm, CASE WHEN exact THEN 'exact' ELSE 'name' END AS method, round(score, 3) AS score FROM s QUALIFY row_number() OVER (PARTITION BY fsa ORDER BY score DESC, osm) = 1""")
def scored_enrichment(spark: SparkSession, d: str) -> DataFrame:
    """For each register record the best map record nearby by name, distance and category, with how it was chosen."""
    a, b = (cascade.read(df) for df in sides(spark, d))
    pairs = within(a, b, 500).withColumn("ns", cascade.read_score())
    exact = (F.col("l_plain") == F.col("r_plain")) & (F.length("l_plain") >= 6)
    method = F.when(exact, "exact").when((F.col("ns") >= 0.5) | ((F.col("ns") >= 0.34) & (F.col("dist_m") < 60)), "name")
    score = F.when(exact, 2.0 - F.col("dist_m") / 1e5).otherwise(F.col("ns") + F.when(F.col("dist_m") < 50, 0.1).otherwise(0.0))
    best = best_each(pairs.withColumn("method", method).withColumn("score", score).where("method is not null"), "l_id", F.desc("score"), F.asc("r_id"))
    return best.select(F.col("l_id").alias("fsa"), F.col("r_id").alias("osm"), "method", F.round("score", 3).alias("score"))


@query()
def built_places(spark: SparkSession, d: str) -> DataFrame:
    """The whole build: records renamed, moved, filled, flagged, weighed, gated."""
    from placeloom.plans.places import build_places

    return build_places(table(spark, d, "verify_positions"), table(spark, d, "aliases"), "2031-03-01 00:00:00")


@query("""
WITH v AS (SELECT id, max(name) AS name, max(sources[1]) AS source, max(osm_fhrs_id) AS carried FROM verify_positions GROUP BY id)
SELECT id, name, CASE WHEN source = 'osm' AND carried IS NOT NULL THEN 2 WHEN source = 'fsa' THEN 1 ELSE 0 END AS evidence FROM v""")
def listed_by_name(spark: SparkSession, d: str) -> DataFrame:
    """Places in the order of a name list: with register and map evidence first, then by name as a reader sorts it."""
    v = table(spark, d, "verify_positions").groupBy("id").agg(F.max("name").alias("name"), F.max(F.get("sources", F.lit(0))).alias("source"), F.max("osm_fhrs_id").alias("carried"))
    order = F.when((F.col("source") == "osm") & F.col("carried").isNotNull(), 2).when(F.col("source") == "fsa", 1).otherwise(0)
    return v.select("id", "name", order.alias("evidence")).orderBy(F.desc("evidence"), F.collate("name", "UNICODE"), "id")
