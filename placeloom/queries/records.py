"""Registries, quarantine, gates, tables of what was done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeloom.functions.pages import name_on_page
from placeloom.functions.text import normal_name, words
from placeloom.operators.ranking import table_hash
from placeloom.operators.spatial import fill_empty, only_one
from placeloom.plans.stages import Build, Step, gate, violations
from placeloom.queries import query, table
from placeloom.sources.sinks import clean_review, manifest


@query("""
WITH q AS (SELECT DISTINCT unnest(absorb) AS id FROM aliases)
SELECT area_id, count(DISTINCT id) AS kept FROM verify_positions v WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.id = v.id) GROUP BY area_id""")
def quarantine_anti(spark: SparkSession, d: str) -> DataFrame:
    """Records left when listed ids are taken out, by area."""
    q = table(spark, d, "aliases").select(F.explode("absorb").alias("id")).distinct()
    return table(spark, d, "verify_positions").join(q, "id", "left_anti").groupBy("area_id").agg(F.count_distinct("id").alias("kept"))


@query("""
WITH f AS (SELECT DISTINCT fsa_id AS number, id FROM verify_positions WHERE fsa_id IS NOT NULL),
o AS (SELECT TRY_CAST(trim(osm_fhrs_id) AS BIGINT) AS number, max(nullif(trim(phone), '')) AS phone, max(nullif(trim(website), '')) AS website FROM verify_positions WHERE osm_fhrs_id IS NOT NULL GROUP BY 1),
p AS (SELECT id, min(phone) AS phone, min(website) AS website FROM verify_positions WHERE fsa_id IS NOT NULL GROUP BY id)
SELECT p.id, CASE WHEN coalesce(trim(p.phone), '') = '' AND o.phone IS NOT NULL THEN o.phone ELSE p.phone END AS phone, CASE WHEN coalesce(trim(p.website), '') = '' AND o.website IS NOT NULL THEN o.website ELSE p.website END AS website FROM p JOIN f ON f.id = p.id LEFT JOIN o ON o.number = f.number""")
def fill_empty_only(spark: SparkSession, d: str) -> DataFrame:
    """Register records whose empty contacts are filled from records that carry their number."""
    v = table(spark, d, "verify_positions")
    some = lambda c: F.max(F.nullif(F.trim(c), F.lit(""))).alias(c)
    o = v.where("osm_fhrs_id is not null").groupBy(F.trim("osm_fhrs_id").try_cast("bigint").alias("number")).agg(some("phone"), some("website"))
    p = v.where("fsa_id is not null").groupBy("id", F.col("fsa_id").alias("number")).agg(F.min("phone").alias("phone"), F.min("website").alias("website"))
    return fill_empty(p, o, "number", ["phone", "website"]).select("id", "phone", "website")


@query("""
WITH n AS (SELECT id, name FROM (SELECT DISTINCT id, lower(trim(name)) AS name FROM verify_positions WHERE name IS NOT NULL)) SELECT id, name FROM n WHERE name IN (SELECT name FROM n GROUP BY name HAVING count(*) = 1)""")
def unique_names(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "verify_positions").where("name is not null").select("id", F.lower(F.trim("name")).alias("name")).distinct()
    return only_one(n, ["name"])


@query("""
SELECT area_id, count(*) AS rows, count(*) FILTER (NOT coalesce(lat IS NULL = (lng IS NULL), false)) AS half_placed, count(*) FILTER (NOT coalesce(abs(lat) <= 90 OR lat IS NULL, false)) AS off_earth, count(*) FILTER (coalesce(trim(name), '') = '') AS nameless,
count(*) FILTER (NOT coalesce(lat IS NULL = (lng IS NULL), false)) + count(*) FILTER (NOT coalesce(abs(lat) <= 90 OR lat IS NULL, false)) + count(*) FILTER (coalesce(trim(name), '') = '') AS violations FROM verify_positions GROUP BY area_id""")
def audit(spark: SparkSession, d: str) -> DataFrame:
    """Broken invariants by area."""
    placed = F.col("lat").isNull() == F.col("lng").isNull()
    rules = {"half_placed": placed, "off_earth": (F.abs("lat") <= 90) | F.col("lat").isNull(), "nameless": F.coalesce(F.trim("name"), F.lit("")) != ""}
    return violations(table(spark, d, "verify_positions"), "area_id", rules)


@query("SELECT area_id, count(DISTINCT id) AS n FROM verify_positions WHERE lat IS NOT NULL AND lng IS NOT NULL GROUP BY area_id")
def gated_build(spark: SparkSession, d: str) -> DataFrame:
    """A small build: stages in their order, a country's own stage skipped, the gate at the end."""
    placed = lambda df, _: df.where("lat is not null and lng is not null")
    build = Build([Step("count", lambda df, _: df.groupBy("area_id").agg(F.count_distinct("id").alias("n")), ("placed", "distinct")), Step("placed", placed), Step("distinct", lambda df, _: df.dropDuplicates(["id"]), ("placed",)), Step("fi only", lambda df, _: df.limit(0), ("placed",), ("fi",))])
    return gate(build.run(table(spark, d, "verify_positions"), "gb"), {"counted": F.col("n") > 0})


@query("""
SELECT replace(area_id, 'eu/', '') AS id, replace(replace(area_id, 'eu/', ''), '/', '_') AS asset, split_part(area_id, '/', 2) AS country, count(*) AS pois, list_contains(list(DISTINCT sources[1]), 'fsa') AND list_contains(list(DISTINCT sources[1]), 'osm') AND (split_part(area_id, '/', 2) <> 'gb' OR list_contains(list(DISTINCT sources[1]), 'nhs')) AS complete
FROM verify_positions WHERE area_id IS NOT NULL GROUP BY area_id""")
def pack_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Areas as packs: complete if all stages that their country allows have left records."""
    country = F.split_part("area_id", F.lit("/"), F.lit(2))
    p = table(spark, d, "verify_positions").where("area_id is not null").groupBy(F.replace("area_id", F.lit("eu/"), F.lit("")).alias("id"), country.alias("country")).agg(F.count("*").alias("pois"), F.collect_set(F.get("sources", F.lit(0))).alias("stages"))
    allowed = F.when(F.col("country") == "gb", F.array(*map(F.lit, ("fsa", "osm", "nhs")))).otherwise(F.array(F.lit("fsa"), F.lit("osm")))
    return manifest(p.withColumn("allowed", allowed), ["fsa", "osm", "nhs"])


@query()
def content_hash(spark: SparkSession, d: str) -> DataFrame:
    """One hash of a table that doesn't depend on its layout."""
    return table_hash(table(spark, d, "overture"), [])


@query("""
SELECT DISTINCT id, CASE WHEN coalesce(trim(website), '') = '' OR len(w) = 0 THEN NULL ELSE len(list_filter(w, lambda x: contains(lower(website), x))) > 0 END AS named FROM (
  SELECT id, website, list_distinct(list_filter(string_split(trim(regexp_replace(regexp_replace(replace(regexp_replace(lower(coalesce(name, '')), '\\b(ltd|limited|plc|the|oy|ab)\\b', '', 'g'), '&', 'and'), '[^a-z0-9åäö ]', ' ', 'g'), '\\s+', ' ', 'g')), ' '), lambda x: length(x) >= 4)) AS w FROM crawl_sites)""")
def three_valued_name(spark: SparkSession, d: str) -> DataFrame:
    """Whether a site's address tells its name: true, false, or null where it can't be told."""
    c = table(spark, d, "crawl_sites").select("id", name_on_page(words(normal_name("name"), 4), F.col("website"), F.lit(None).cast("string")).alias("named"))
    return c.distinct()


@query("""
SELECT event_id::VARCHAR AS poi_id, coalesce(nullif(substr(trim(event_type), 1, 3), ''), 'Anonymous') AS author, TRY_CAST(round(value / 20) AS INTEGER) AS rating, substr(trim(props), 1, 2000) AS text FROM events WHERE TRY_CAST(round(value / 20) AS INTEGER) BETWEEN 1 AND 5 AND coalesce(trim(props), '') <> ''""")
def accepted_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Notes fit to be appended."""
    e = table(spark, d, "events").select(F.col("event_id").cast("string").alias("poi_id"), F.substring(F.trim("event_type"), 1, 3).alias("author"), F.round(F.col("value") / 20).cast("int").alias("rating"), F.col("props").alias("text"), F.col("ts").alias("date"))
    return clean_review(e).drop("date")


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_properties(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))
