"""Sources written as files of their own form and read back, raw copies, manifests and what is left to crawl."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeloom.operators.ranking import keep_first
from placeloom.plans.cut import checkpoint_dir
from placeloom.queries import query, table
from placeloom.queries import sqltext as Q
from placeloom.sources import readers, sinks


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


_LAST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC, release DESC) AS nth FROM overture) WHERE nth = 1"


@query(f"""
WITH o AS ({_LAST})
SELECT id, name, lon, lat, postcode, website, phone, list_sort(list_distinct(datasets)) AS datasets FROM o
WHERE lon BETWEEN -8 AND 2 AND lat BETWEEN 49 AND 61 AND (website IS NOT NULL OR phone IS NOT NULL) AND NOT coalesce(list_distinct(datasets) = ['Microsoft'], false)""")
def read_release(spark: SparkSession, d: str) -> DataFrame:
    """Places of a release, written in its nested form, that lie in a box and can be reached."""
    o = keep_first(table(spark, d, "overture"), "id", F.desc("loaded_at"), F.desc("release"))
    none = F.array().cast("array<string>")
    one = lambda c: F.when(F.col(c).isNotNull(), F.array(c)).otherwise(none)
    source = F.transform("datasets", lambda x: F.struct(x.alias("dataset"), F.lit("").alias("property"), F.lit(None).cast("double").alias("confidence")))
    nested = o.select(
        "id", F.struct(F.col("name").alias("primary")).alias("names"), F.struct(F.col("lon").alias("xmin"), F.col("lon").alias("xmax"), F.col("lat").alias("ymin"), F.col("lat").alias("ymax")).alias("bbox"),
        F.array(F.struct(F.lit(None).cast("string").alias("freeform"), "postcode")).alias("addresses"), one("website").alias("websites"), one("phone").alias("phones"), "socials", source.alias("sources"), "confidence", "basic_category", F.lit(None).cast("string").alias("operating_status"),
    )
    at = _folder(spark, "release")
    nested.write.parquet(at)
    return readers.places(spark, at, (-8.0, 49.0, 2.0, 61.0)).select("id", "name", "lon", "lat", "postcode", "website", "phone", F.array_sort("datasets").alias("datasets"))


@query(f"""
SELECT DISTINCT nullif(trim(registered_name), '') AS name, alias_id::VARCHAR AS number, {Q.code("evidence[1]")} AS town FROM aliases WHERE alias_id % 3 <> 0""")
def read_companies(spark: SparkSession, d: str) -> DataFrame:
    """Active companies of a register file with headers of its own, one of them with a comma."""
    a = table(spark, d, "aliases").select("registered_name", "alias_id", "evidence").distinct()
    rows = a.select(
        F.col("registered_name").alias("Name, full"), F.col("alias_id").cast("string").alias("Number"), F.when(F.col("alias_id") % 3 == 0, "Dissolved").otherwise("Active").alias("State"),
        F.nullif(F.lower(F.regexp_replace(F.coalesce(F.get("evidence", F.lit(0)), F.lit("")), r"\s", "")), F.lit("")).alias("Town"), F.lit("56101 - kitchens").alias("Code 1"),
    )
    at = _folder(spark, "companies")
    rows.write.option("header", True).option("quote", '"').option("escape", '"').option("nullValue", "").option("emptyValue", "").csv(at)
    out = readers.companies(spark, at, ["56"], {"name": ["Name, full"], "number": ["Number"], "status": ["State"], "town": ["Town"], "codes": ["Code 1"]})
    return out.select("name", "number", "town").distinct()


@query("""
SELECT area_id AS id, round((bbox[1] + bbox[3]) / 2, 6) AS lng, round((bbox[2] + bbox[4]) / 2, 6) AS lat FROM areas
UNION ALL SELECT DISTINCT id, round(lng, 6), round(lat, 6) FROM verify_positions WHERE lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180""")
def read_features(spark: SparkSession, d: str) -> DataFrame:
    """Points, and areas by the centre of their box, out of lines of GeoJSON."""
    w, s, e, n = (F.col("bbox")[i] for i in range(4))
    ring = F.array(F.array(*(F.array(*p) for p in ((w, s), (e, s), (e, n), (w, n), (w, s)))))
    shape = lambda kind, c: F.struct(F.lit(kind).alias("type"), c.alias("coordinates")).alias("geometry")
    line = lambda kind, c, id: F.to_json(F.struct(shape(kind, c), F.create_map(F.lit("id"), F.col(id)).alias("properties"))).alias("value")
    areas = table(spark, d, "areas").select(line("Polygon", ring, "area_id"))
    points = table(spark, d, "verify_positions").where("lat between -90 and 90 and lng between -180 and 180").select("id", "lat", "lng").distinct().select(line("Point", F.array("lng", "lat"), "id"))
    at = _folder(spark, "features")
    areas.unionByName(points).write.text(at)
    return readers.features(spark, at, (-180.0, -90.0, 180.0, 90.0), ["id"], lines=True).select("id", F.round("lng", 6).alias("lng"), F.round("lat", 6).alias("lat"))


@query("SELECT DISTINCT osm_type AS type, osm_id AS id, osm_version AS version, nullif(trim(osm_touched), '') AS touched FROM verify_positions WHERE osm_type IN ('node', 'way') AND osm_id IS NOT NULL AND osm_touched IS NOT NULL AND NOT regexp_matches(osm_touched, '\\s')")
def read_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Versions and times of map objects out of an object file."""
    v = table(spark, d, "verify_positions").where("osm_type in ('node', 'way') and osm_id is not null and osm_touched is not null").where(~F.col("osm_touched").rlike(r"\s")).select("osm_type", "osm_id", "osm_version", "osm_touched").distinct()
    line = F.concat(F.substring("osm_type", 1, 1), F.col("osm_id").cast("string"), F.coalesce(F.concat(F.lit(" v"), F.col("osm_version").cast("string")), F.lit("")), F.lit(" dV c1 t"), F.col("osm_touched"))
    at = _folder(spark, "objects")
    v.select(line.alias("value")).write.text(at)
    return readers.object_metadata(spark, at)


@query("""
SELECT 'areas' AS name, (SELECT count(*) FROM areas) AS rows, NULL AS reason UNION ALL SELECT 'overture', (SELECT count(*) FROM overture), NULL UNION ALL SELECT 'source_trust', (SELECT count(*) FROM source_trust), NULL UNION ALL SELECT 'notes', NULL, 'not delivered'""")
def handoff_files(spark: SparkSession, d: str) -> DataFrame:
    """Raw copies of tables with their rows and hash, and what is missing with its reason (hashes are told apart in tests)."""
    at = _folder(spark, "raw")
    given = {n: table(spark, d, n) for n in ("areas", "overture", "source_trust")}
    return sinks.raw_copies(spark, at, given, {"notes": "not delivered"}).select("name", "rows", "reason")


@query(f"""
WITH {Q.RECORDS},
told AS (SELECT DISTINCT lower(trim(name)) AS n FROM rec WHERE source IN ('osm', 'atp') AND trim(coalesce(opening_hours_osm, '')) <> '' AND name IS NOT NULL)
SELECT id, website FROM rec WHERE category IN ('restaurant', 'cafe', 'pub') AND trim(coalesce(website, '')) <> '' AND trim(coalesce(opening_hours_osm, '')) = '' AND lower(trim(coalesce(name, ''))) NOT IN (SELECT n FROM told)""")
def left_to_crawl(spark: SparkSession, d: str) -> DataFrame:
    """Places to eat that have a website but no hours, neither their own nor of a map or chain record of their name."""
    r = keep_first(table(spark, d, "verify_positions"), "id", F.asc("loaded_at"))
    full = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    name = F.lower(F.trim(F.coalesce("name", F.lit("")))).alias("_n")
    told = r.where(F.get("sources", F.lit(0)).isin("osm", "atp") & full("opening_hours_osm") & F.col("name").isNotNull()).select(name).distinct()
    food = r.where(F.col("category").isin("restaurant", "cafe", "pub") & full("website") & ~full("opening_hours_osm"))
    return food.withColumn("_n", name).join(told, "_n", "left_anti").select("id", "website")
