"""Readers of place sources with declared schemas. Predicates and columns are given to the scan, nothing is inferred."""

from __future__ import annotations

import csv
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeloom.functions.geo import boxes_meet

Box = tuple[float, float, float, float]

PLACES = "id string, names struct<primary:string>, bbox struct<xmin:double,xmax:double,ymin:double,ymax:double>, addresses array<struct<freeform:string,postcode:string>>, websites array<string>, phones array<string>, socials array<string>, sources array<struct<dataset:string,property:string,confidence:double>>, confidence double, basic_category string, operating_status string"


def places(spark: SparkSession, path: str, box: Box, columns: str = "contact", schema: str = PLACES) -> DataFrame:
    """Parquet release of places whose box (w, s, e, n) meets ``box``.

    ``contact`` keeps rows with a website or a phone that some other dataset than Microsoft's vouches for, one value
    of each contact; ``raw`` keeps all columns; ``licensed`` keeps rows that Foursquare contributed as a whole.
    """
    df = spark.read.schema(schema).parquet(path).where(boxes_meet(F.col("bbox.xmin"), F.col("bbox.ymin"), F.col("bbox.xmax"), F.col("bbox.ymax"), box))
    if columns == "raw":
        return df
    if columns == "licensed":
        return df.where(F.exists("sources", lambda s: (s["dataset"] == "Foursquare") & (F.coalesce(s["property"], F.lit("")) == "")))
    datasets = F.array_distinct(F.transform("sources", lambda s: s["dataset"]))
    first = lambda c: F.get(F.col(c), F.lit(0))
    return df.where(((F.size("websites") > 0) | (F.size("phones") > 0)) & ~F.coalesce(datasets == F.array(F.lit("Microsoft")), F.lit(False))).select(
        "id", F.col("names.primary").alias("name"), ((F.col("bbox.xmin") + F.col("bbox.xmax")) / 2).alias("lon"), ((F.col("bbox.ymin") + F.col("bbox.ymax")) / 2).alias("lat"),
        F.get("addresses", F.lit(0))["postcode"].alias("postcode"), first("websites").alias("website"), first("phones").alias("phone"), "socials", datasets.alias("datasets"), "confidence",
    )


def newest_release(names: list[str], pinned: str) -> str:
    """The highest of names like 2031-02-19.0; ``pinned`` if there is none."""
    found = [m[0] for n in names if (m := re.search(r"\d{4}-\d{2}-\d{2}\.\d+", n))]
    return max(found, key=lambda r: (r[:10], int(r[11:])), default=pinned)


def companies(spark: SparkSession, path: str, codes: list[str], candidates: dict[str, list[str]], date_formats: tuple[str, ...] = ("dd/MM/yyyy", "yyyy-MM-dd")) -> DataFrame:
    """CSV register of companies: (name, number, address, town, postcode, incorporated, codes, previous).

    ``candidates`` gives the header names each field may have; a missing required one raises. All cells are text;
    rows are kept if active and if one of the code columns begins with one of ``codes``.
    """
    header = [h.strip() for h in next(csv.reader([spark.read.text(path).limit(1).first()[0].lstrip("﻿")]))]
    found = {f: next((h for h in header if h in names), None) for f, names in candidates.items()}
    if lost := [f for f in ("name", "number", "status") if not found.get(f)]:
        raise ValueError(f"{path}: no column for {', '.join(lost)} in {header}")
    schema = T.StructType([T.StructField(h, T.StringType()) for h in header])
    df = spark.read.csv(path, schema=schema, header=True, mode="PERMISSIVE", multiLine=True, quote='"', escape='"', enforceSchema=True)
    cell = lambda f: F.nullif(F.trim(F.col(f"`{found[f]}`")), F.lit("")) if found.get(f) else F.lit(None).cast("string")
    several = lambda f: F.array_compact(F.array(*(F.nullif(F.trim(F.col(f"`{h}`")), F.lit("")) for h in header if h in candidates.get(f, [])))) if any(h in candidates.get(f, []) for h in header) else F.array().cast("array<string>")
    out = df.select(
        cell("name").alias("name"), cell("number").alias("number"), cell("address").alias("address"), cell("town").alias("town"), cell("postcode").alias("postcode"), cell("status").alias("status"),
        F.coalesce(*(F.to_date(F.try_to_timestamp(cell("incorporated"), F.lit(f))) for f in date_formats)).alias("incorporated"), several("codes").alias("codes"), several("previous").alias("previous"),
    )
    active = F.lower(F.coalesce("status", F.lit(""))).like("%ctive%")
    return out.where(active & F.exists("codes", lambda c: _starts(c, codes))).drop("status")


def _starts(c: Column, prefixes: list[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | c.startswith(p)
    return out


REGISTER = "FHRSEstablishment struct<Header:struct<ExtractDate:string>,EstablishmentCollection:array<struct<FHRSID:bigint,BusinessName:string,BusinessType:string,RatingDate:string,AddressLine1:string,AddressLine2:string,AddressLine3:string,AddressLine4:string,PostCode:string,Geocode:struct<Latitude:string,Longitude:string>>>>"


def register(spark: SparkSession, path: str, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """JSON register of food businesses, one row each: (fsa_id, name, type, rated, address_lines, postcode, lat, lng)."""
    row = spark.read.schema(REGISTER).json(path, multiLine=True).select(F.explode("FHRSEstablishment.EstablishmentCollection").alias("e")).select("e.*")
    some = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    out = row.select(
        F.col("FHRSID").alias("fsa_id"), some("BusinessName").alias("name"), some("BusinessType").alias("type"), some("RatingDate").alias("rated"), F.array_compact(F.array(*(some(f"AddressLine{i}") for i in range(1, 5)))).alias("address_lines"),
        some("PostCode").alias("postcode"), F.col("Geocode.Latitude").try_cast("double").alias("lat"), F.col("Geocode.Longitude").try_cast("double").alias("lng"),
    )
    return out.where(~F.coalesce(F.col("type").isin(*leave_out), F.lit(False))) if leave_out else out


ELEMENTS = "elements array<struct<type:string,id:bigint,lat:double,lon:double,center:struct<lat:double,lon:double>,timestamp:string,version:int,tags:map<string,string>>>"


def map_elements(spark: SparkSession, path: str) -> DataFrame:
    """Named map elements of JSON query results; a way has its centre; an element fetched twice counts once."""
    e = spark.read.schema(ELEMENTS).json(path, multiLine=True).select(F.explode("elements").alias("e")).select("e.*")
    out = e.select("type", "id", F.coalesce("lat", "center.lat").alias("lat"), F.coalesce("lon", "center.lon").alias("lon"), "timestamp", "version", "tags")
    return out.where(F.try_element_at("tags", F.lit("name")).isNotNull() & F.col("lat").isNotNull()).groupBy("type", "id").agg(*(F.max_by(c, F.struct("version", "timestamp")).alias(c) for c in ("lat", "lon", "timestamp", "version", "tags")))


def object_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(type, id, version, touched) from lines such as "n123 v4 dV c5 t2030-01-02T03:04:05Z ..."."""
    part = lambda p: F.regexp_extract("value", p, 1)
    lines = spark.read.text(path).where(F.col("value").rlike(r"^[nwr]\d"))
    kind = F.when(part("^([nwr])") == "n", "node").when(part("^([nwr])") == "w", "way").otherwise("relation")
    return lines.select(kind.alias("type"), part(r"^[nwr](\d+)").cast("long").alias("id"), part(r" v(\d+)").try_cast("int").alias("version"), F.nullif(part(r" t(\S+)"), F.lit("")).alias("touched"))


def with_metadata(elements: DataFrame, metadata: DataFrame) -> DataFrame:
    """Elements with version and time of their last change; raises if no row got a time, as then the metadata is of another extract."""
    out = elements.drop("version", "timestamp", "touched").join(metadata, ["type", "id"], "left")
    if not elements.isEmpty() and out.where("touched is not null").isEmpty():
        raise ValueError("no element has metadata")
    return out


FEATURES = "features array<struct<geometry:struct<type:string,coordinates:string>,properties:map<string,string>>>"


def features(spark: SparkSession, path: str, box: Box, properties: list[str], lines: bool = False) -> DataFrame:
    """Features of GeoJSON collections (or, with ``lines``, one to a line), those that are no points at the centre of their box, inside ``box`` (w, s, e, n), with the chosen properties."""
    if lines:
        f = spark.read.schema("geometry struct<type:string,coordinates:string>, properties map<string,string>").json(path)
    else:
        f = spark.read.schema(FEATURES).json(path, multiLine=True).select(F.explode("features").alias("f")).select("f.*")
    read = lambda kind: F.from_json("geometry.coordinates", kind)
    line = "array<array<double>>"
    corners = (
        F.when(F.col("geometry.type") == "Point", F.array(read("array<double>")))
        .when(F.col("geometry.type").isin("LineString", "MultiPoint"), read(line))
        .when(F.col("geometry.type").isin("Polygon", "MultiLineString"), F.flatten(read(f"array<{line}>")))
        .when(F.col("geometry.type") == "MultiPolygon", F.flatten(F.flatten(read(f"array<array<{line}>>"))))
    )
    middle = lambda i: (F.array_min(F.transform("_corners", lambda p: F.get(p, F.lit(i)))) + F.array_max(F.transform("_corners", lambda p: F.get(p, F.lit(i))))) / 2  # noqa: B023, E731
    w, s, e, n = box
    placed = f.withColumn("_corners", corners).withColumn("lng", middle(0)).withColumn("lat", middle(1)).where(F.col("lng").between(w, e) & F.col("lat").between(s, n))
    return placed.select("lat", "lng", *(F.nullif(F.try_element_at("properties", F.lit(p)), F.lit("")).alias(p) for p in properties))


PHARMACIES = "ods string, name string, org string, address string, postcode string, contract string, mo string, tu string, we string, th string, fr string, sa string, su string"


def pharmacies(spark: SparkSession, path: str, schema: str = PHARMACIES) -> DataFrame:
    """CSV list of pharmacies without distance sellers, with a map of cleaned hours."""
    from placeloom.functions.hours import clean_ranges

    df = spark.read.csv(path, schema=schema, header=True, mode="PERMISSIVE", multiLine=True)
    days = ("mo", "tu", "we", "th", "fr", "sa", "su")
    hours = F.map_filter(F.create_map(*(x for d in days for x in (F.lit(d.capitalize()), clean_ranges(F.col(d))))), lambda _, v: v.isNotNull())
    return df.where(~F.lower(F.coalesce("contract", F.lit(""))).contains("distance")).withColumn("hours", hours).drop(*days)


def archive(spark: SparkSession, path: str, box: Box, columns: list[str]) -> DataFrame:
    """Columns of a Parquet archive of places inside ``box`` (w, s, e, n); rows without a name are left out."""
    w, s, e, n = box
    return spark.read.parquet(path).where(F.col("lat").between(s, n) & F.col("lng").between(w, e) & F.col("name").isNotNull()).select(*columns)


def snapshot(spark: SparkSession, path: str, schema: str, mapping: dict[str, str], source: str) -> DataFrame:
    """JSON snapshot of a chain in unified columns: ``mapping`` gives a SQL expression for each of src, name, lat, lng, phone, postcode, hours_raw."""
    df = spark.read.schema(schema).json(path, multiLine=True)
    return df.select(F.lit(source).alias("src"), *(F.expr(mapping.get(c, "cast(null as string)")).cast("double" if c in ("lat", "lng") else "string").alias(c) for c in ("name", "lat", "lng", "phone", "postcode", "hours_raw")))


def one_language(c: Column, order: tuple[str, ...] = ("fi", "en", "sv")) -> Column:
    """The first filled language of a struct or map."""
    return F.coalesce(*(F.nullif(F.trim(c[k]), F.lit("")) for k in order))


def packs(spark: SparkSession, path: str) -> DataFrame:
    """(id, meta) of every meta.json under ``path`` whose folder has a plain name."""
    df = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="meta.json").withColumn("file", F.input_file_name())
    root = path.rstrip("/").removeprefix("file://")
    id_ = F.regexp_replace(F.regexp_replace(F.col("file"), r"^file:/+", "/"), rf"^{re.escape(root)}/|/meta\.json$", "")
    return df.select(id_.alias("id"), F.col("value").alias("meta")).where(F.col("id").rlike("^[a-z0-9][a-z0-9/-]*$"))


def filled_from_centroid(rows: DataFrame, centroids: DataFrame, metres: float = 10_000.0) -> DataFrame:
    """Rows (postcode, lat, lng) put at their postcode's centroid where they have no position or one further away; ``geo_precision`` tells."""
    from placeloom.functions.geo import planar_m
    from placeloom.functions.text import postcode

    c = centroids.select(postcode("postcode").alias("_pc"), F.col("lat").alias("_lat"), F.col("lng").alias("_lng"))
    out = rows.withColumn("_pc", postcode("postcode")).join(c, "_pc", "left")
    far = F.col("lat").isNull() | F.col("lng").isNull() | (planar_m(F.col("lat"), F.col("lng"), F.col("_lat"), F.col("_lng")) > metres)
    use = F.col("_lat").isNotNull() & far
    return out.withColumn("geo_precision", F.when(use, "postcode").otherwise("source")).withColumn("lat", F.when(use, F.col("_lat")).otherwise(F.col("lat"))).withColumn("lng", F.when(use, F.col("_lng")).otherwise(F.col("lng"))).drop("_pc", "_lat", "_lng")


def newest_healthy(runs: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each wanted source whose export failed or is missing, its newest run that is healthy; an empty export is not replaced. ``runs``: source, run, status; ``wanted``: source, status."""
    need = wanted.where(F.coalesce("status", F.lit("missing")).isin("failed", "missing")).select("source")
    return runs.where("status = 'ok'").join(need, "source", "left_semi").groupBy("source").agg(F.max("run").alias("run"))


def read_or_make(spark: SparkSession, path: str, made_from: float, make) -> DataFrame:
    """A Parquet extract at ``path``, made anew by ``make()`` if it is older than ``made_from`` (epoch seconds) or missing."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    done = spark._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    if not fs.exists(done) or fs.getFileStatus(done).getModificationTime() / 1000 < made_from:
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
