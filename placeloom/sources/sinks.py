"""Writers: partitioned tables, tiles and shards, manifests, appended notes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeloom.functions.geo import tile
from placeloom.functions.text import folded_name


def write_packs(df: DataFrame, path: str, columns: tuple[str, ...] = ("country", "area")) -> None:
    """Parquet by area; an area's rows meet in one task each, files stay whole."""
    df.repartition(*columns).write.mode("overwrite").partitionBy(*columns).parquet(path)


def write_shards(df: DataFrame, path: str, shard: str) -> None:
    """Gzipped JSON lines, one folder for each shard."""
    df.repartition(shard).write.mode("overwrite").partitionBy(shard).option("compression", "gzip").json(path)


def pins(df: DataFrame, properties: list[str], lat: str = "lat", lng: str = "lng") -> DataFrame:
    """One GeoJSON feature (text) a row."""
    point = F.struct(F.lit("Point").alias("type"), F.array(F.round(lng, 6), F.round(lat, 6)).alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), F.struct(*properties).alias("properties"))).alias("feature"))


def detail_shards(df: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """``df`` with ``shard``, its tile at zoom 14."""
    t = tile(F.col(lat), F.col(lng))
    return df.withColumn("shard", F.concat_ws("-", t["x"].cast("string"), t["y"].cast("string")))


def name_shards(df: DataFrame, id: str, name: str, letters: int = 3, most_words: int = 12) -> DataFrame:
    """(shard, token, id, name): each word of a name under its first letters; shorter words under all they have."""
    w = F.explode(F.array_distinct(F.filter(F.split(folded_name(name), " "), lambda x: x != "")))
    return df.select(F.col(id), F.col(name), w.alias("token")).withColumn("shard", F.substring("token", 1, letters))


def search_shards(index: DataFrame, query: str, id: str, name: str, rank: str, most: int = 10) -> DataFrame:
    """Names whose word begins with the query's first word, or the reverse; equal names first, then by rank."""
    first = query.lower().split(" ")[0]
    hit = (F.col("shard").isin(*{first[:n] for n in (1, 2, 3)})) & (F.col("token").startswith(first) | F.lit(first).startswith(F.col("token")))
    return index.where(hit).groupBy(id).agg(F.first(name).alias(name), F.min(rank).alias(rank)).orderBy(F.when(F.lower(name) == query.lower(), 0).otherwise(1), rank, id).limit(most)


def manifest(packs: DataFrame, stages: list[str]) -> DataFrame:
    """Catalogue of packs: rows, whether all the stages that its country allows were run, a file name. ``packs``: id, country, pois, stages, allowed."""
    allowed = F.filter(F.col("allowed"), lambda s: s.isin(*stages))
    return packs.select("id", F.regexp_replace("id", "/", "_").alias("asset"), "country", "pois", (F.size(F.array_except(allowed, F.col("stages"))) == 0).alias("complete")).orderBy("id")


def file_stats(df: DataFrame, name: str, lat: str | None = None, lng: str | None = None) -> DataFrame:
    """One row about a table: rows, hash, bounds."""
    from placeloom.operators.ranking import table_hash

    bounds = df.agg(*((F.min(lng).alias("w"), F.min(lat).alias("s"), F.max(lng).alias("e"), F.max(lat).alias("n")) if lat else (F.lit(None).cast("double").alias(c) for c in "wsen")))
    return table_hash(df, []).crossJoin(F.broadcast(bounds)).select(F.lit(name).alias("name"), "rows", "sha256", F.array("w", "s", "e", "n").alias("bounds"))


def raw_copies(spark: SparkSession, path: str, tables: dict[str, DataFrame], missing: dict[str, str]) -> DataFrame:
    """Every table written as it came, one folder each, and a manifest: (name, rows, sha256, bounds, reason); what is ``missing`` stands there with its reason."""
    none = lambda t: F.lit(None).cast(t)
    out = None
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        told = file_stats(spark.read.schema(df.schema).parquet(f"{path}/{name}"), name).withColumn("reason", none("string"))
        out = told if out is None else out.unionByName(told)
    for name, reason in missing.items():
        told = spark.range(1).select(F.lit(name).alias("name"), none("long").alias("rows"), none("string").alias("sha256"), none("array<double>").alias("bounds"), F.lit(reason).alias("reason"))
        out = told if out is None else out.unionByName(told)
    return out


def clean_review(df: DataFrame) -> DataFrame:
    """Reviews fit to be appended: 1 to 5 stars and a text; author of 60 and text of 2000 signs at most."""
    cut_ = lambda c, n: F.substring(F.trim(F.col(c)), 1, n)
    stars = F.col("rating").try_cast("int")
    return df.where(stars.between(1, 5) & (F.coalesce(F.trim("text"), F.lit("")) != "")).select("poi_id", F.coalesce(F.nullif(cut_("author", 60), F.lit("")), F.lit("Anonymous")).alias("author"), stars.alias("rating"), cut_("text", 2000).alias("text"), "date")


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
