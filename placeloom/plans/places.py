"""The build of one place table out of register, map and other records: the stages in their order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeloom.functions.scores import age_days, legs, place_rank, tier
from placeloom.operators import premises
from placeloom.operators.ranking import keep_first
from placeloom.operators.spatial import fill_empty
from placeloom.plans.cut import cut
from placeloom.plans.stages import Build, Step, gate

CONTACTS = ["phone", "website", "opening_hours_osm"]


def newest(df: DataFrame, _: dict) -> DataFrame:
    """One row an id, with its one source and its register number."""
    number = F.coalesce(F.col("fsa_id"), F.regexp_extract("osm_fhrs_id", r"^\s*0*(\d{1,18})\s*$", 1).try_cast("bigint"))
    return keep_first(df, "id", F.desc("loaded_at")).withColumn("source", F.get("sources", F.lit(0))).withColumn("number", number)


def renamed(df: DataFrame, context: dict) -> DataFrame:
    return premises.apply_aliases(df, context["aliases"])[0]


def placed(df: DataFrame, context: dict) -> DataFrame:
    """Register rows moved to the surveyed position that speaks for them; ``position_from`` tells whose, ``moved_m`` how far."""
    known = df.select("id", "name", "address", "postcode", "lat", "lng", F.col("number").cast("string").alias("number"), "source")
    found = premises.verified_positions(known.where("source = 'fsa'"), known.where("source = 'osm'"), context["aliases"])
    at = found.join(df.select(F.col("id").alias("osm"), F.col("lat").alias("_lat"), F.col("lng").alias("_lng")), "osm").where("_lat is not null and _lng is not null").select(F.col("fsa").alias("id"), F.col("osm").alias("position_from"), "moved_m", "_lat", "_lng")
    out = df.drop("position_from", "moved_m").join(at, "id", "left")
    return out.withColumn("lat", F.coalesce("_lat", "lat")).withColumn("lng", F.coalesce("_lng", "lng")).drop("_lat", "_lng")


def contacted(df: DataFrame, _: dict) -> DataFrame:
    """Empty contacts of register rows filled from the records that carry their number."""
    some = lambda c: F.max(F.nullif(F.trim(c), F.lit(""))).alias(c)
    others = df.where("source <> 'fsa' and number is not null").groupBy("number").agg(*map(some, CONTACTS))
    filled = fill_empty(df.where("source = 'fsa'"), others, "number", CONTACTS, "carried")
    return filled.unionByName(df.where("source <> 'fsa'"), allowMissingColumns=True)


def occupied(df: DataFrame, _: dict) -> DataFrame:
    """Map rows whose premises a business of another brand holds now."""
    r = df.select("id", "name", "category", "address", "postcode", "source")
    gone = premises.former_occupants(r.where("source = 'osm'"), r.where("source in ('fsa', 'servicemap')"), "id", "name", F.col("o_category") == F.col("c_category"))
    return df.drop("superseded_by").join(gone, "id", "left")


def weighed(df: DataFrame, context: dict) -> DataFrame:
    touched = F.when(F.col("osm_touched").rlike(r"^\d{4}-\d{2}-\d{2}T"), F.try_to_timestamp(F.replace("osm_touched", F.lit("Z"), F.lit("+00:00"))))
    out = df.withColumn("evidence", legs(F.col("sources"), age_days(touched, F.lit(context["now"]).cast("timestamp"))))
    return out.withColumn("tier", tier(F.col("evidence"))).withColumn("p_rank", place_rank(F.col("tier"), F.lit(None).cast("double")))


STEPS = [
    Step("newest", newest),
    Step("renamed", renamed, ("newest",), owns=("registered_name",)),
    Step("kept", lambda df, _: cut(df), ("renamed",)),
    Step("placed", placed, ("kept",), owns=("position_from", "moved_m")),
    Step("saved", lambda df, _: cut(df), ("placed",)),
    Step("contacted", contacted, ("saved",)),
    Step("occupied", occupied, ("contacted",), owns=("superseded_by",)),
    Step("weighed", weighed, ("occupied",), owns=("evidence", "tier", "p_rank")),
    # A row that nothing vouches for (a crawled page alone) is no place.
    Step("vouched", lambda df, _: df.where(F.size("evidence") > 0), ("weighed",)),
]


def build_places(records: DataFrame, aliases: DataFrame, now: str, country: str = "gb") -> DataFrame:
    """The place table, passed through the gate: an id and evidence for every row, a moved pin only with its source, no row its own successor."""
    out = Build(STEPS).run(records, country, {"aliases": aliases, "now": now})
    rules = {
        "id": F.col("id").isNotNull(),
        "evidence": F.size("evidence") > 0,
        "moves told": F.col("moved_m").isNull() | F.col("position_from").isNotNull(),
        "successor": F.col("superseded_by").isNull() | (F.col("superseded_by") != F.col("id")),
    }
    columns = ["id", "name", "registered_name", "category", "lat", "lng", "position_from", "moved_m", *CONTACTS, "superseded_by", "tier", "p_rank"]
    return gate(cut(out), rules).select(*columns)
