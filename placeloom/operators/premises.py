"""Records at one address: duplicates, changed occupants, verified positions, aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeloom.functions.geo import planar_m
from placeloom.functions.text import house_number, normal_name, postcode, same_brand, words
from placeloom.operators.components import components
from placeloom.operators.spatial import only_one


def at_premises(df: DataFrame, address: str = "address", code: str = "postcode") -> DataFrame:
    """``df`` with ``pc`` and ``hn``, the keys of a premises."""
    return df.withColumn("pc", postcode(code)).withColumn("hn", house_number(address))


def register_duplicates(df: DataFrame, id: str, name: str, rated: str) -> DataFrame:
    """(id, winner) of register rows that share premises and brand; the winner has the newest ``rated``, then the smaller id.

    Links are made between neighbours of equal first long word in a premises and closed transitively; rows without
    premises, or alone, are their own winners.
    """
    known = at_premises(df).where("pc is not null and hn is not null")
    w = F.explode(words(normal_name(name), 3))
    worded = known.select(F.col(id), "pc", "hn", F.col(name).alias("_name"), w.alias("word"))
    a, b = worded.select(F.col(id).alias("a"), "pc", "hn", "word", F.col("_name").alias("na")), worded.select(F.col(id).alias("b"), "pc", "hn", "word", F.col("_name").alias("nb"))
    links = a.join(b, ["pc", "hn", "word"]).where("a < b").where(same_brand("na", "nb")).select("a", "b").distinct()
    found = components(links)
    grouped = df.join(found, F.col(id) == F.col("node"), "left").withColumn("_g", F.coalesce(F.col("component").cast("string"), F.col(id).cast("string")))
    first = F.first(id).over(Window.partitionBy("_g").orderBy(F.col(rated).desc_nulls_last(), F.asc(id)))
    return grouped.select(F.col(id), first.alias("winner"))


def map_duplicates(df: DataFrame, id: str, name: str, category: str, lat: str, lng: str, metres: float = 250.0) -> DataFrame:
    """(kept, absorbed) of pairs: exactly two records with one plain name of six letters or more, one category, near each other, without contradicting address."""
    known = at_premises(df).withColumn("nm", normal_name(name)).where(F.length("nm") >= 6)
    counts = known.groupBy("nm").agg(F.count("*").alias("n"), F.min(id).alias("a"), F.max(id).alias("b")).where("n = 2 and a <> b")
    side = lambda k: known.select(*(F.col(c).alias(f"{k}_{c}") for c in (id, lat, lng, category, "pc", "hn")))
    both = counts.join(side("a"), F.col("a") == F.col(f"a_{id}")).join(side("b"), F.col("b") == F.col(f"b_{id}"))
    agree = lambda c: F.col(f"a_{c}").isNull() | F.col(f"b_{c}").isNull() | (F.col(f"a_{c}") == F.col(f"b_{c}"))
    near = planar_m(F.col(f"a_{lat}"), F.col(f"a_{lng}"), F.col(f"b_{lat}"), F.col(f"b_{lng}")) < metres
    return both.where(agree("pc") & agree("hn") & near & F.col(f"a_{category}").eqNullSafe(F.col(f"b_{category}"))).select(F.col("a").alias("kept"), F.col("b").alias("absorbed"))


def former_occupants(old: DataFrame, current: DataFrame, id: str, name: str, family: Column | None = None) -> DataFrame:
    """(id, superseded_by): records whose premises have exactly one current occupant, of another brand (and of the same ``family`` of ``o_``/``c_`` columns)."""
    o = at_premises(old).select(*(F.col(c).alias(f"o_{c}") for c in old.columns), "pc", "hn")
    c = only_one(at_premises(current), ["pc", "hn"]).select(*(F.col(x).alias(f"c_{x}") for x in current.columns), "pc", "hn")
    both = o.join(c, ["pc", "hn"]).where((F.col(f"o_{id}") != F.col(f"c_{id}")) & ~same_brand(f"o_{name}", f"c_{name}"))
    if family is not None:
        both = both.where(family)
    return both.select(F.col(f"o_{id}").alias(id), F.col(f"c_{id}").alias("superseded_by"))


def verified_positions(register: DataFrame, surveyed: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(fsa, osm, via, moved_m): register rows and the surveyed record that gives their position.

    Rules in order: the number that the surveyed record carries and an equal name, both unique; an equal name that is
    unique on both sides together with an equal postcode or an equal number and a long street word; a maintained
    alias with evidence. A row merged by an earlier rule is out of the later ones. Columns: id, name, address,
    postcode, lat, lng; ``fsa_id`` or ``number`` (as text) of the register.
    """
    f = at_premises(register).withColumn("nm", normal_name("name"))
    o = at_premises(surveyed).withColumn("nm", normal_name("name"))
    side = lambda df, p: df.select(*(F.col(c).alias(f"{p}_{c}") for c in df.columns))
    long = F.length("nm") >= 6
    fs, os_ = side(f.where(long), "f"), side(o.where(long), "o")
    attested = fs.join(os_, (F.col("f_number") == F.col("o_number")) & (F.col("f_nm") == F.col("o_nm")))
    attested = only_one(only_one(attested, ["o_id"]), ["f_id"]).withColumn("via", F.lit("attested"))
    f1, o1 = (only_one(df.where(long), ["nm"]) for df in (f, o))
    shared = F.size(F.array_intersect(words(normal_name(F.col("f_address")), 5), words(normal_name(F.col("o_address")), 5))) > 0
    premises = side(f1, "f").join(side(o1, "o"), F.col("f_nm") == F.col("o_nm")).where((F.col("f_pc") == F.col("o_pc")) | ((F.col("f_hn") == F.col("o_hn")) & shared)).withColumn("via", F.lit("premises"))
    rules = [attested, premises]
    if aliases is not None:
        told = aliases.where("merge_osm is not null and trim(merge_osm) <> '' and size(evidence) > 0").select(F.col("id").alias("a_id"), F.col("merge_osm").alias("a_osm")).distinct()
        rules.append(side(f, "f").join(told, F.col("f_id") == F.col("a_id")).join(side(o, "o"), F.col("o_id") == F.col("a_osm")).withColumn("via", F.lit("alias")))
    out = None
    for k, r in enumerate(rules):
        r = r.select(F.col("f_id").alias("fsa"), F.col("o_id").alias("osm"), "via", F.lit(k).alias("_k"), planar_m(F.col("f_lat"), F.col("f_lng"), F.col("o_lat"), F.col("o_lng")).alias("d"))
        out = r if out is None else out.unionByName(r)
    for key in ("fsa", "osm"):
        out = out.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("_k", "fsa", "osm"))).where("_n = 1").drop("_n")
    return out.select("fsa", "osm", "via", F.round("d").alias("moved_m"))


def apply_aliases(records: DataFrame, aliases: DataFrame, id: str = "id", name: str = "name") -> tuple[DataFrame, DataFrame]:
    """(records with verified names and absorbed rows left out, refused aliases with the reason).

    An alias holds if its record exists under the registered name (in plain form); rows it absorbs go only where
    they share the postcode.
    """
    have = records.select(F.col(id).alias("_id"), F.col(name).alias("_name"), postcode("postcode").alias("_pc"))
    told = aliases.join(have, F.col("id") == F.col("_id"), "left")
    reason = F.when(F.col("_id").isNull(), "no record").when(normal_name("_name") != normal_name("registered_name"), "name has changed").when(F.coalesce(F.trim("alias_name"), F.lit("")) == "", "no alias")
    judged = told.withColumn("reason", reason)
    good = judged.where("reason is null")
    new = good.groupBy("_id").agg(F.max_by("alias_name", F.struct("loaded_at", "alias_id")).alias("_alias"), F.max_by("registered_name", F.struct("loaded_at", "alias_id")).alias("_registered"))
    gone = good.select("_pc", F.explode("absorb").alias("_gone")).join(have.select(F.col("_id").alias("_gone"), F.col("_pc").alias("_their")), "_gone").where("_pc = _their").select("_gone").distinct()
    out = records.join(new, F.col(id) == F.col("_id"), "left").join(gone, F.col(id) == F.col("_gone"), "left_anti")
    out = out.withColumn("registered_name", F.col("_registered")).withColumn(name, F.coalesce("_alias", name)).drop("_id", "_alias", "_registered")
    return out, judged.where("reason is not null").select("alias_id", "id", "reason")
