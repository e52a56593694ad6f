"""What is to be done with a pair of records: ordered rules of which the first that speaks holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeloom.functions.text import house_number, postcode, rule_name, stems, street_key, trailing_number


def verdict(ok: Column, decision: str, rule: str, **evidence: Column) -> Column:
    """Struct (decision, rule, evidence) where ``ok`` holds, else null."""
    told = F.create_map(*(x for k, v in evidence.items() for x in (F.lit(k), v.cast("string")))) if evidence else F.create_map().cast("map<string,string>")
    return F.when(F.coalesce(ok, F.lit(False)), F.struct(F.lit(decision).alias("decision"), F.lit(rule).alias("rule"), told.alias("evidence")))


def first_rule(*rules: Column) -> Column:
    return F.coalesce(*rules)


def pair_rules(a: str = "a_", b: str = "b_", protected: tuple[tuple[str, str], ...] = (), local: Column | None = None) -> dict[str, Column]:
    """The rules for two records with columns id, source, name, address, postcode, category and extra (map), prefixed.

    protected kinds never merge with each other; a record of transport joins only one with an identifier of its own;
    one house number with two names is a change of occupant; one name at one premises, from two sources, is a merge.
    """
    col = lambda p, c: F.col(p + c)
    number = {p: house_number(col(p, "address")) for p in (a, b)}
    name = {p: rule_name(col(p, "name")) for p in (a, b)}
    same_code = postcode(col(a, "postcode")) == postcode(col(b, "postcode"))
    same_number = number[a] == number[b]
    kinds = F.array_sort(F.array(*(F.coalesce(col(p, "category"), F.lit("")) for p in (a, b))))
    is_protected = F.lit(False)
    for pair in protected:
        is_protected = is_protected | (kinds == F.array(*map(F.lit, sorted(pair))))
    has_id = {p: F.coalesce(F.size(F.map_filter(col(p, "extra"), lambda k, v: k.isin("station_id", "crs", "atco") & (F.trim(v) != ""))) > 0, F.lit(False)) for p in (a, b)}
    transport = {p: has_id[p] | F.coalesce(col(p, "category").isin("station", "railway", "transit"), F.lit(False)) for p in (a, b)}
    lone = (transport[a] & ~transport[b] & ~has_id[b]) | (transport[b] & ~transport[a] & ~has_id[a]) | (transport[a] & transport[b] & ~(has_id[a] & has_id[b]))
    # One brand: a shared stem of a word of six letters or more that isn't a local one, or equal names but for blanks.
    telling = lambda p: F.array_except(stems(name[p], 6), local) if local is not None else stems(name[p], 6)
    bare = {p: F.replace(name[p], F.lit(" "), F.lit("")) for p in (a, b)}
    brand = (F.size(F.array_intersect(telling(a), telling(b))) > 0) | ((bare[a] == bare[b]) & (F.length(bare[a]) >= 4))
    named = (name[a] != "") & (name[b] != "")
    street = street_key(col(a, "address")) == street_key(col(b, "address"))
    contrary = number[a].isNotNull() & number[b].isNotNull() & (number[a] != number[b])
    exact = named & (name[a] == name[b]) & (col(a, "source") != col(b, "source")) & ~contrary & (F.coalesce(same_code, F.lit(False)) | F.coalesce(same_number & street & (street_key(col(a, "address")) != ""), F.lit(False)))
    return {
        "protected_kinds": verdict(is_protected, "separate", "protected_kinds", kinds=F.concat_ws(",", kinds)),
        "transport_identity": verdict(lone, "separate", "transport_identity"),
        "changed_occupant": verdict(same_code & same_number & named & (name[a] != name[b]) & ~brand, "separate", "changed_occupant", number=number[a]),
        "one_name_one_premises": verdict(exact, "merge", "one_name_one_premises", name=name[a]),
    }


def decide_pairs(pairs: DataFrame, **kw) -> DataFrame:
    """``pairs`` with ``outcome``: the first rule that speaks, or null."""
    return pairs.withColumn("outcome", first_rule(*pair_rules(**kw).values()))


def attach_service(distance: Column, same_page: Column, metres: float = 30.0) -> Column:
    """A service belongs to its host if both have one page and stand together."""
    return verdict(same_page & (distance.isNull() | (distance <= metres)), "attach", "one_page")


def attach_register(name: Column, address: Column, code: Column, legal_name: Column, legal_address: Column, legal_code: Column, active: Column, finnish: bool = False, drop: tuple[str, ...] = ("ltd", "limited", "plc", "llp", "the", "oy", "ab", "oyj", "ky", "services", "trading", "group")) -> Column:
    """A register entry speaks for a place: one name but for trading words, one postcode, active; ``premises`` if both have a number, else (Finnish only) ``name-only``."""
    n = trailing_number if finnish else house_number
    core = lambda c: rule_name(c, drop)
    same = ((rule_name(name) == rule_name(legal_name)) & (rule_name(name) != "")) | ((core(name) == core(legal_name)) & (F.length(core(name)) >= 4))
    numbered = n(address).isNotNull() & n(legal_address).isNotNull()
    strength = F.when(numbered, "premises").when(F.lit(finnish), "name-only")
    return verdict(same & (postcode(code) == postcode(legal_code)) & active & strength.isNotNull(), "attach", "register", strength=strength)


def pick_company(queries: DataFrame, register: DataFrame) -> DataFrame:
    """(query_id, number): the one active register entry of an equal plain name; several are decided by the municipality if only one shares it, else there is none. ``queries``: query_id, name, town; ``register``: number, name, town, status."""
    from placeloom.functions.text import register_name

    q = queries.select("query_id", register_name("name").alias("k"), F.lower("town").alias("qt"))
    r = register.where("status = 'registered'").select("number", register_name("name").alias("k"), F.lower("town").alias("rt"))
    hits = q.where("k <> ''").join(r, "k").groupBy("query_id").agg(F.count_distinct("number").alias("n"), F.min("number").alias("one"), F.count_distinct(F.when(F.col("qt") == F.col("rt"), F.col("number"))).alias("m"), F.min(F.when(F.col("qt") == F.col("rt"), F.col("number"))).alias("town"))
    return hits.select("query_id", F.when(F.col("n") == 1, F.col("one")).when(F.col("m") == 1, F.col("town")).alias("number")).where("number is not null")
