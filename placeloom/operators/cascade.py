"""Matches by declared steps: of all steps that hold for a pair of nearby records, the first gives its method and score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeloom.functions.text import LEGAL_CHAIN, STOP_WORDS, brand_gate, contained, name_score, normal_name, postcode, scored, telling, url_key, words
from placeloom.operators.spatial import one_to_one, within, without
from placeloom.plans.cut import cut_table


@dataclass(frozen=True)
class Step:
    """A way in which a pair (``l_`` and ``r_`` columns, ``dist_m``) can match, and what it is worth then."""

    method: str
    holds: Column
    score: Column


def graded(pairs: DataFrame, steps: list[Step]) -> DataFrame:
    """``pairs`` for which a step holds, with ``method`` and ``score`` of the first that does."""
    method, score = F.lit(None).cast("string"), F.lit(None).cast("double")
    for s in reversed(steps):
        ok = F.coalesce(s.holds, F.lit(False))
        method, score = F.when(ok, F.lit(s.method)).otherwise(method), F.when(ok, s.score.cast("double")).otherwise(score)
    return pairs.withColumn("method", method).withColumn("score", score).where("method is not null")


def read(records: DataFrame, *others: str) -> DataFrame:
    """What steps compare, worked out once for each row and not for each pair: ``id``, ``lat``, ``lng`` and ``others``, the ``code``, the ``page`` unless it is a home page, the name ``plain``, its ``words`` and ``bare`` form, and its words that tell a name (``told``) or a ``brand``."""
    page = url_key("website") if "website" in records.columns else None
    first = records.select(
        "id", "lat", "lng", *others,
        *([postcode("postcode").alias("code")] if "postcode" in records.columns else []),
        *([F.when(page["deep"], page["key"]).alias("page")] if page is not None else []),
        normal_name("name").alias("plain"), normal_name("name", LEGAL_CHAIN).alias("_chain"),
    )
    chain = F.col("_chain")
    return first.select(*first.columns, words(chain, 3, STOP_WORDS).alias("words"), F.replace(chain, F.lit(" "), F.lit("")).alias("bare"), telling(F.col("plain"), 3).alias("told"), telling(chain, 2).alias("brand")).drop("_chain")


def read_score() -> Column:
    """The score of the names of two rows of :func:`read`."""
    return scored(F.col("l_words"), F.col("r_words"), F.col("l_bare"), F.col("r_bare"))


def read_code() -> Column:
    return F.coalesce(F.col("l_code") == F.col("r_code"), F.lit(False))


def same_code(l: str = "l_postcode", r: str = "r_postcode") -> Column:
    return F.coalesce(postcode(l) == postcode(r), F.lit(False))


def same_page(l: str = "l_website", r: str = "r_website") -> Column:
    """One page that isn't a home page: those are shared by all branches."""
    a, b = url_key(l), url_key(r)
    return F.coalesce(a["deep"] & (a["key"] == b["key"]), F.lit(False))


def enough(score: Column, code: Column) -> Column:
    """The score that two names near each other need; less if they are close or share the postcode."""
    return (score >= 0.5) | ((score >= 0.34) & ((F.col("dist_m") < 60) | code))


def register_steps(veto: Column) -> list[Step]:
    """Register against map (rows of :func:`read`): the register's number that the map record carries, else names of kinds that go together."""
    code, ns = read_code(), read_score()
    more = F.when(code, 0.3).otherwise(0.0) + F.when(F.col("dist_m") < 50, 0.1).otherwise(0.0)
    return [Step("number", F.col("l_number") == F.col("r_number"), F.lit(2.0) + more), Step("name", ~F.coalesce(veto, F.lit(False)) & enough(ns, code), ns + more)]


def _reach(code: Column) -> Column:
    return F.col("dist_m") <= F.when(code, 250).otherwise(120)


def chain_steps(identifier: str | None = None, branch: str | None = None) -> list[Step]:
    """Places against a chain's own list (``r_brand``): identifier, page, equal name, brand with a name that agrees, initials."""
    code = same_code()
    ns = F.greatest(name_score("l_name", "r_name"), name_score("l_name", "r_brand"), *([name_score("l_name", branch)] if branch else []))
    equal = (normal_name("l_name") == normal_name("r_name")) & (F.length(normal_name("r_name")) >= 6)
    gate = brand_gate("l_name", "r_brand")
    every = lambda c: words(normal_name(c, LEGAL_CHAIN), 1)
    steps = [
        Step("page", same_page(), F.lit(1.8)),
        Step("exact", _reach(code) & equal & (code | (F.col("dist_m") < 60)), 2.0 - F.col("dist_m") / 1e5),
        Step("name", _reach(code) & (gate == "yes") & enough(ns, code), ns + F.when(code, 0.3).otherwise(0.0)),
        Step("initials", (gate == "initials") & code & (F.col("dist_m") < 60) & (F.size(F.array_intersect(every("l_name"), every("r_brand"))) >= 2), F.lit(0.6)),
    ]
    return ([Step("identifier", F.col(f"l_{identifier}") == F.col(f"r_{identifier}"), 2.5 - F.col("dist_m") / 1e5)] if identifier else []) + steps


def release_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of two tables of :func:`read` that :func:`release_steps` can take: all within 120 m, those of one postcode within 250 m, and those of one page within 500 m."""
    near = within(left, right, 120)
    code = within(left, right, 250, on="code").where("dist_m > 120")
    page = within(left, right, 500, on="page").where((F.col("dist_m") > 120) & ~(read_code() & (F.col("dist_m") <= 250)))
    return near.unionByName(code).unionByName(page)


def release_steps(favoured: Column) -> list[Step]:
    """Places against a places release (rows of :func:`read`): one page, else an accepted name; ``favoured`` rows count a little more."""
    code, ns = read_code(), read_score()
    bare = lambda c: F.replace(F.col(c), F.lit(" "), F.lit(""))
    # As functions.text.accept has it.
    equal = (F.col("l_plain") == F.col("r_plain")) & (F.length("l_plain") >= 6)
    accepted = equal | (F.arrays_overlap("l_told", "r_told") & enough(ns, code)) | contained(bare("l_plain"), bare("r_plain"), 8)
    page = F.coalesce(F.col("l_page") == F.col("r_page"), F.lit(False))
    return [Step("page", page, F.lit(1.8)), Step("name", _reach(code) & accepted, ns + F.when(code, 0.3).otherwise(0.0) + F.when(favoured, 0.15).otherwise(0.0))]


def row_pairs(left: DataFrame, rows: DataFrame, most: float, strict: str = "strict") -> DataFrame:
    """Pairs of two tables of :func:`read` within ``most`` metres that :func:`row_steps` can take: ``strict`` rows with those of their postcode only."""
    free = within(left, rows.where(~F.col(strict)), most)
    return free.unionByName(within(left, rows.where(strict), most, on="code"))


def row_steps(kinds: str = "r_kinds", reach: str = "r_reach", strict: str = "r_strict") -> list[Step]:
    """Places against rows (of :func:`read`) that each say which categories they may join, how far, and whether only at one postcode."""
    code, ns = read_code(), read_score()
    there = F.array_contains(kinds, F.col("l_category")) & (F.col("dist_m") <= F.col(reach)) & (~F.col(strict) | code)
    return [Step("name", there & F.arrays_overlap("l_brand", "r_brand") & enough(ns, code), ns + F.when(code, 0.3).otherwise(0.0))]


def strong_agreement(method: Column, score: Column, distance: Column, confidence: Column) -> Column:
    """Whether a release row confirms a place: found by page or exact name, or by a close name within 60 m, at a confidence of .99."""
    return F.coalesce((method.isin("exact", "page") | ((method == "name") & (score >= 0.8) & (distance < 60))) & (confidence >= 0.99), F.lit(False))


def merged_one_to_one(left: DataFrame, right: DataFrame, metres: float, steps: list[Step], mode: str = "best") -> DataFrame:
    """All left rows with the right row each takes, and the right rows that nobody took: (l_id, r_id, method, score, dist_m, candidates).

    ``candidates`` counts the right rows within ``metres``. No row is taken twice (:func:`one_to_one`); rows need an
    ``id`` of their own, and those without a position match nothing.
    """
    near = cut_table(within(left, right, metres))
    taken = one_to_one(graded(near, steps).select("l_id", "r_id", "method", "score", "dist_m"), "l_id", "r_id", "score", mode=mode)
    around = near.groupBy("l_id").agg(F.count("*").alias("candidates"))
    mine = left.select(F.col("id").alias("l_id")).join(taken, "l_id", "left").join(around, "l_id", "left").withColumn("candidates", F.coalesce("candidates", F.lit(0)))
    rest = without(right, taken, "id", "r_id").select(F.col("id").alias("r_id"))
    return mine.unionByName(rest, allowMissingColumns=True)


def with_hosts(records: DataFrame, hosted_in: str = "hosted_in", told: tuple[str, ...] = ("id", "name")) -> DataFrame:
    """Records with their ``host`` (struct of ``told``) and the list of those they hold (``hosted``, by id); both null where there is none."""
    hosts = records.select(F.col("id").alias(hosted_in), F.struct(*told).alias("host"))
    held = records.where(F.col(hosted_in).isNotNull()).groupBy(F.col(hosted_in).alias("id")).agg(F.array_sort(F.collect_list(F.struct(*told))).alias("hosted"))
    return records.join(hosts, hosted_in, "left").join(held, "id", "left")
