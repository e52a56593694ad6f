import random

import pytest
from pyspark.sql import functions as F

from placeloom.catalogue import QUERIES
from placeloom.functions.text import accept, brand_gate, name_score, url_key
from placeloom.operators import cascade, spatial
from tests.compare import DATA

NAMES = ["Corner Bakery", "The Corner Bakery Ltd", "Cornerbakery Cafe", "Harbour Fish Bar", "Harbour Fish & Bar", "Fish Bar", "High Street Store", "Oy Kahvila Ab", "", None, "A B", "London Road Garage"]
KIND = "id string, name string, category string, postcode string, website string, lat double, lng double"


def _rows(seed, n=70):
    rng = random.Random(seed)
    pick = rng.choice
    return [(f"{seed}{i:02}", pick(NAMES), pick(["pub", "cafe", "shop", None]), pick(["QN1 1AA", "qn11aa", "QN2 2BB", None]), pick(["shop.test/a", "http://www.shop.test/a/", "shop.test", "b.test/b", None, "  "]), 51 + rng.random() * 0.006, rng.random() * 0.008) for i in range(n)]


def _sides(spark):
    return (spark.createDataFrame(_rows(s), KIND) for s in "ab")


def _told(pairs):
    return sorted((r.l_id, r.r_id, r.method, round(r.score, 9)) for r in pairs.collect())


def _no_regex_in_joins(name, spark):
    plan = QUERIES[name](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
    return not any("Join" in line and "regexp_replace" in line for line in plan.split("\n"))


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_register_names_are_read_before_they_meet(spark):
    for name in ("register_candidates", "register_merged"):
        assert _no_regex_in_joins(name, spark), name


def test_names_that_are_read_score_as_names(spark):
    a, b = _sides(spark)
    l, r = a.select(F.col("name").alias("l_name"), F.lit(0).alias("k")).distinct(), b.select(F.col("name").alias("r_name"), F.lit(0).alias("k")).distinct()
    p, q = (cascade.read(df.select(F.col(f"{c}_name").alias("id"), F.col(f"{c}_name").alias("name"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lng"))) for c, df in (("l", l), ("r", r)))
    pairs = p.select(*(F.col(c).alias(f"l_{c}") for c in p.columns)).crossJoin(q.select(*(F.col(c).alias(f"r_{c}") for c in q.columns)))
    for x in pairs.select(cascade.read_score().alias("got"), name_score("l_id", "r_id").alias("want"), F.arrays_overlap("l_brand", "r_brand").alias("brand"), brand_gate("l_id", "r_id").alias("gate")).collect():
        assert x.got == x.want and x.brand == (x.gate == "yes")


def test_release_pairs_are_all_that_the_steps_take(spark):
    a, b = _sides(spark)
    code, ns = cascade.same_code(), name_score("l_name", "r_name")
    reach = F.col("dist_m") <= F.when(code, 250).otherwise(120)
    page = F.coalesce(url_key("l_website")["deep"] & (url_key("l_website")["key"] == url_key("r_website")["key"]), F.lit(False))
    steps = [cascade.Step("page", page, F.lit(1.8)), cascade.Step("name", reach & accept("l_name", "r_name", ns, F.col("dist_m"), code), ns + F.when(code, 0.3).otherwise(0.0))]
    want = _told(cascade.graded(spatial.within(a, b, 500), steps))
    assert len({x[2] for x in want}) == 2 and _told(cascade.graded(cascade.release_pairs(cascade.read(a), cascade.read(b)), cascade.release_steps(F.lit(False)))) == want


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_release_names_are_read_before_they_meet(spark):
    assert _no_regex_in_joins("release_backfill", spark)


def test_row_pairs_are_all_that_the_steps_take(spark):
    a, b = _sides(spark)
    b = b.withColumn("kinds", F.array(F.lit("pub"), F.lit("cafe"))).withColumn("strict", F.coalesce(F.col("category") == "shop", F.lit(False))).withColumn("reach", F.when(F.col("strict"), 120).otherwise(500))
    code, ns = cascade.same_code(), name_score("l_name", "r_name")
    there = F.array_contains("r_kinds", F.col("l_category")) & (F.col("dist_m") <= F.col("r_reach")) & (~F.col("r_strict") | code)
    want = _told(cascade.graded(spatial.within(a, b, 500), [cascade.Step("name", there & (brand_gate("l_name", "r_name") == "yes") & cascade.enough(ns, code), ns + F.when(code, 0.3).otherwise(0.0))]))
    got = cascade.row_pairs(cascade.read(a, "category"), cascade.read(b, "kinds", "reach", "strict"), 500)
    assert len(want) > 20 and _told(cascade.graded(got, cascade.row_steps())) == want


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_names_of_rows_are_read_before_they_meet(spark):
    assert _no_regex_in_joins("rows_with_own_rules", spark)


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_enriching_names_are_read_before_they_meet(spark):
    assert _no_regex_in_joins("scored_enrichment", spark)
