import random

import pytest
from pyspark.sql import functions as F

from placeloom.operators import spatial


def _in_turn(pairs):
    used, turn = set(), {}
    for a, b, _ in sorted(pairs, key=lambda p: (p[0], -p[2], p[1])):
        if a not in turn and b not in used:
            used.add(b)
            turn[a] = b
    return turn


@pytest.mark.parametrize("held", [0, 40, 200_000])
def test_rows_choose_in_turn_by_rounds_as_one_after_the_other(spark, held):
    rng = random.Random(held)
    # Many equal scores, so that ties count too, and a pair that stands twice.
    pairs = [(f"l{i:02}", f"r{j:02}", float(rng.randrange(4))) for i in range(40) for j in range(30) if rng.random() < 0.15]
    df = spark.createDataFrame(pairs + pairs[:5] + [("l99", None, 1.0), (None, "r01", 9.0)], "l string, r string, score double")
    got = spatial.one_to_one(df.orderBy(F.rand(3)), "l", "r", "score", mode="in_order", held=held).collect()
    assert len(got) == len({x.l for x in got}) and {x.l: x.r for x in got} == _in_turn(pairs)


def test_a_component_of_any_size_is_worked_off(spark):
    df = spark.range(520 * 520).select((F.col("id") % 520).alias("l"), F.floor(F.col("id") / 520).alias("r"), (F.hash("id") % 1000).cast("double").alias("score"))
    got = spatial.one_to_one(df, "l", "r", "score", mode="in_order").collect()
    assert len(got) == 520 and {x.l: x.r for x in got} == _in_turn([tuple(x) for x in df.collect()])


def test_pairs_of_one_kind_only(spark):
    kind = "id string, category string, lat double, lng double"
    a = spark.createDataFrame([("a", "pub", 51.0, 0.0), ("b", None, 51.0, 0.0)], kind)
    b = spark.createDataFrame([("x", "pub", 51.0, 0.0), ("y", "cafe", 51.0, 0.0), ("z", None, 51.0, 0.0), ("w", "pub", 51.1, 0.0)], kind)
    assert [(r.l_id, r.r_id, r.l_category) for r in spatial.within(a, b, 500, on="category").collect()] == [("a", "x", "pub")]
