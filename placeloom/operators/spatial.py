"""Joins within a bounded planar distance over a grid, and what is picked from their pairs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeloom.functions.geo import LAT_M, LNG_M, cell, planar_m, segment_m
from placeloom.operators.components import components
from placeloom.plans.cut import cut, cut_parts, cut_table, passing


def within(left: DataFrame, right: DataFrame, metres: float, lat: str = "lat", lng: str = "lng", prefix: tuple[str, str] = ("l_", "r_"), size: float = 0.01, on: str | None = None) -> DataFrame:
    """All pairs of rows at most ``metres`` apart in the plane, columns prefixed, with ``dist_m``; with ``on`` only those of equal ``on``, null being equal to nothing.

    An equi-join on grid cells: the left row keeps its cell, the right row is copied into the cells that the box
    within reach of it touches. Rows without coordinates have no pairs.
    """
    a, b = (df.where(F.col(lat).isNotNull() & F.col(lng).isNotNull() & ~F.isnan(lat) & ~F.isnan(lng)).select(*(F.col(c).alias(p + c) for c in df.columns)) for df, p in ((left, prefix[0]), (right, prefix[1])))
    pl, pr = prefix
    a = a.withColumn("_cx", cell(F.col(pl + lng), size)).withColumn("_cy", cell(F.col(pl + lat), size))
    # A hair more than the distance, as it is rounded too.
    touched = lambda c, m: F.explode(F.sequence(cell(F.col(pr + c) - metres / m * (1 + 1e-9) - 1e-12, size), cell(F.col(pr + c) + metres / m * (1 + 1e-9) + 1e-12, size)))
    b = b.withColumn("_cx", touched(lng, LNG_M)).withColumn("_cy", touched(lat, LAT_M))
    keys = ["_cx", "_cy"]
    if on:
        a, b, keys = a.withColumn("_on", F.col(pl + on)), b.withColumn("_on", F.col(pr + on)), [*keys, "_on"]
    d = planar_m(F.col(pl + lat), F.col(pl + lng), F.col(pr + lat), F.col(pr + lng))
    return a.join(b, keys).withColumn("dist_m", d).where(F.col("dist_m") <= metres).drop(*keys)


def best_each(pairs: DataFrame, key: str | list[str], *order: Column) -> DataFrame:
    """The first row by ``order`` of each key; give an id last, so that ties are decided."""
    keys = [key] if isinstance(key, str) else key
    return pairs.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def without(left: DataFrame, pairs: DataFrame, key: str, pair_key: str) -> DataFrame:
    """Rows of ``left`` that no pair names."""
    return left.join(pairs.select(F.col(pair_key).alias(key)).distinct(), key, "left_anti")


def only_one(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose ``keys`` no other row has; null keys never count."""
    known = df.where(" and ".join(f"{k} is not null" for k in keys))
    return known.join(known.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n = 1").drop("_n"), keys, "left_semi")


def attach_host(guests: DataFrame, hosts: DataFrame, keys: list[str], host_id: str, name: str = "hosted_in") -> DataFrame:
    """Guests with the one host that shares all ``keys``; two hosts are none."""
    one = only_one(hosts, keys).select(*keys, F.col(host_id).alias(name))
    return guests.join(one, keys, "left")


def fill_empty(target: DataFrame, source: DataFrame, key: str, columns: list[str], stamp: str | None = None) -> DataFrame:
    """``columns`` of ``target`` filled from ``source`` where they are null or blank, with ``stamp``_source telling which were."""
    src = source.select(key, *(F.col(c).alias(f"_{c}") for c in columns))
    out = target.join(src, key, "left")
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    for c in columns:
        theirs = blank(c) & ~blank(f"_{c}")
        if stamp:
            out = out.withColumn(f"{c}_source", F.when(theirs, stamp))
        out = out.withColumn(c, F.when(theirs, F.col(f"_{c}")).otherwise(F.col(c)))
    return out.drop(*(f"_{c}" for c in columns))


def nearest_segment(points: DataFrame, segments: DataFrame, id: str, lat: str = "lat", lng: str = "lng", metres: float = 1000.0, size: float = 0.01) -> DataFrame:
    """(id, dist_m) to the nearest of ``segments`` (lat1, lng1, lat2, lng2) within ``metres``.

    Segments are cut into stretches about as long as a cell, each copied to the grid cells of its own box, so that a
    long slanting one doesn't fill the cells beside it; points look up their own cell. Lines of any number do.
    """
    reach_y, reach_x = (int(-(-metres // (size * m))) for m in (LAT_M, LNG_M))
    span = lambda a, b, r: F.explode(F.sequence(cell(F.least(a, b), size) - r, cell(F.greatest(a, b), size) + r))
    n = F.greatest(F.lit(1), F.ceil(F.greatest(F.abs(F.col("lat2") - F.col("lat1")), F.abs(F.col("lng2") - F.col("lng1"))) / size)).cast("int")
    s = segments.select("lat1", "lng1", "lat2", "lng2").withColumn("_n", n).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    at = lambda c, i: F.col(f"{c}1") + (F.col(f"{c}2") - F.col(f"{c}1")) * i / F.col("_n")
    s = s.withColumn("_cx", span(at("lng", F.col("_i")), at("lng", F.col("_i") + 1), reach_x)).withColumn("_cy", span(at("lat", F.col("_i")), at("lat", F.col("_i") + 1), reach_y)).drop("_n", "_i").distinct()
    p = points.select(F.col(id), F.col(lat).alias("_lat"), F.col(lng).alias("_lng")).where("_lat is not null and _lng is not null").withColumn("_cx", cell(F.col("_lng"), size)).withColumn("_cy", cell(F.col("_lat"), size))
    d = segment_m(F.col("_lat"), F.col("_lng"), F.col("lat1"), F.col("lng1"), F.col("lat2"), F.col("lng2"))
    return p.join(s, ["_cx", "_cy"]).withColumn("dist_m", d).where(F.col("dist_m") <= metres).groupBy(id).agg(F.min("dist_m").alias("dist_m"))


def path_segments(paths: DataFrame, id: str, points: str) -> DataFrame:
    """(id, lat1, lng1, lat2, lng2) of consecutive points [lng, lat] of each path."""
    step = F.explode(F.arrays_zip(F.slice(F.col(points), 1, F.greatest(F.size(points) - 1, F.lit(0))).alias("a"), F.slice(F.col(points), 2, 1 << 30).alias("b")))
    return paths.select(id, step.alias("s")).select(id, F.col("s.a")[1].alias("lat1"), F.col("s.a")[0].alias("lng1"), F.col("s.b")[1].alias("lat2"), F.col("s.b")[0].alias("lng2"))


def one_to_one(pairs: DataFrame, left: str, right: str, score: str, mode: str = "best", left_order: str | None = None, most: int | None = None, held: int = 200_000) -> DataFrame:
    """Pairs of which every left and every right row has at most one.

    ``best`` takes pairs by score (ties: smaller left, then right), whatever the order of rows: rounds of joins in which
    all pairs that are best for both sides are taken. ``in_order`` lets left rows choose in the order of
    ``left_order``, as a sequential reader would (:func:`_in_turn`). Components may have any number of pairs; only a
    caller that gives ``most`` has larger ones refused.
    """
    if mode == "best":
        left_pairs = cut(pairs)
        taken = None
        while True:
            order = [F.desc(score), F.asc(left), F.asc(right)]
            by = lambda k: F.row_number().over(Window.partitionBy(k).orderBy(*order))  # noqa: B023, E731
            top = cut(left_pairs.withColumn("_a", by(left)).withColumn("_b", by(right)).where("_a = 1 and _b = 1").drop("_a", "_b"))
            if top.isEmpty():
                return taken if taken is not None else top
            taken = top if taken is None else cut(taken.unionByName(top))
            left_pairs = cut(left_pairs.join(top.select(left), left, "left_anti").join(top.select(right), right, "left_anti"))
    if mode != "in_order":
        raise ValueError(mode)
    if most is not None:
        pairs = cut_table(pairs)
        named = pairs.select(F.concat(F.lit("l"), F.col(left).cast("string")).alias("_l"), F.concat(F.lit("r"), F.col(right).cast("string")).alias("_r"))
        if not named.join(components(named, "_l", "_r").withColumnRenamed("node", "_l"), "_l").groupBy("component").count().where(F.col("count") > most).isEmpty():
            raise ValueError(f"a component has more than {most} pairs")
    return _in_turn(pairs, left, right, score, left_order or left, held)


def _in_turn(pairs: DataFrame, left: str, right: str, score: str, order: str, held: int) -> DataFrame:
    """Each left row in its turn takes the best right row that is free.

    In rounds, each left row asks for its best right row; a right row drops all left rows behind the first that asks,
    and where no left row before that one has it either, the pair is settled. A right row is lost only to an earlier
    left row, which would have had it or a better one, so this is what a sequential reader takes. The first of the open
    left rows is settled in every round, and so are all with nobody before them; when at most ``held`` pairs are open,
    one task reads them in order.
    """
    turn = F.struct(F.col(order), F.col(left))
    best = F.row_number().over(Window.partitionBy(left).orderBy(F.desc(score), F.asc(right)))
    by_left, by_right = Window.partitionBy(left), Window.partitionBy(right)
    # Of left rows that are settled, no other pair stays.
    still = lambda df: df.withColumn("_gone", F.max("_settled").over(by_left)).where(~F.col("_gone")).drop("_gone")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lefts, rights = set(), set()
        for b in batches:
            kept = []
            for k, (x, y) in enumerate(zip(b.column(left).to_pylist(), b.column(right).to_pylist(), strict=True)):
                if x not in lefts and y not in rights:
                    lefts.add(x), rights.add(y), kept.append(k)
            yield b.take(pa.array(kept, pa.int64()))

    with passing(pairs.sparkSession) as keep:
        open_ = cut_table(pairs.where(F.col(left).isNotNull() & F.col(right).isNotNull()).withColumn("_settled", F.lit(False)))
        settled = []
        while open_.where("not _settled").count() > held:
            asks = still(open_).withColumn("_turn", turn).withColumn("_asks", best == 1)
            known = asks.withColumn("_first", F.min(F.when(F.col("_asks"), F.col("_turn"))).over(by_right)).withColumn("_least", F.min("_turn").over(by_right))
            left_over = known.where(F.col("_first").isNull() | (F.col("_turn") <= F.col("_first")))
            open_ = cut_table(left_over.withColumn("_settled", F.col("_asks") & (F.col("_turn") == F.col("_least"))).select(*pairs.columns, "_settled"))
            settled.append(open_.where("_settled").drop("_settled"))
        rest = still(open_).select(*pairs.columns).repartition(1).sortWithinPartitions(F.asc(order), F.asc(left), F.desc(score), F.asc(right)).mapInArrow(read, pairs.schema)
        return keep(cut_parts([*settled, rest]))


def create_unmatched(candidates: DataFrame, existing: DataFrame, metres: float, same: Column, id: str = "id", lat: str = "lat", lng: str = "lng") -> DataFrame:
    """Rows of ``candidates`` that match nothing in ``existing`` nor a candidate created before them (by id).

    ``same`` tells whether an ``l_`` row and an ``r_`` row are one. The first step is an anti-join; among the rest, a
    row is created unless an earlier created row matches it, which is settled by rounds: rows without an open earlier
    match are created, rows that match a created one are dropped.
    """
    fresh = cut(without(candidates, within(candidates, existing, metres, lat, lng).where(same), id, f"l_{id}"))
    blocks = cut(within(fresh, fresh, metres, lat, lng).where(same).where(F.col(f"r_{id}") < F.col(f"l_{id}")).select(F.col(f"l_{id}").alias("later"), F.col(f"r_{id}").alias("earlier")).distinct())
    open_ = cut(fresh.select(F.col(id).alias("later")))
    made = None
    while True:
        free = cut(open_.join(blocks, "later", "left_anti"))
        if free.isEmpty():
            break
        made = free if made is None else cut(made.unionByName(free))
        dropped = blocks.join(free.withColumnRenamed("later", "earlier"), "earlier", "left_semi").select("later").distinct()
        open_ = cut(open_.join(free, "later", "left_anti").join(dropped, "later", "left_anti"))
        blocks = cut(blocks.join(open_, "later", "left_semi").join(open_.withColumnRenamed("later", "earlier"), "earlier", "left_semi"))
    return fresh.join(made.withColumnRenamed("later", id), id, "left_semi") if made is not None else fresh.limit(0)
