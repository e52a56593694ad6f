"""Winners, bands, runs and sets that are decided by order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeloom.plans.cut import cut, small

# Per cent of the ranking up to which a zoom level shows a place.
ZOOM_BANDS = ((2, 12), (10, 13), (30, 14), (60, 15), (100, 16))


def latest(df: DataFrame, key: list[str], when: str, tie: str) -> DataFrame:
    """The newest row of each key; rows without a time come last."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(F.col(when).desc_nulls_last(), F.asc(tie)))).where("_n = 1").drop("_n")


def keep_first(df: DataFrame, id: str, *order: Column) -> DataFrame:
    """One row of each id: the first by ``order``."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(id).orderBy(*order))).where("_n = 1").drop("_n")


def newest_wins(layers: list[DataFrame], id: str) -> DataFrame:
    """Union in which an id of an earlier layer hides the same id of later ones."""
    out = None
    for i, df in enumerate(layers):
        df = df.withColumn("_p", F.lit(i))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    first = out.groupBy(id).agg(F.min("_p").alias("_p"))
    return out.join(first, [id, "_p"], "left_semi").drop("_p")


def ranked(df: DataFrame, score: str, id: str, rank: str = "rank", ascending: bool = False) -> DataFrame:
    """Global rank 1.. by score (highest first, nulls last, or lowest first with ``ascending``), then id, without a single-task sort.

    Rows are range-partitioned by the ranking and sorted where they lie; a row's number is its place in its partition
    plus the rows of the partitions before it, which are counted. Only the counts, one for each partition, meet in
    one task.
    """
    return numbered(df, [], [F.col(score).asc_nulls_first() if ascending else F.col(score).desc_nulls_last(), F.col(id).asc()], rank)


def numbered(df: DataFrame, key: list[str], order: list[Column], rank: str) -> DataFrame:
    """Number 1.. of each row in its ``key`` by ``order``; a key may fill many partitions (see :func:`ranked`)."""
    by = [*map(F.col, key), *order]
    placed = df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by).sortWithinPartitions(*by)
    # The order within a partition, and with it this id, is kept by the checkpoint.
    held = cut(placed.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = held.groupBy(*key, part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    told = small(before.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(key)), "_part", "_first", "_before"))
    on = part == F.col("_part")
    for i, c in enumerate(key):
        on = on & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return held.join(told, on).withColumn(rank, (F.col("_at") - F.col("_first") + 1 + F.col("_before")).cast("long")).select(*df.columns, rank)


def zoom_band(rank: Column, total: Column, bands: tuple[tuple[float, int], ...] = ZOOM_BANDS) -> Column:
    """The first band that the rank's percentage (counted from 0) fits into."""
    share = (rank - 1) * 100.0 / total
    out = F.lit(bands[-1][1])
    for edge, zoom in reversed(bands[:-1]):
        out = F.when(share <= edge, zoom).otherwise(out)
    return out


def runs(df: DataFrame, key: list[str], step: str, value: str | None = None) -> DataFrame:
    """Runs of consecutive ``step`` (integers) with equal ``value``: (key, value, begins, ends, length)."""
    same = [*key, value] if value else key
    w = Window.partitionBy(*same).orderBy(step)
    island = F.col(step) - F.row_number().over(w)
    return df.select(*same, step).distinct().withColumn("_i", island).groupBy(*same, "_i").agg(F.min(step).alias("begins"), F.max(step).alias("ends"), F.count("*").alias("length")).drop("_i")


def nearest_rank(values: Column, q: float) -> Column:
    """The element at min(n - 1, int(n * q)) of the sorted ``values``."""
    ordered = F.array_sort(values)
    n = F.size(ordered)
    return F.when(n > 0, F.get(ordered, F.least(n - 1, F.floor(n * q).cast("int"))))


def exact_quantiles(df: DataFrame, key: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Nearest-rank quantiles of each key, by numbering rather than collecting; a key's rows may lie in many partitions."""
    known = df.where(F.col(value).isNotNull()).select(*key, value)
    n = known.groupBy(*key).agg(F.count("*").alias("_n"))
    each = numbered(known, key, [F.col(value).asc()], "_i").join(small(n), key)
    at = lambda q: F.least(F.col("_n") - 1, F.floor(F.col("_n") * q)) + 1
    return each.groupBy(*key).agg(*(F.max(F.when(F.col("_i") == at(q), F.col(value))).alias(name) for name, q in quantiles.items()))


def difference(old: DataFrame, new: DataFrame, id: str, moved: Column, columns: list[str]) -> DataFrame:
    """What became of each id: 'added', 'removed', or 'moved' with the distance, by a full outer join. ``moved`` is metres between ``o_`` and ``n_`` columns."""
    o = old.select(F.col(id), *(F.col(c).alias(f"o_{c}") for c in columns), F.lit(True).alias("_o"))
    n = new.select(F.col(id), *(F.col(c).alias(f"n_{c}") for c in columns), F.lit(True).alias("_n"))
    both = o.join(n, id, "full_outer")
    kind = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(moved > 25, "moved")
    return both.select(id, kind.alias("change"), F.when(kind == "moved", F.round(moved)).alias("metres")).where("change is not null")


def table_hash(df: DataFrame, order: list[str]) -> DataFrame:
    """One row (rows, sha256) that any layout of the same rows gives: a hash of the sums of the parts of row hashes, which partial aggregation folds; nothing is collected."""
    h = F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256)
    parts = [F.conv(F.substring("h", 1 + 8 * k, 8), 16, 10).cast("decimal(38,0)") for k in range(8)]
    sums = df.select(h.alias("h")).agg(F.count("*").alias("rows"), *(F.coalesce(F.sum(p), F.lit(0)).alias(f"p{k}") for k, p in enumerate(parts)))
    return sums.select("rows", F.sha2(F.concat_ws(",", "rows", *(f"p{k}" for k in range(8))), 256).alias("sha256"))
