"""Points near other points, and the region that holds a point."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeloom.functions.kdtree import LocalTree, SplitTree, arc_m, chord, unit_vectors

#: Sampled points (in expectation) from which the splits are learnt. They decide only how rows are spread, never the result.
SAMPLE_POINTS = 60_000


def placed(points: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Rows that have a place: both coordinates present and finite, not 0,0, and a latitude within 90 degrees."""
    a, b = F.col(lat), F.col(lon)
    return points.where(a.isNotNull() & b.isNotNull() & ~F.isnan(a) & ~F.isnan(b) & (F.abs(a) <= 90) & (F.abs(b) < 1e6) & ~((a == 0) & (b == 0)))


def _learn(points: DataFrame, radius_m: float, leaf_rows: int) -> SplitTree:
    n = points.count()
    share = min(1.0, SAMPLE_POINTS / max(1, n))
    picked = points.select("lat", "lon").sample(False, share, 7) if share < 1 else points.select("lat", "lon")
    got = picked.toPandas()
    return SplitTree(unit_vectors(got["lat"].to_numpy(float), got["lon"].to_numpy(float)), n, chord(radius_m) * (1 + 1e-9), max(leaf_rows, n // 4096))


def _spread(points: DataFrame, tree: SplitTree) -> DataFrame:
    """(block, own, side, part, id, lat, lon) with halo copies, one block's rows together and in order."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            get = {n: b.column(n) for n in ("id", "lat", "lon", "part", "salt")}
            xyz = unit_vectors(get["lat"].to_numpy(), get["lon"].to_numpy())
            row, block, own, side = tree.place(xyz, get["salt"].to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int64()), pa.array(own), pa.array(side, pa.int8()), *(get[n].take(pa.array(row)) for n in ("part", "id", "lat", "lon"))],
                ["block", "own", "side", "part", "id", "lat", "lon"],
            )

    salted = points.select("id", "lat", "lon", "part", F.pmod(F.xxhash64("id"), F.lit(1 << 30)).alias("salt"))
    out = salted.mapInArrow(assign, "block long, own boolean, side byte, part byte, id string, lat double, lon double")
    return out.repartition(min(20_000, max(2, tree.blocks)), "block").sortWithinPartitions("block")


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one block after the other, out of batches that are ordered by block."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        keys = b.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(keys)) + 1), len(keys)]
        for i, j in zip(edges, edges[1:], strict=False):
            if i == j:
                continue
            if held and keys[i] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = keys[i]
            held.append(b.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def near_pairs(points: DataFrame, radius_m: float, id: str = "id", lat: str = "lat", lon: str = "lon", leaf_rows: int = 8_000) -> DataFrame:
    """Pairs of different ids at most ``radius_m`` apart on the sphere: (id_a, id_b, dist_m), ``id_a < id_b`` as strings.

    Points become unit vectors; k-d splits learnt on a sample give each point one cell and halo copies in the cells
    within reach; every cell builds a local k-d tree and is queried by chord radius. A pair is reported by the cell
    that owns its smaller id, so it comes out once. Hot spots are divided into blocks (see :class:`SplitTree`).

    Rows without a place (:func:`placed`) or with a null id have no pairs. Repeated rows of one id and place count
    once; an id with several places has the pairs of each. Empty input gives no rows. Other columns are ignored.
    """
    src = placed(points.select(F.col(id).cast("string").alias("id"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))).where("id is not null").withColumn("part", F.lit(0).cast("byte"))
    tree = _learn(src, radius_m, leaf_rows)
    r = chord(radius_m)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _by_block(batches):
            ids = t.column("id").combine_chunks()
            code = ids.dictionary_encode()
            names, code = np.asarray(code.dictionary.to_pylist(), object), code.indices.to_numpy()
            rank = np.empty(len(names), int)
            rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
            lat_, lon_ = t.column("lat").to_numpy(), t.column("lon").to_numpy()
            once = np.sort(np.unique(np.stack((code.astype(float), lat_, lon_)), axis=1, return_index=True)[1])
            code, xyz = code[once], unit_vectors(lat_[once], lon_[once])
            own, side = t.column("own").to_numpy()[once], t.column("side").to_numpy()[once]
            mine = np.flatnonzero(own)  # the smaller id of a pair is asked for by its own cell
            for a, b, d2 in LocalTree(xyz).near(xyz[mine], r):
                a = mine[a]
                ok = (rank[code[a]] < rank[code[b]]) & ((side[a] == 2) | (side[a] != side[b]))
                if ok.any():
                    a, b = pa.array(once[a[ok]]), pa.array(once[b[ok]])
                    yield pa.RecordBatch.from_arrays([ids.take(a), ids.take(b), pa.array(arc_m(d2[ok]))], ["id_a", "id_b", "dist_m"])

    return _spread(src, tree).mapInArrow(pairs, "id_a string, id_b string, dist_m double")


def near_join(left: DataFrame, right: DataFrame, radius_m: float, id: str = "id", lat: str = "lat", lon: str = "lon", leaf_rows: int = 8_000) -> DataFrame:
    """For each row of ``left`` the rows of ``right`` within ``radius_m``: (left_id, right_id, dist_m).

    The plan is that of :func:`near_pairs`; a pair is reported by the cell that owns the left point. Rows without a
    place or id have no pairs; equal ids on both sides are a pair like any other; repeated rows count once.
    """
    tidy = lambda df, n: placed(df.select(F.col(id).cast("string").alias("id"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))).where("id is not null").withColumn("part", F.lit(n).cast("byte"))
    src = tidy(left, 0).unionByName(tidy(right, 1))
    tree = _learn(src, radius_m, leaf_rows)
    r = chord(radius_m)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _by_block(batches):
            part, ids = t.column("part").to_numpy(), t.column("id").combine_chunks()
            lat_, lon_ = t.column("lat").to_numpy(), t.column("lon").to_numpy()
            code = ids.dictionary_encode().indices.to_numpy()
            once = np.sort(np.unique(np.stack((code.astype(float), lat_, lon_, part.astype(float))), axis=1, return_index=True)[1])
            own, side, part = t.column("own").to_numpy()[once], t.column("side").to_numpy()[once], part[once]
            xyz = unit_vectors(lat_[once], lon_[once])
            ask, have = np.flatnonzero(own & (part == 0)), np.flatnonzero(part == 1)
            for a, b, d2 in LocalTree(xyz[have]).near(xyz[ask], r):
                a, b = ask[a], have[b]
                ok = (side[a] == 2) | (side[a] != side[b])
                if ok.any():
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(once[a[ok]])), ids.take(pa.array(once[b[ok]])), pa.array(arc_m(d2[ok]))], ["left_id", "right_id", "dist_m"])

    return _spread(src, tree).mapInArrow(pairs, "left_id string, right_id string, dist_m double")


#: Edges up to which every task may hold all regions; beyond it points and edges meet in longitude strips.
EDGES_AT_ONCE = 50_000


def ring_of_box(box: str):
    """Ring of [lon, lat] corners for an array column [w, s, e, n]."""
    w, s, e, n = (F.col(box)[i] for i in range(4))
    return F.array(F.array(w, s), F.array(e, s), F.array(e, n), F.array(w, n))


def _sweep(x: np.ndarray, y: np.ndarray, edges: np.ndarray, region: np.ndarray, most: int = 2_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Point row and region code of each containment. A line sweeps over the slabs between the edges' ends and keeps the edges that cross it."""
    up = edges[:, 0] != edges[:, 2]
    edges, region = edges[up], region[up]
    x1, x2 = np.minimum(edges[:, 0], edges[:, 2]), np.maximum(edges[:, 0], edges[:, 2])
    stops = np.unique(np.concatenate((x1, x2)))
    order = np.argsort(x, kind="stable")
    slab = np.searchsorted(stops, x[order], "right") - 1
    begin = np.searchsorted(slab, np.arange(len(stops)), "left")
    finish = np.searchsorted(slab, np.arange(len(stops)), "right")
    enter, leave = np.argsort(x1, kind="stable"), np.argsort(x2, kind="stable")
    live, i, j = set(), 0, 0
    rows, codes = [], []
    for s, at in enumerate(stops):
        while j < len(leave) and x2[leave[j]] <= at:
            live.discard(leave[j])
            j += 1
        while i < len(enter) and x1[enter[i]] <= at:
            if x2[enter[i]] > at:
                live.add(enter[i])
            i += 1
        if begin[s] == finish[s] or not live:
            continue
        on = np.array(sorted(live, key=lambda e: region[e]))
        e, (names, first) = edges[on], np.unique(region[on], return_index=True)
        for a in range(begin[s], finish[s], max(1, most // len(on))):
            p = order[a : min(finish[s], a + max(1, most // len(on)))]
            height = e[:, 1] + (x[p][:, None] - e[:, 0]) * ((e[:, 3] - e[:, 1]) / (e[:, 2] - e[:, 0]))
            odd = np.add.reduceat((height <= y[p][:, None]).astype(np.int32), first, axis=1) % 2 == 1
            r, c = np.nonzero(odd)
            rows.append(p[r])
            codes.append(names[c])
    none = np.array([], int)
    return (np.concatenate(rows), np.concatenate(codes)) if rows else (none, none)


def points_in_regions(points: DataFrame, regions: DataFrame, region_id: str, ring: str, id: str = "id", lat: str = "lat", lon: str = "lon", strip_rows: int = 100_000) -> DataFrame:
    """The regions that contain each point: (id, region_id). ``ring`` is an array of [lon, lat] corners, closed or not.

    Plane sweep over the regions' edges. The lower and the left border belong to a region, the upper and the right
    one don't. Where there are more than EDGES_AT_ONCE edges, points and edges are dealt to longitude strips (learnt
    on a sample, heavy strips salted) and swept strip by strip. Points without a place and null or empty rings have
    no result; repeated points come out once for each row; a point in overlapping regions comes out once for each.
    """
    src = placed(points.select(F.col(id).alias("id"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon")))
    ends = regions.where(F.col(region_id).isNotNull() & (F.size(F.coalesce(F.col(ring), F.array())) >= 3)).select(
        F.col(region_id).alias("region_id"),
        F.explode(F.zip_with(F.col(ring), F.concat(F.slice(F.col(ring), 2, 1 << 30), F.slice(F.col(ring), 1, 1)), lambda a, b: F.concat(a, b))).alias("edge"),
    )
    edges = ends.select("region_id", *(F.col("edge")[i].cast("double").alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))))
    id_type, region_type = (df.schema[c].dataType.simpleString() for df, c in ((src, "id"), (edges, "region_id")))
    schema = f"id {id_type}, region_id {region_type}"
    corners = ["x1", "y1", "x2", "y2"]

    def swept(ids, lat_, lon_, names, lines) -> pa.RecordBatch:
        code = names.dictionary_encode()
        row, c = _sweep(lon_, lat_, lines, code.indices.to_numpy())
        return pa.RecordBatch.from_arrays([ids.take(pa.array(row)), code.dictionary.take(pa.array(c))], ["id", "region_id"])

    if edges.limit(EDGES_AT_ONCE + 1).count() <= EDGES_AT_ONCE:
        held = edges.toArrow()
        names, lines = held.column("region_id").combine_chunks(), np.column_stack([held.column(c).to_numpy() for c in corners])

        def all_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows and len(lines):
                    yield swept(b.column("id"), b.column("lat").to_numpy(), b.column("lon").to_numpy(), names, lines)

        return src.mapInArrow(all_edges, schema)
    n = src.count()
    sample = src.select("lon").sample(False, min(1.0, SAMPLE_POINTS / max(1, n)), 7).toPandas()["lon"].to_numpy()
    strips = int(min(4096, max(1, n // strip_rows)))
    cuts = [float(x) for x in np.unique(np.quantile(sample, np.linspace(0, 1, strips + 1)[1:-1]))] if len(sample) and strips > 1 else []
    at = np.bincount(np.searchsorted(cuts, sample, "right"), minlength=len(cuts) + 1) if len(sample) else np.array([1])
    salts = [int(max(1, np.ceil(x * n / max(1, len(sample)) / (2 * strip_rows)))) for x in at]
    bounds, times = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<double>"), F.array(*map(F.lit, salts))
    strip = lambda v: F.size(F.filter(bounds, lambda c: c <= v))
    p = src.withColumn("strip", strip(F.col("lon"))).withColumn("salt", F.pmod(F.xxhash64("id", "lat", "lon"), F.get(times, F.col("strip"))))
    e = edges.withColumn("strip", F.explode(F.sequence(strip(F.least("x1", "x2")), strip(F.greatest("x1", "x2"))))).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.get(times, F.col("strip")).cast("long") - 1)))

    def one(_, a, b):
        t, u = pa.Table.from_pandas(a), pa.Table.from_pandas(b)
        return swept(t.column("id").combine_chunks(), a["lat"].to_numpy(), a["lon"].to_numpy(), u.column("region_id").combine_chunks(), b[corners].to_numpy()).to_pandas()

    return p.groupBy("strip", "salt").cogroup(e.groupBy("strip", "salt")).applyInPandas(one, schema)
