import itertools
import random

import pytest
from pyspark.sql import functions as F

from placeloom.operators import cascade, decisions, premises, ranking, spatial
from placeloom.operators.components import components
from placeloom.plans.stages import Build, Step, gate, violations

AT = "id string, name string, lat double, lng double"


def points(seed, n):
    rng = random.Random(seed)
    return [(f"{seed}-{i:03}", f"n{i % 5}", 51 + rng.random() * 0.02, 0.5 + rng.random() * 0.03) for i in range(n)]


def metres(a, b):
    return (((a[2] - b[2]) * 111320) ** 2 + ((a[3] - b[3]) * 62500) ** 2) ** 0.5


@pytest.mark.parametrize("radius", [120, 500, 1500])
def test_bounded_join_equals_brute_force(spark, radius):
    a, b = points(1, 60), points(2, 60)
    got = spatial.within(spark.createDataFrame(a + [("x", "y", None, 1.0)], AT), spark.createDataFrame(b, AT), radius)
    assert "CartesianProduct" not in got._jdf.queryExecution().toString() and "NestedLoop" not in got._jdf.queryExecution().toString()
    assert sorted((r.l_id, r.r_id) for r in got.collect()) == sorted((x[0], y[0]) for x in a for y in b if metres(x, y) <= radius)


def test_one_to_one_modes(spark):
    rng = random.Random(9)
    pairs = [(f"l{i}", f"r{j}", round(rng.random(), 4)) for i in range(12) for j in range(12) if rng.random() < 0.3]
    df = spark.createDataFrame(pairs, "l string, r string, score double")
    left, right, want = set(), set(), set()
    for a, b, _ in sorted(pairs, key=lambda p: (-p[2], p[0], p[1])):
        if a not in left and b not in right:
            left.add(a), right.add(b), want.add((a, b))
    assert {(x.l, x.r) for x in spatial.one_to_one(df.orderBy(F.rand(3)), "l", "r", "score").collect()} == want
    used, turn = set(), set()
    for a in sorted({p[0] for p in pairs}):
        free = [p for p in pairs if p[0] == a and p[1] not in used]
        if free:
            best = min(free, key=lambda p: (-p[2], p[1]))
            used.add(best[1]), turn.add(best[:2])
    assert {(x.l, x.r) for x in spatial.one_to_one(df, "l", "r", "score", mode="in_order").collect()} == turn
    assert spatial.one_to_one(df.where("false"), "l", "r", "score").count() == 0
    with pytest.raises(ValueError):
        spatial.one_to_one(df, "l", "r", "score", mode="in_order", most=1)


def test_created_rows_block_later_ones(spark):
    rows = [("a", "n", 51.0, 0.5), ("b", "n", 51.0005, 0.5), ("c", "n", 51.001, 0.5), ("d", "m", 51.0, 0.5), ("e", "n", 52.0, 0.5)]
    old = spark.createDataFrame([("o", "n", 52.0, 0.5)], AT)
    got = spatial.create_unmatched(spark.createDataFrame(rows, AT), old, 70, F.col("l_name") == F.col("r_name"))
    assert sorted(r.id for r in got.collect()) == ["a", "c", "d"]


def test_components_of_a_long_path_and_of_clusters(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (102, 102), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 102}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_segments_hosts_and_filling(spark):
    path = spark.createDataFrame([("c", [[0.0, 51.0], [1.0, 51.0], [1.0, 52.0]])], "id string, p array<array<double>>")
    seg = spatial.path_segments(path, "id", "p")
    assert seg.count() == 2
    near = spatial.nearest_segment(spark.createDataFrame([("p", "x", 51.001, 0.5), ("q", "x", 51.5, 0.5)], AT), seg, "id", metres=500)
    assert [(r.id, round(r.dist_m, 1)) for r in near.collect()] == [("p", 111.3)]
    hosts = spark.createDataFrame([("h1", "k"), ("h2", "m"), ("h3", "m"), ("h4", None)], "h string, k string")
    got = spatial.attach_host(spark.createDataFrame([("a", "k"), ("b", "m"), ("c", None)], "g string, k string"), hosts, ["k"], "h")
    assert {r.g: r.hosted_in for r in got.collect()} == {"a": "h1", "b": None, "c": None}
    t = spark.createDataFrame([(1, None, "w"), (2, " ", None), (3, "p", None)], "k int, phone string, web string")
    s = spark.createDataFrame([(1, "x", "y"), (2, "x", " ")], "k int, phone string, web string")
    f = {r.k: (r.phone, r.web, r.phone_source) for r in spatial.fill_empty(t, s, "k", ["phone", "web"], "src").collect()}
    assert f == {1: ("x", "w", "src"), 2: ("x", None, "src"), 3: ("p", None, None)}


def test_ranking(spark):
    rng = random.Random(2)
    rows = [(f"i{i:03}", rng.choice([None, 1.0, 2.0, 3.0])) for i in range(100)]
    got = {r.id: (r.rank, r.z) for r in ranking.ranked(spark.createDataFrame(rows, "id string, s double"), "s", "id").withColumn("z", ranking.zoom_band(F.col("rank"), F.lit(100))).collect()}
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert {k: v[0] for k, v in got.items()} == {r[0]: i + 1 for i, r in enumerate(order)}
    zoom = {v[0]: v[1] for v in got.values()}
    assert [zoom[i] for i in (3, 4, 11, 12, 31, 32, 61, 62)] == [12, 13, 13, 14, 14, 15, 15, 16]


def test_runs_difference_layers(spark):
    days = spark.createDataFrame([("a", d, "x") for d in (1, 2, 3, 5, 6, 2)] + [("a", 4, "y")], "k string, d long, v string")
    assert sorted((r.v, r.begins, r.ends, r.length) for r in ranking.runs(days, ["k"], "d", "v").collect()) == [("x", 1, 3, 3), ("x", 5, 6, 2), ("y", 4, 4, 1)]
    old, new = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "id string, x double"), spark.createDataFrame([("b", 2.0), ("c", 40.0), ("d", 1.0)], "id string, x double")
    got = {r.id: (r.change, r.metres) for r in ranking.difference(old, new, "id", F.abs(F.col("o_x") - F.col("n_x")), ["x"]).collect()}
    assert got == {"a": ("removed", None), "c": ("moved", 37.0), "d": ("added", None)}
    assert {r.id: r.x for r in ranking.newest_wins([new, old], "id").collect()} == {"a": 1.0, "b": 2.0, "c": 40.0, "d": 1.0}
    h = [ranking.table_hash(df, []).first() for df in (old, old.repartition(5, "x"), new)]
    assert h[0] == h[1] != h[2] and h[0].rows == 3


def test_premises(spark):
    reg = spark.createDataFrame([("f1", "Otter Inn", "2030", "1 High St", "A1"), ("f2", "The Otter", "2031", "1 High St", "a 1"), ("f3", "Otter", None, "2 High St", "A1"), ("f4", "Other", "2031", "1 High St", "A1"), ("f5", None, None, None, None)], "id string, name string, rated string, address string, postcode string")
    assert {r.id: r.winner for r in premises.register_duplicates(reg, "id", "name", "rated").collect()} == {"f1": "f2", "f2": "f2", "f3": "f3", "f4": "f4", "f5": "f5"}
    cols = "id string, name string, category string, address string, postcode string"
    old = spark.createDataFrame([("o1", "Fern", "cafe", "5 Rd", "B2"), ("o2", "Tulip Bar", "cafe", "5 Rd", "B2"), ("o3", "Torque", "shop", "7 Rd", "B2")], cols)
    now = spark.createDataFrame([("c1", "Tulip", "pub", "5 Rd", "b2"), ("c2", "Hall A", "shop", "7 Rd", "B2"), ("c3", "Hall B", "shop", "7 Rd", "B2")], cols)
    assert [tuple(r) for r in premises.former_occupants(old, now, "id", "name").collect()] == [("o1", "c1")]


PAIR = "a_source string, a_name string, a_address string, a_postcode string, a_category string, a_extra map<string,string>, b_source string, b_name string, b_address string, b_postcode string, b_category string, b_extra map<string,string>"


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [
        (("osm", "Joe's Cafe", "1 High St", "A1", "cafe"), ("fsa", "Joes Cafe Ltd", "1 High St", "a1", "cafe"), ("merge", "one_name_one_premises")),
        (("osm", "Joe's", "1 High St", None, "cafe"), ("osm", "Joe's", "1 High St", None, "cafe"), None),
        (("osm", "Joe's", "1 High St", "A1", "cafe"), ("fsa", "Joe's", "3 High St", "A1", "cafe"), None),
        (("osm", "Fern", "1 High St", "A1", "cafe"), ("fsa", "Tulip", "1 High St", "A1", "cafe"), ("separate", "changed_occupant")),
        (("osm", "Fern", "High St", "A1", "cafe"), ("fsa", "Tulip", "High St", "A1", "cafe"), None),
        (("osm", "Same", "1 High St", "A1", "veterinary"), ("fsa", "Same", "1 High St", "A1", "shop"), ("separate", "protected_kinds")),
        (("osm", "Central", None, None, "station"), ("fsa", "Central", None, None, "shop"), ("separate", "transport_identity")),
    ],
)
def test_pair_rules(spark, a, b, want):
    df = spark.createDataFrame([(*a, None, *b, None)], PAIR)
    got = decisions.decide_pairs(df, protected=(("shop", "veterinary"),)).first().outcome
    assert (None if got is None else (got.decision, got.rule)) == want


def test_register_entries(spark):
    row = spark.createDataFrame([("Harju Oy", "Koivutie 62, Helsinki", "00500")], "n string, a string, p string")
    strength = lambda legal, addr, active: row.select(decisions.attach_register(F.col("n"), F.col("a"), F.col("p"), F.lit(legal), F.lit(addr), F.lit("00500"), F.lit(active), finnish=True).alias("x")).first().x
    assert strength("Harju", "Koivutie 62", True).evidence["strength"] == "premises" and strength("Harju", "Koivutie", True).evidence["strength"] == "name-only"
    assert strength("Harju", "Koivutie 62", False) is None and strength("Lehto", "Koivutie 62", True) is None
    q = spark.createDataFrame([(1, "Kahvila Oy", "Espoo"), (2, "Kahvila", None), (3, "Solo Ab", "x")], "query_id int, name string, town string")
    r = spark.createDataFrame([("A", "Kahvila", "Espoo", "registered"), ("B", "Kahvila Oy", "Turku", "registered"), ("C", "Solo", "y", "registered"), ("D", "Solo", "y", "ceased")], "number string, name string, town string, status string")
    assert {x.query_id: x.number for x in decisions.pick_company(q, r).collect()} == {1: "A", 3: "C"}


def test_build_order_ledger_and_gate(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", None, 5)], "id string, n int, made int")
    steps = [Step("last", lambda d, c: d.withColumn("made", F.coalesce("made", F.lit(c["v"]))), ("first",), owns=("made",)), Step("first", lambda d, _: d.where("n is not null or id = 'b'")), Step("fi", lambda d, _: d.limit(0), countries=("fi",))]
    build = Build(steps)
    out = build.run(df, "gb", {"v": 7})
    assert [r.made for r in out.collect()] == [7, 7] and build.ledger == [("first", "ran", ""), ("fi", "skipped", "not for gb"), ("last", "ran", "")]
    again = Build(steps).run(out, "gb", {"v": 7})
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))
    with pytest.raises(ValueError, match="'n_known': 1"):
        gate(df, {"n_known": F.col("n").isNotNull(), "id": F.col("id").isNotNull()})
    assert violations(df, "id", {"n_known": F.col("n").isNotNull()}).where("violations = 1").first().id == "b"


def test_best_each_is_the_same_for_any_order_of_rows(spark):
    rows = [(k, i, i % 2) for k, i in itertools.product("ab", range(6))]
    df = spark.createDataFrame(rows, "k string, i int, s int")
    pick = lambda d: sorted(map(tuple, spatial.best_each(d, "k", F.desc("s"), F.asc("i")).collect()))
    assert pick(df) == pick(df.orderBy(F.rand(1))) == [("a", 1, 1), ("b", 1, 1)]


def test_build_of_places_can_be_run_again(spark):
    from placeloom.plans.places import build_places

    cols = "id string, name string, sources array<string>, fsa_id long, osm_fhrs_id string, osm_touched string, category string, address string, postcode string, lat double, lng double, phone string, website string, opening_hours_osm string, loaded_at timestamp"
    from datetime import datetime

    t = datetime(2030, 1, 1)
    rows = [
        ("fsa-1", "Harbour Kitchen", ["fsa"], 1, None, None, "cafe", "1 High St", "A1", 51.0, 0.5, " ", None, None, t),
        ("osm-1", "Harbour Kitchen", ["osm"], None, "001 ", "2031-01-01T00:00:00Z", "cafe", "1 High St", "A1", 51.1, 0.6, "0123456789", "http://h.example", None, t),
        ("osm-2", "Lantern", ["osm"], None, None, "bad", "cafe", "1 High St", "a 1", 51.1, 0.6, None, None, None, t),
        ("fsa-1", "Harbour Kitchen", ["fsa"], 1, None, None, "cafe", "1 High St", "A1", 51.0, 0.5, " ", None, None, datetime(2029, 1, 1)),
    ]
    alias = spark.createDataFrame([(1, "fsa-1", "Harbour Kitchen", "The Harbour", ["osm-9"], None, ["seen"], t)], "alias_id long, id string, registered_name string, alias_name string, absorb array<string>, merge_osm string, evidence array<string>, loaded_at timestamp")
    df = spark.createDataFrame(rows, cols)
    out = {r.id: r for r in build_places(df, alias.where("false"), "2031-03-01").collect()}
    f = out["fsa-1"]
    assert (f.lat, f.position_from, f.phone, f.website, f.tier) == (51.1, "osm-1", "0123456789", "http://h.example", 1.0)
    assert out["osm-2"].superseded_by == "fsa-1" and out["osm-1"].superseded_by is None and out["osm-2"].tier == 0.3
    named = {r.id: r.name for r in build_places(df, alias, "2031-03-01").collect()}
    assert named["fsa-1"] == "The Harbour"


def test_numbering_of_a_key_over_many_partitions(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.9 else rng.choice("ab"), rng.randrange(50), i) for i in range(2000)] + [(None, 1, 9999)]
    df = spark.createDataFrame(rows, "k string, v int, id int").repartition(7)
    want, seen = {}, {}
    for k, v, i in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        seen[k] = want[i] = seen.get(k, 0) + 1
        want[i] = (k, seen[k])
    got = {r.id: (r.k, r.n) for r in ranking.numbered(df, ["k"], [F.asc("v"), F.asc("id")], "n").collect()}
    assert got == want
    values = sorted(v for k, v, _ in rows if k == "hot")
    q = {r.k: (r.p50, r.p99) for r in ranking.exact_quantiles(df, ["k"], "v", {"p50": 0.5, "p99": 0.99}).collect()}
    assert q["hot"] == tuple(values[min(len(values) - 1, int(len(values) * x))] for x in (0.5, 0.99))
    assert [r.rank for r in ranking.ranked(df.where("false"), "v", "id").collect()] == []


def test_slanting_lines_are_near_along_their_way_only(spark):
    seg = spark.createDataFrame([(50.0, 0.0, 50.5, 0.5)], "lat1 double, lng1 double, lat2 double, lng2 double")
    points = spark.createDataFrame([("on", "x", 50.25, 0.25), ("off", "x", 50.45, 0.05), ("end", "x", 50.502, 0.502)], AT)
    assert {r.id for r in spatial.nearest_segment(points, seg, "id", metres=500).collect()} == {"on", "end"}


def test_cascade_takes_the_first_step_that_holds(spark):
    kind = "id string, name string, brand string, postcode string, website string, number long, lat double, lng double"
    left = spark.createDataFrame([("a", "Corner Bakery", "", "QN1 1AA", "shop.test/branch/1", 5, 51.0, 0.0), ("b", "Corner Bakery", "", None, None, None, 51.0, 0.0), ("c", "B & M", "", "QN1 1AA", None, None, 51.0, 0.0), ("d", None, "", None, None, None, None, 0.0)], kind)
    right = spark.createDataFrame(
        [("n", "Other", "Other", None, None, 5, 51.003, 0.0), ("p", "Other", "Other", None, "http://www.shop.test/branch/1/", None, 51.003, 0.0), ("h", "Other", "Other", None, "shop.test", None, 51.0, 0.0), ("e", "Corner Bakery", "Corner Bakery", "qn11aa", None, None, 51.0, 0.0), ("m", "Mart", "B M", "QN1 1AA", None, None, 51.0, 0.0)], kind
    )
    got = {(r.l_id, r.r_id): r.method for r in cascade.graded(spatial.within(left, right, 500), cascade.chain_steps("number")).collect()}
    assert got == {("a", "n"): "identifier", ("a", "p"): "page", ("a", "e"): "exact", ("b", "e"): "exact", ("c", "m"): "name"} or got == {("a", "n"): "identifier", ("a", "p"): "page", ("a", "e"): "exact", ("b", "e"): "exact", ("c", "m"): "initials"}
    out = {(r.l_id, r.r_id, r.candidates) for r in cascade.merged_one_to_one(left, right, 150, cascade.chain_steps("number")).collect()}
    assert {(x, y) for x, y, _ in out if x and y} == {("a", "e"), ("c", "m")} and {y for x, y, _ in out if x is None} == {"n", "p", "h"} and ("d", None, 0) in out
    strong = spark.range(1).select(cascade.strong_agreement(F.lit("name"), F.lit(0.8), F.lit(59.0), F.lit(0.99)).alias("a"), cascade.strong_agreement(F.lit("name"), F.lit(0.8), F.lit(61.0), F.lit(0.99)).alias("b"), cascade.strong_agreement(F.lit("page"), F.lit(0.1), F.lit(400.0), F.lit(0.98)).alias("c")).first()
    assert tuple(strong) == (True, False, False)


def test_hosts_and_their_guests(spark):
    df = spark.createDataFrame([("a", "Hall", None), ("b", "Bar", "a"), ("c", "Cafe", "a"), ("d", "Lost", "gone")], "id string, name string, hosted_in string")
    got = {r.id: (r.host and r.host.name, r.hosted and [h.id for h in r.hosted]) for r in cascade.with_hosts(df).collect()}
    assert got == {"a": (None, ["b", "c"]), "b": ("Hall", None), "c": ("Hall", None), "d": (None, None)}
