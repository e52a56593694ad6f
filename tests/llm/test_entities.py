import itertools
import random
import time
from pathlib import Path

import pytest

from placeloom.llm import addresses, matching, names
from placeloom.plans import cut

ADDRESS = "id string, address string, postcode string, area_id string, number int, town string"
TOWN = "eu/gb/shire/bemnysley"


def _places(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], ADDRESS)
    out = addresses.same_premises(df, **kw)
    groups = {}
    for r in out.collect():
        groups.setdefault(r.location, set()).add(r.id)
    return sorted(map(sorted, groups.values())), out


def test_one_location_in_many_writings(spark):
    same = [
        ("a1", "5 Victoria Parade, Bemnysley", "QN38 4WE", TOWN), ("a2", "5 Victoria Pde; Bemnysley", None, TOWN), ("a3", "VICTORIA PAR. NO 5\nQN384WE", None, None), ("a4", "first floor, 5 Victroia Parade", "QN38", TOWN),
        ("a5", "Rear entrance, 5 Victoria Par., Bemnysey, United Kingdom", "QN38 4WF", TOWN), ("a6", "Jars & Daughters 5 Victoria Parade Bemnysley", "QN38 4WE", None), ("a1", "5 Victoria Parade, Bemnysley", "QN38 4WE", TOWN),
    ]
    other = [
        ("b1", "5A Victoria Parade, Bemnysley", "QN38 4WE", TOWN), ("b2", "Unit 5, 5 Victoria Parade, Bemnysley", "QN38 4WE", TOWN), ("b3", "15 Victoria Parade, Bemnysley", "QN38 4WE", TOWN), ("b4", "5 Victoria Drive, Bemnysley", "QN12 8AB", TOWN),
        ("b5", "5 Victoria Parade, Fumlakford", "QE38 4WE", "eu/gb/shire/fumlakford"), ("c1", "U5, 5 Victoria Pde", "qn38 4we", TOWN), ("d1", "Rantatie 17 B", "24043", "eu/fi/y/wimtocla"), ("d2", "24043 Wimtocla, RANTAT. 17b", None, None),
        ("e1", "2276 to 2278 Mill La", "QN1 1AA", TOWN), ("e2", "2276-2278, Mill Lane", "QN1 1AA", TOWN),
    ]
    nothing = [("n1", None, "QN38 4WE", TOWN), ("n2", " ", None, TOWN), ("n3", "n/a", None, TOWN), ("n4", "Victoria Parade", None, TOWN), (None, "5 Victoria Parade, Bemnysley", "QN38 4WE", TOWN)]
    got, out = _places(spark, same + other + nothing)
    assert got == [["a1", "a2", "a3", "a4", "a5", "a6"], ["b1"], ["b2", "c1"], ["b3"], ["b4"], ["b5"], ["d1", "d2"], ["e1", "e2"]]
    pairs = {(r.id_a, r.id_b) for r in addresses.pairs(out, "location").collect()}
    assert pairs == {p for g in got for p in itertools.combinations(g, 2)}
    assert _places(spark, [])[0] == []


def test_neighbourhoods_miss_nothing_that_every_pair_would_find(spark):
    rng = random.Random(3)
    base = ["".join(rng.choices("bdfgklmnprst", k=1))[0] + rng.choice("aeiou") + rng.choice("bdlmnrst") + rng.choice("aeiou") + rng.choice("lmn") for _ in range(60)]

    def typo(s):
        i = rng.randrange(len(s) - 1)
        return rng.choice([s[:i] + s[i + 1] + s[i] + s[i + 2 :], s[:i] + s[i + 1 :], s[:i] + "x" + s[i:]])

    rows = [(f"r{i}", f"{rng.randint(1, 2)} {typo(s + 'pelta') if rng.random() < 0.5 else s + 'pelta'} Road", None, TOWN) for i, s in enumerate(base * 3)]
    got, _ = _places(spark, rows)
    forms = {r[0]: (r[1].split()[0], "", "bemnysley", r[1].split()[1].lower(), "road", "", "") for r in rows}
    parent = {k: k for k in forms}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(forms, 2):
        if addresses.same_place(forms[a], forms[b]):
            parent[find(a)] = find(b)
    want = {}
    for k in forms:
        want.setdefault(find(k), []).append(k)
    assert got == sorted(map(sorted, want.values()))


def test_a_form_without_town_meets_a_street_mistyped_at_its_beginning(spark):
    rows = [("a", "5 Victoria Parade, Bemnysley", None, TOWN), ("b", "5 Voctoria Parade, Bemnysey", None, None), ("c", "5 Victorai Parade, Bemnysey", None, None)]
    assert _places(spark, rows)[0] == [["a", "b", "c"]]


NAME = "alias_id long, registered string, trading string, entity string"


def _entities(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x") for r in rows], NAME)
    groups = {}
    for r in names.link_names(df, "alias_id", "registered", "trading", **kw).collect():
        groups.setdefault(r.entity, set()).add(r.id)
    return sorted(map(sorted, groups.values()))


def test_variants_of_names(spark):
    rows = [
        (1, "Kasnomulbe Scaffolding Group Ltd", None), (2, "KASNOMLUBE SCAFFOLDING", None), (3, "Scaffolding by Kasnomulbe Grp", "The Corner Cafe"), (4, "Kasnomulbe Bakery", "The Corner Cafe"),
        (5, "Romtynalca, Debbie", None), (6, "Mrs D Romtynalca", None), (7, "Deborah J. Romtynalca", "Harvest Lirpefumgu"), (8, "Frederick Romtynalca", None), (9, "LirpefumguHarvest", ""),
        (10, "Sesmocetta & Pimbedasve LLP", None), (11, "Pimbedasve and Sesmocetta Partnership", None), (12, "Sesmocetta & Welkuntaro LLP", None),
        (13, None, "Kasnomulbe Bakery"), (14, " ", None), (15, "&", None), (1, "Kasnomulbe Scaffolding Group Ltd", None), (16, "word " * 3000, None),
    ]
    assert _entities(spark, rows) == [[1, 2, 3], [4], [5, 6, 7, 9], [8], [10, 11], [12], [16]]
    assert _entities(spark, []) == []


def _spellings():
    """60 forms with one letter of one firm's name changed, among 900 others."""
    rng = random.Random(11)
    other = [(1000 + i, " ".join(sorted("".join(rng.choices("abdefgiklmnoprstu", k=9)) for _ in range(2)))) for i in range(900)]
    right = "kasnomulberi"
    spelt = sorted({right[:i] + c + right[i + 1 :] for i in range(len(right)) for c in "xqzwv"})
    return [(0, right), *enumerate(spelt, 1)], other


def test_spellings_of_one_name_all_meet_the_right_one(spark):
    mine, other = _spellings()
    got = {(r.a, r.b) for r in names.alike(spark.createDataFrame(mine + other, "form_id long, form string")).collect()}
    assert {(0, k) for k, _ in mine[1:]} <= got


@pytest.mark.parametrize("sizes", [{}, {"list_": 7, "held": 40}])
def test_alike_pairs_equal_brute_force(spark, sizes):
    mine, other = _spellings()
    forms = mine[::3] + other[:40] + [(5000 + k, f.replace("a", "e", 1)) for k, f in other[:40]] + [(9000, "li"), (9001, "li wu")]
    got = {(r.a, r.b): r.sim for r in names.alike(spark.createDataFrame(forms, "form_id long, form string"), **sizes).collect()}
    df = {}
    for _, f in forms:
        for g in {g for grams in names.grams_of(f, 4) for g in grams}:
            df[g] = df.get(g, 0) + 1
    vec = {i: names.weighed(f, df, len(forms), 4) for i, f in forms}
    cosine = lambda a, b: sum(x * vec[b].get(g, 0) for g, x in vec[a].items())
    text = {i: tuple(f.split(" ")) for i, f in forms}
    want = {(a, b): cosine(a, b) for a, b in itertools.combinations(sorted(vec), 2) if names.same_name(text[a], text[b])}
    assert got == pytest.approx({p: v for p, v in want.items() if v >= 0.25}, abs=1e-5)


def _held(spark):
    """Shuffle files on the disks, and tables in the checkpoint folder."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    at = Path(cut.checkpoint_dir(spark).removeprefix("file:"))
    return {f for f in files if "shuffle_" in f} | {str(p) for p in at.glob("table-*")}


def _more(spark, before):
    for _ in range(50):  # files are removed behind the driver's back
        if not (more := _held(spark) - before):
            break
        time.sleep(0.1)
    return more


def test_names_meet_in_rounds_whose_files_go(spark):
    mine, other = _spellings()
    forms = spark.createDataFrame(mine[::3] + other[:40] + [(5000 + k, f.replace("a", "e", 1)) for k, f in other[:40]], "form_id long, form string")
    whole = {(r.a, r.b): r.sim for r in names.alike(forms).collect()}
    before = _held(spark)
    pairs = names.alike(forms, list_=7, held=40, at_once=200)
    assert {p.rsplit("/", 1)[1] for p in _more(spark, before)} == {pairs._table.rsplit("/", 1)[1]}
    assert {(r.a, r.b): r.sim for r in pairs.collect()} == pytest.approx(whole, abs=1e-5)


def test_weights_go_by_shares_not_by_numbers():
    df = {g: 1 + k % 3 for k, g in enumerate(g for grams in names.grams_of("kasnomulbe bakery", 4) for g in grams)}
    one = names.weighed("kasnomulbe bakery", df, 500, 4)
    assert one == names.weighed("kasnomulbe bakery", {g: 10 * n for g, n in df.items()}, 5000, 4) and sum(x * x for x in one.values()) == pytest.approx(1)


def test_short_words_and_initials_are_told_by_their_letters():
    same = lambda a, b: names.same_name(names.words_of(a), names.words_of(b))
    assert same("Jonfypelpe Allot. Soc., Hurlossalmi", "Allotment Society of Jonfypelpe Hurlossalmi") and same("Voscalotri RC, Gutjivsalmi", "Voscalotri Rowing Club (Gutjivsalmi)")
    assert not same("Voscalotri RC, Gutjivsalmi", "Voscalotri Bowls Club, Gutjivsalmi") and not same("Kasnomulbe Bky", "Kasnomulbe Laundry") and same("Kasnomulbe Bky", "Kasnomulbe Bakery")


def test_linkage_by_rounds_equals_linkage_in_one_task(spark):
    rng = random.Random(1)
    links = [(a, b, round(rng.random(), 6)) for a, b in itertools.combinations(range(14), 2) if rng.random() < 0.5]
    df = spark.createDataFrame(links, "a long, b long, sim double")
    one = {r.node: r.cluster for r in names.cluster(df, 0.3).collect()}
    assert {r.node: r.cluster for r in names.cluster(df, 0.3, most=3).collect()} == one == names.average_linkage(links, 0.3)


PLACE = "id string, name string, postcode string, website string, p double"


def _match(spark, left, right, **kw):
    a, b = (spark.createDataFrame([(*r, 0.0) for r in rows], PLACE) for rows in (left, right))
    return {(r.left_id, r.right_id) for r in matching.match(a, b, towns=spark.createDataFrame([("fumlakford",)], "t string"), **kw).collect()}


@pytest.mark.parametrize("busy", [60, 0])
def test_two_of_three_attributes(spark, monkeypatch, busy):
    monkeypatch.setattr(matching, "BUSY_CODE", busy)
    left = [("o1", "Sumtojuspo Motel", "QN1 1AA", "https://sumtojuspomotel.test/"), ("o2", "Sumtojuspo Motel", "QE2 2BB", None), ("o3", None, None, None), ("o4", "Wimhalca Books", "QN1 1AA", "n/a")]
    left += [(f"c{k}", "Pellworth Bakes", f"QA{k} 1AA", f"pellworthbakes.example/stores/x-qa{k}1aa" if k % 2 else "pellworthbakes.example") for k in range(10, 24)]
    right = [
        ("s1", "Motel Sumtojuspo, Fumlakford", "qn11aa", None), ("s2", None, None, "www.sumtojuspomotel.test/#top"), ("s3", "Sumtojupso Motel Ltd", None, "http://sumtojuspomotel.test/contact"), ("s4", "Sumtojuspo Motel", None, None), ("s5", None, "QN1 1AA", None),
        ("s6", "Pellworth Bakes", None, "pellworthbakes.example/en/"), ("s7", None, None, "https://www.pellworthbakes.example/stores/x-qa111aa"), ("s8", "Bakes Pellworth", "QA12 1AA", "http://pellworthbakes.example"), ("s9", "Lanfotgy Yarns", "QN1 1AA", "https://sumtojuspomotel.test"),
        ("s1", "Motel Sumtojuspo, Fumlakford", "qn11aa", None), (None, "Sumtojuspo Motel", "QN1 1AA", None),
    ]
    assert _match(spark, left, right) == {("o1", "s1"), ("o1", "s3"), ("o1", "s9"), ("c11", "s7"), ("c12", "s8")}
    assert _match(spark, [], right) == set() == _match(spark, left, [])


def test_both_ways_of_a_postcode_give_the_same_rows(spark, monkeypatch):
    rng = random.Random(21)
    made = lambda n: "".join(rng.choices("abdefgiklmnoprstu", k=n))
    base = [f"{made(rng.randint(4, 9))} {rng.choice(['Motel', 'Books', 'Yarns'])}" for _ in range(30)]

    def record(k, kind):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(len(w) - 1)
            w[i : i + 2] = rng.choice([w[i + 1 :: -1][:2], [w[i]], ["x", w[i + 1]]])
        site = rng.choice([None, f"{kind[:1]}{rng.randrange(40)}.test", f"h{rng.randrange(20)}.test", f"h{rng.randrange(20)}.test/p/{rng.randrange(5)}0000"])
        return (f"{kind}{k}", rng.choice([None, "".join(w), "".join(w)]), rng.choice([None, "QN1 1AA", "QN1 1AA", "QE2 2BB"]), site)

    left, right = [record(k, "o") for k in range(120)], [record(k, "s") for k in range(60)]
    a, b = (spark.createDataFrame([(*r, 0.0) for r in rows], PLACE) for rows in (left, right))
    got = []
    for busy in (10**9, 20, 0):
        monkeypatch.setattr(matching, "BUSY_CODE", busy)
        got.append({(r.left_id, r.right_id): round(r.p, 6) for r in matching.match(a, b).collect()})
    assert got[0] == got[1] == got[2] and len(got[0]) > 5


def test_rivals_count_each(spark):
    # Five equal records share the probability; a postcode alone is no rival.
    left = [("o0", "Pellworth Bakes", "QN1 1AA", None)] + [(f"r{k}", f"Wimhalca {k} Books", "QN1 1AA", None) for k in range(80)]
    assert _match(spark, left, [("s", "Pellworth Bakes", "QN1 1AA", None)]) == {("o0", "s")}
    pairs = spark.createDataFrame([(1, 1, 2.0)], "l long, r long, prior double")
    members = spark.createDataFrame([(1, f"o{k % 5}") for k in range(9)], "class long, id string")
    assert matching.class_sizes(members, pairs, "l").first().l_n == 5


def test_busy_postcode_loses_no_name_that_agrees(spark, monkeypatch):
    monkeypatch.setattr(matching, "BUSY_CODE", 60)
    rng = random.Random(8)
    made = lambda n: "".join(rng.choices("abdefgiklmnoprstu", k=n))
    names_ = [made(5) for _ in range(25)] + [made(4) for _ in range(15)] + [f"{made(8)} {made(9)}" for _ in range(20)] + ["Xi Wu", "Bo Li Fumlakford"]

    def typo(w):
        if len(w) > 6:
            return w[0] + "x" + w[2:-2] + "z" + w[-1]
        return w[: len(w) // 2] + "x" + w[len(w) // 2 + 1 :]

    left = [(f"o{k}", n, "QN1 1AA", None) for k, n in enumerate(names_)]
    right = [(f"s{k}", " ".join(typo(w) if k < 60 and (i == 0 or len(w) < 6) else w for i, w in enumerate(n.split())) if k != 61 else "Bo Li", "QN1 1AA", None) for k, n in enumerate(names_)]
    plain = lambda n: " ".join(matching.words_of(n))
    towns = {v: {"fumlakford"} for v in matching.shortened("fumlakford")}
    agree = {(a[0], b[0]) for a in left for b in right if matching.agree_name(plain(a[1]), plain(b[1]), towns)}
    assert len(left) > matching.BUSY_CODE and {(f"o{k}", f"s{k}") for k in range(62)} <= agree
    once = {p for p in agree if sum(q[1] == p[1] for q in agree) == 1}
    assert once <= _match(spark, left, right)


def test_platform_is_told_by_records_not_by_rows(spark):
    # Four of seven records have a name of their own; three times delivered, they have it still.
    names_ = ["Sumtojuspo Motel", "Wimhalca Books", "Lanfotgy Yarns", "Pellworth Bakes", "Pellworth Bakes", "Pellworth Bakes", "Pellworth Bakes"]
    left = [(f"o{k}", n, f"QA{k + 10} 1AA", f"hosted.example/p/{k}0000") for k, n in enumerate(names_)]
    right = [("s0", None, None, "hosted.example/p/00000")]
    assert _match(spark, left, right) == set() == _match(spark, left * 3, right)


def test_twins_share_their_probability(spark):
    left = [("o1", "Pellworth Bakes", "QN1 1AA", None), ("o2", "Pellworth Bakes", "QN1 1AA", None)]
    assert _match(spark, left, [("s", "Pellworth Bakes", "QN1 1AA", None)]) == set()


def test_propagation_on_a_tree_is_exact(spark):
    import math

    prior = {(0, 0): 1.0, (0, 1): 0.5, (1, 1): 2.0}
    df = spark.createDataFrame([(a, b, v) for (a, b), v in prior.items()], "l long, r long, prior double")
    got = {(r.l, r.r): r.p for r in matching.propagate(df, tolerance=1e-7, rounds=60).collect()}
    total, sums = 0.0, dict.fromkeys(prior, 0.0)
    for on in itertools.product((0, 1), repeat=3):
        chosen = [e for e, x in zip(prior, on, strict=True) if x]
        if len({a for a, _ in chosen}) == len(chosen) == len({b for _, b in chosen}):
            weight = math.exp(sum(prior[e] for e in chosen))
            total += weight
            for e in chosen:
                sums[e] += weight
    assert got == pytest.approx({e: s / total for e, s in sums.items()}, abs=1e-4)


def test_loopy_propagation_agrees_with_enumeration(spark):
    import math

    rng = random.Random(9)
    rows, want = [], {}
    for c in range(40):
        prior = {(10 * c + a, 10 * c + b): rng.choice([1.5, 2.0, 5.5, 9.5, 10.0]) for a in range(3) for b in range(3) if rng.random() < 0.7}
        total, sums = 0.0, dict.fromkeys(prior, 0.0)
        for on in itertools.product((0, 1), repeat=len(prior)):
            chosen = [e for e, x in zip(prior, on, strict=True) if x]
            if len({a for a, _ in chosen}) == len(chosen) == len({b for _, b in chosen}):
                weight = math.exp(sum(prior[e] for e in chosen))
                total += weight
                for e in chosen:
                    sums[e] += weight
        rows += [(a, b, v) for (a, b), v in prior.items()]
        want |= {e: s / total for e, s in sums.items()}
    got = {(r.l, r.r): r.p for r in matching.propagate(spark.createDataFrame(rows, "l long, r long, prior double"), rounds=30).collect()}
    assert got.keys() == want.keys()
    sure = {e for e, p in want.items() if abs(p - 0.5) > 0.1}
    right = sum((got[e] >= 0.5) == (want[e] >= 0.5) for e in sure)
    assert right >= 0.98 * len(sure) and sum(abs(got[e] - p) for e, p in want.items()) / len(want) < 0.06


def test_a_match_leaves_its_result_only(spark):
    left = [(f"l{k}", f"Kasnomulbe{k} Bakery", f"QN{k % 9} 4WE", f"https://kasno{k}.example.com/") for k in range(40)]
    before = _held(spark)
    a, b = (spark.createDataFrame([(i.replace("l", side), *rest, 0.0) for i, *rest in left], PLACE) for side in "lr")
    found = matching.match(a, b)
    assert {p.rsplit("/", 1)[1] for p in _more(spark, before)} == {found._table.rsplit("/", 1)[1]}
    assert {(r.left_id, r.right_id) for r in found.collect()} == {(f"l{k}", f"r{k}") for k in range(40)}
