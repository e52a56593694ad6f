"""Records of one thing in two sources without a common key, by loopy belief propagation over candidate pairs."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeloom.llm.names import near, same_name, words_of
from placeloom.plans.cut import cut_table, passing, release, small

#: Log-odds of a candidate pair: BASE, and SUPPORT for each attribute that speaks for it; OWN for a page of its own; AGAINST for each that contradicts.
BASE, SUPPORT, OWN, AGAINST = -6.0, 4.0, 9.0, -0.5
#: A host that stands with more than so many postcodes is shared: by a chain, or, where most of its names differ, on a platform.
SHARED_POSTCODES, PLATFORM_NAMES = 5, 0.5
#: The pairs of a postcode of more records than this are found by finer keys. Both ways find all pairs with two supports.
BUSY_CODE = 200

_POSTCODE = re.compile(r"[a-z]{1,2}\d{1,2}\d[a-z]{2}|\d{5}")
_URL = re.compile(r"^(?:https?://)?(?:www\.)?([^\s/?#@:]+\.[a-z]{2,})(?::\d+)?(/[^?#\s]*)?", re.I)
# Paths that are no page of one branch.
_HOME = {"", "en", "fi", "sv", "fr", "contact", "visit", "about", "home", "index", "index.html", "index.htm", "index.php"}


def url_parts(url: str | None) -> tuple[str, str]:
    """(host, host with path) of an address; the second is empty for a home page, both for what is no address."""
    m = _URL.match((url or "").strip().lower())
    if not m or m[1].startswith("www.") or m[1] == "www":
        return "", ""
    path = (m[2] or "").strip("/")
    return m[1], f"{m[1]}/{path}" if path not in _HOME and ("/" in path or len(path) > 3) else ""


def full_postcode(postcode: str | None) -> str:
    """The postcode in plain form if it is whole, else an empty text."""
    plain = re.sub(r"[^a-z0-9]", "", (postcode or "").lower())
    return plain if _POSTCODE.fullmatch(plain) else ""


def plain(records: DataFrame, id: str, name: str, postcode: str, website: str) -> DataFrame:
    """(id, words, code, host, page) of each record with an id; a repeated record is as good as one in all that follows."""
    src = records.where(F.col(id).isNotNull()).select(F.col(id).alias("id"), F.col(name).alias("name"), F.col(postcode).alias("postcode"), F.col(website).alias("website"))
    kind = src.schema["id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [" ".join(words_of(n)) if n else "" for n in b.column("name").to_pylist()]
            codes = [full_postcode(p) for p in b.column("postcode").to_pylist()]
            urls = [url_parts(u) for u in b.column("website").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(words, pa.string()), pa.array(codes, pa.string()), pa.array([u[0] for u in urls], pa.string()), pa.array([u[1] for u in urls], pa.string())], ["id", "words", "code", "host", "page"])

    return src.mapInArrow(read, f"id {kind}, words string, code string, host string, page string")


def _keys():
    """Blocking keys: own page, own host, postcode. A postcode that many records have is split: by host, and by each word, what is left of it without the letters that may be mistyped, its beginning and its end."""
    told = lambda kind, ok, *parts: F.when(ok, F.concat_ws("|", F.lit(kind), *parts))
    coded = F.col("code") != ""
    words = F.filter(F.split("words", " "), lambda w: F.length(w) > 0)
    without = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1)))
    twice = lambda w: F.flatten(F.transform(without(w), without))
    none = F.array().cast("array<string>")
    # Words of six letters may have two letters mistyped, words of four one (same_name); words so far apart share what is left without as many letters.
    near_ = F.flatten(F.transform(words, lambda w: F.concat(F.array(w), F.when(F.length(w) > 3, without(w)).otherwise(none), F.when(F.length(w) > 5, twice(w)).otherwise(none))))
    # One word that is two of the other name begins or ends with one of them.
    long = F.filter(words, lambda w: F.length(w) > 2)
    told_all = lambda kind, parts: F.when(coded & F.col("busy"), F.transform(parts, lambda v: F.concat_ws("|", F.lit(kind), F.col("code"), v)))
    single = F.array(
        told("g", (F.col("page") != "") & ~F.col("platform"), "page"),
        told("w", (F.col("host") != "") & ~F.col("shared"), "host"),
        told("c", coded & ~F.col("busy"), "code"),
        told("h", coded & F.col("busy") & (F.col("host") != "") & ~F.col("platform"), "code", "host"),
    )
    parts = (("v", near_), ("n", F.transform(long, lambda w: F.substring(w, 1, 3))), ("m", F.transform(long, lambda w: F.substring(w, -3, 3))))
    return F.array_distinct(F.array_compact(F.concat(single, *(F.coalesce(told_all(kind, some), none) for kind, some in parts))))


def shortened(word: str) -> set[str]:
    """The word and what is left of it without one letter; words one edit or transposition apart share one of these."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


def agree_name(a: str, b: str, towns: dict[str, set[str]]) -> bool | None:
    """Whether two plain names agree, town names that only one of them has left aside; None if one is missing."""
    if not a or not b:
        return None
    x, y = tuple(a.split(" ")), tuple(b.split(" "))
    if same_name(x, y):
        return True
    if not set(x) & set(y) and not any(near(v, w, 2) <= 2 for v in x if len(v) > 5 for w in y if len(w) > 5):
        return False
    bare = lambda ws, others: tuple(w for w in ws if w in others or len(w) < 5 or not any(near(w, t, 1) <= 1 for v in shortened(w) for t in towns.get(v, ())))
    x2, y2 = bare(x, y), bare(y, x)
    return bool(x2 and y2 and (x2, y2) != (x, y) and same_name(x2, y2))


def candidates(left: DataFrame, right: DataFrame, towns: list[str]) -> DataFrame:
    """(l, r, prior): log-odds of every pair of classes (see :func:`classes`) that more speaks for than against: two attributes or an own page."""
    # Hashed keys are shorter to shuffle; two keys with one hash only add candidates.
    keyed = lambda df, n: df.select(F.col("class").alias(n), F.explode(_keys()).alias("key")).select(n, F.xxhash64("key").alias("key"))
    # Cut, so that the keys and the attributes are not on the disks together.
    met = cut_table(keyed(left, "l").join(keyed(right, "r"), "key").select("l", "r").distinct())
    spelt: dict[str, set[str]] = {}
    for t in towns:
        for v in shortened(t):
            spelt.setdefault(v, set()).add(t)
    side = lambda df, n: df.select(F.col("class").alias(n), *(F.col(c).alias(f"{n}_{c}") for c in ATTRIBUTES))
    both = met.join(side(left, "l"), "l").join(side(right, "r"), "r")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left_, right_, out = [], [], []
            for l, r, lw, lc, lh, lp, shared, platform, rw, rc, rh, rp in zip(*(b.column(c).to_pylist() for c in ("l", "r", "l_words", "l_code", "l_host", "l_page", "l_shared", "l_platform", "r_words", "r_code", "r_host", "r_page")), strict=True):
                code = lc == rc if lc and rc else None
                same = lh == rh if lh and rh else None
                own = bool(same and lp and lp == rp and not platform)
                branch = bool(same and lp and rp and lp != rp)  # two branches of one chain
                site = None if platform and same else same and not branch if same is not None else None
                sited = bool(site) and not shared
                if not (own or code or sited):
                    continue  # a name, or a chain's home page, is all that is left
                name = agree_name(lw, rw, spelt)
                # A chain's name and its home page tell one thing, not two.
                named = bool(name or site) if shared and same else bool(name)
                odds = BASE + SUPPORT * (named + bool(code) + sited) + OWN * own
                odds += AGAINST * ((name is False) + (code is False) + (same is False))
                if odds > 0:
                    left_.append(l), right_.append(r), out.append(odds)
            yield pa.RecordBatch.from_arrays([pa.array(left_, pa.int64()), pa.array(right_, pa.int64()), pa.array(out, pa.float64())], ["l", "r", "prior"])

    return both.mapInArrow(score, "l long, r long, prior double")


def propagate(pairs: DataFrame, left_once: bool = True, right_once: bool = True, rounds: int = 30, tolerance: float = 1e-3, damping: float = 0.5) -> DataFrame:
    """(l, r, p): marginal match probabilities of ``pairs`` (l, r, prior log-odds, optional l_n and r_n) by loopy belief propagation.

    A factor for each left record lets at most one of its pairs be true, and one for each right record likewise;
    either can be left out. Factors and pairs exchange messages, as odds, through grouped sums joined back to the
    pairs; ``l_n`` and ``r_n`` tell how many equal records a left or a right one stands for. Rounds are damped and end when no message moves by more than ``tolerance``;
    with one kind of factor the graph has no loops and the first round is exact. Each round is cut by a table, and the table before goes.
    """
    many = [(F.col(n) if n in pairs.columns else F.lit(1)).cast("double").alias(n) for n in ("l_n", "r_n")]
    now = cut_table(pairs.select("l", "r", F.exp(F.least(F.col("prior"), F.lit(50.0))).alias("odds"), *many, F.lit(1.0).alias("from_l"), F.lit(1.0).alias("from_r")))
    for _ in range(rounds):
        step = now
        if left_once:
            sums = step.groupBy("l").agg(F.sum(F.col("odds") * F.col("from_r") * F.col("r_n")).alias("s"))
            step = step.join(sums, "l").withColumn("new_l", 1 / (1 + F.greatest(F.col("s") - F.col("odds") * F.col("from_r"), F.lit(0.0)))).drop("s")
        else:
            step = step.withColumn("new_l", F.lit(1.0))
        if right_once:
            sums = step.groupBy("r").agg(F.sum(F.col("odds") * F.col("new_l") * F.col("l_n")).alias("s"))
            step = step.join(sums, "r").withColumn("new_r", 1 / (1 + F.greatest(F.col("s") - F.col("odds") * F.col("new_l"), F.lit(0.0)))).drop("s")
        else:
            step = step.withColumn("new_r", F.lit(1.0))
        loopy = left_once and right_once
        keep = damping if loopy else 0.0
        mix = lambda old, new: keep * F.col(old) + (1 - keep) * F.col(new)  # noqa: B023, E731
        step = step.select("l", "r", "odds", "l_n", "r_n", mix("from_l", "new_l").alias("from_l"), mix("from_r", "new_r").alias("from_r"), F.greatest(F.abs(F.col("from_l") - F.col("new_l")), F.abs(F.col("from_r") - F.col("new_r"))).alias("moved"))
        last, now = now, cut_table(step)
        release(last)
        if not loopy or (now.agg(F.max("moved")).first()[0] or 0.0) <= tolerance:
            break
    belief = F.col("odds") * F.col("from_l") * F.col("from_r")
    return now.select("l", "r", (belief / (1 + belief)).alias("p"))


ATTRIBUTES = ("words", "code", "host", "page", "shared", "platform", "busy")


def classes(records: DataFrame, hosts: DataFrame, codes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes, members): records with equal attributes are one class, so that a hot group is matched once.

    A class is named by a hash of its attributes, so that members need no join to find theirs.
    """
    known = records.join(small(hosts), "host", "left").join(small(codes), "code", "left")
    known = known.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("shared", "platform", "busy")}).withColumn("class", F.xxhash64(*ATTRIBUTES))
    return known.select("class", *ATTRIBUTES).distinct(), known.select("class", "id")


def class_sizes(members: DataFrame, pairs: DataFrame, side: str) -> DataFrame:
    """(side, side_n): how many records each of the classes in ``pairs`` stands for."""
    asked = members.join(pairs.select(F.col(side).alias("class")).distinct(), "class", "left_semi")
    return asked.groupBy(F.col("class").alias(side)).agg(F.count_distinct("id").alias(f"{side}_n"))


def match(left: DataFrame, right: DataFrame, id: str = "id", name: str = "name", postcode: str = "postcode", website: str = "website", towns: DataFrame | None = None, left_once: bool = False, right_once: bool = True, least: float = 0.5) -> DataFrame:
    """Matched records of two sources with a confidence: (left_id, right_id, p).

    Records are put into plain form; equal ones are matched as one class. Classes that share a blocking key (own page,
    own host, postcode; busy postcodes with host, or with a word of the name but for typing, or its beginning or end) and
    have two attributes or an own page that speak for them are candidates; their prior log-odds count these. A chain's name and home page count as one, an
    address on a platform as none, the page of a branch decides. Belief propagation (:func:`propagate`) then lets each
    right record have at most one left record (and, with ``left_once``, the reverse) and gives each pair its marginal;
    pairs of at least ``least`` come out. Left records that cannot be told apart share the probability.

    ``towns`` (one text column, at most a few thousand rows, which is checked) holds place names that may follow a
    name. Nulls, blanks and placeholders are missing attributes; a record without any has no match; null ids are left
    out; repeated records count once. Empty tables give no rows; other columns are ignored.
    """
    told = [] if towns is None else towns.distinct().limit(5001).collect()
    if len(told) > 5000:
        raise ValueError("too many towns")
    said = sorted({"".join(words_of(r[0])) for r in told if r[0]})
    with passing(left.sparkSession) as keep:
        a, b = (cut_table(plain(df, id, name, postcode, website)) for df in (left, right))
        often = a.where("host <> ''").groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") > SHARED_POSTCODES).select("host")
        # Counted exactly, over distinct values first, so that a hot host is folded; repeated records count once.
        hosts = a.join(often, "host", "left_semi").groupBy("host").agg(F.count_distinct(F.when(F.col("code") != "", F.col("code"))).alias("codes"), F.count_distinct("words").alias("names"), F.count_distinct("id").alias("n")).where(F.col("codes") > SHARED_POSTCODES)
        hosts = cut_table(hosts.select("host", F.lit(True).alias("shared"), (F.col("names") > PLATFORM_NAMES * F.col("n")).alias("platform")))
        crowd = a.select("code").unionByName(b.select("code")).where("code <> ''").groupBy("code").agg(F.count("*").alias("n")).where(F.col("n") > BUSY_CODE)
        codes = cut_table(crowd.select("code", F.lit(True).alias("busy")))
        (lc, lm), (rc, rm) = classes(a, hosts, codes), classes(b, hosts, codes)
        lc, rc = cut_table(lc), cut_table(rc)
        pairs = cut_table(candidates(lc, rc, said))
        weighed = pairs.join(class_sizes(lm, pairs, "l"), "l").join(class_sizes(rm, pairs, "r"), "r")
        found = propagate(weighed, left_once, right_once).where(F.col("p") >= least)
        return keep(cut_table(found.join(lm.toDF("l", "left_id"), "l").join(rm.toDF("r", "right_id"), "r").groupBy("left_id", "right_id").agg(F.max("p").alias("p"))))
