"""Winners, bands, runs, quantiles, counts and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeloom.functions.scores import bayes_rating, list_verdict, positive_share, recommended, review_band
from placeloom.operators.ranking import exact_quantiles, keep_first, latest, nearest_rank, newest_wins, ranked, runs, zoom_band
from placeloom.queries import query, table


@query("SELECT id, rank, CASE WHEN share <= 2 THEN 12 WHEN share <= 10 THEN 13 WHEN share <= 30 THEN 14 WHEN share <= 60 THEN 15 ELSE 16 END AS zoom FROM (SELECT id, rank, (rank - 1) * 100.0 / count(*) OVER () AS share FROM (SELECT id, row_number() OVER (ORDER BY max(confidence) DESC NULLS LAST, id) AS rank FROM overture GROUP BY id))")
def rank_zoom_bands(spark: SparkSession, d: str) -> DataFrame:
    """Places ranked by confidence, and the zoom level from which each is shown."""
    each = table(spark, d, "overture").groupBy("id").agg(F.max("confidence").alias("confidence"))
    r = ranked(each, "confidence", "id")
    n = each.count()
    return r.select("id", "rank", zoom_band(F.col("rank"), F.lit(n)).alias("zoom"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders) WHERE n = 1")
def latest_winner(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "orders"), ["o_custkey"], "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT id, phone, release FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC, release DESC) AS n FROM overture) WHERE n = 1")
def newest_delivery(spark: SparkSession, d: str) -> DataFrame:
    """One row an id: the one that was delivered last."""
    return keep_first(table(spark, d, "overture"), "id", F.desc("loaded_at"), F.desc("release")).select("id", "phone", "release")


@query("""
WITH n AS (SELECT id, min(name) AS name FROM overture WHERE release = (SELECT max(release) FROM overture) GROUP BY id), o AS (SELECT id, min(name) AS name FROM overture WHERE release <> (SELECT max(release) FROM overture) GROUP BY id)
SELECT id, name, 'new' AS layer FROM n UNION ALL SELECT id, name, 'old' FROM o WHERE id NOT IN (SELECT id FROM n)""")
def union_newest_wins(spark: SparkSession, d: str) -> DataFrame:
    """A release over the one before: its ids hide the older rows."""
    o = table(spark, d, "overture")
    last = o.agg(F.max("release")).first()[0]
    new, old = (o.where(c).groupBy("id").agg(F.min("name").alias("name")).withColumn("layer", F.lit(n)) for c, n in ((F.col("release") == last, "new"), (F.col("release") != last, "old")))
    return newest_wins([new, old], "id")


@query("""
WITH d AS (SELECT DISTINCT user_id, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS h FROM events WHERE ts IS NOT NULL),
r AS (SELECT *, h - row_number() OVER (PARTITION BY user_id ORDER BY h) AS g FROM d)
SELECT user_id, min(h) AS begins, max(h) AS ends, count(*) AS length FROM r GROUP BY user_id, g""")
def consecutive_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs of following hours in which a user was active."""
    e = table(spark, d, "events").where("ts is not null").select("user_id", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000).cast("long").alias("h"))
    return runs(e, ["user_id"], "h")


@query("""
WITH v AS (SELECT o_orderpriority, o_totalprice, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) - 1 AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders WHERE o_totalprice IS NOT NULL)
SELECT o_orderpriority, max(CASE WHEN i = least(n - 1, floor(n * 0.5)) THEN o_totalprice END) AS p50, max(CASE WHEN i = least(n - 1, floor(n * 0.95)) THEN o_totalprice END) AS p95 FROM v GROUP BY o_orderpriority""")
def nearest_rank_quantiles(spark: SparkSession, d: str) -> DataFrame:
    return exact_quantiles(table(spark, d, "orders"), ["o_orderpriority"], "o_totalprice", {"p50": 0.5, "p95": 0.95})


@query("SELECT l_orderkey, list_sort(list(l_quantity))[CAST(least(count(*) - 1, floor(count(*) * 0.5)) AS INTEGER) + 1] AS middle FROM lineitem GROUP BY l_orderkey")
def nearest_rank_in_array(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_quantity").alias("q")).select("l_orderkey", nearest_rank(F.col("q"), 0.5).alias("middle"))


_STARS = """
WITH b AS (SELECT l_partkey, count(*) FILTER (l_quantity > 40) AS e, count(*) FILTER (l_quantity > 30 AND l_quantity <= 40) AS v, count(*) FILTER (l_quantity > 20 AND l_quantity <= 30) AS a, count(*) FILTER (l_quantity > 10 AND l_quantity <= 20) AS p, count(*) FILTER (l_quantity <= 10) AS t FROM lineitem GROUP BY l_partkey),
g AS (SELECT sum(5 * e + 4 * v + 3 * a + 2 * p + t)::DOUBLE / sum(e + v + a + p + t) AS prior FROM b)
"""


def stars(spark: SparkSession, d: str) -> tuple[DataFrame, float]:
    """Star counts (best first) of each part, banded from quantities, and their mean over all."""
    q = F.col("l_quantity")
    band = [q > 40, (q > 30) & (q <= 40), (q > 20) & (q <= 30), (q > 10) & (q <= 20), q <= 10]
    s = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.array(*(F.count_if(F.coalesce(b, F.lit(False))) for b in band)).alias("stars"))
    total = sum((F.col("stars")[i] * (5 - i) for i in range(1, 5)), F.col("stars")[0] * 5)
    n = sum((F.col("stars")[i] for i in range(1, 5)), F.col("stars")[0])
    return s, s.agg((F.sum(total).cast("double") / F.sum(n)).alias("prior")).first()[0]


@query(_STARS + "SELECT l_partkey, round((10 * prior + 5 * e + 4 * v + 3 * a + 2 * p + t) / (10 + e + v + a + p + t), 3) AS bayes FROM b, g")
def bayes_ratings(spark: SparkSession, d: str) -> DataFrame:
    s, prior = stars(spark, d)
    return s.select("l_partkey", bayes_rating(F.col("stars"), F.lit(prior)).alias("bayes"))


@query(_STARS + """
SELECT l_partkey, round((e + v)::DOUBLE / n, 6) AS share, CASE WHEN n < 5 THEN n::VARCHAR WHEN n < 20 THEN '~' || (floor(n / 5.0 + 0.5) * 5)::BIGINT WHEN n < 100 THEN '~' || (floor(n / 10.0 + 0.5) * 10)::BIGINT ELSE '~' || (floor(n / 50.0 + 0.5) * 50)::BIGINT END AS reviews,
round((10 * prior + 5 * e + 4 * v + 3 * a + 2 * p + t) / (10 + n), 3) >= 4.0 AND n >= 5 AS recommended FROM (SELECT *, e + v + a + p + t AS n FROM b, g)""")
def positive_shares(spark: SparkSession, d: str) -> DataFrame:
    s, prior = stars(spark, d)
    n = sum((F.col("stars")[i] for i in range(1, 5)), F.col("stars")[0])
    return s.select("l_partkey", F.round(positive_share(F.col("stars")), 6).alias("share"), review_band(n).alias("reviews"), recommended(bayes_rating(F.col("stars"), F.lit(prior)), n).alias("recommended"))


@query("""
SELECT area_id, count(*) AS total, count(*) FILTER (sources = ['fsa']) AS fsa_only, count(*) FILTER (sources = ['osm']) AS osm_only, count(*) FILTER (opening_hours_osm IS NOT NULL AND trim(opening_hours_osm) <> '') AS with_hours, count(*) FILTER (lat IS NULL) AS unplaced,
round(count(*) FILTER (sources = ['osm'] AND opening_hours_osm IS NOT NULL)::DOUBLE / nullif(count(*) FILTER (sources = ['osm']), 0), 3) AS osm_hours_rate FROM verify_positions GROUP BY area_id""")
def conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts of an area's records by source and content in one pass."""
    only = lambda s: F.coalesce(F.col("sources") == F.array(F.lit(s)), F.lit(False))
    filled = F.coalesce(F.trim("opening_hours_osm"), F.lit("")) != ""
    n = F.count_if(only("osm"))
    return table(spark, d, "verify_positions").groupBy("area_id").agg(
        F.count("*").alias("total"), F.count_if(only("fsa")).alias("fsa_only"), n.alias("osm_only"), F.count_if(filled).alias("with_hours"), F.count_if(F.col("lat").isNull()).alias("unplaced"),
        F.round(F.try_divide(F.count_if(only("osm") & F.col("opening_hours_osm").isNotNull()).cast("double"), n), 3).alias("osm_hours_rate"),
    )


@query(r"""
SELECT street, count(DISTINCT hn) AS numbers FROM (SELECT trim(regexp_replace(split_part(regexp_replace(lower(coalesce(address, '')), '^\s*\d+[a-z]?(\s*-\s*\d+[a-z]?)?[ ,]*', ''), ',', 1), '\s+\d+\s?[a-z]?\s*$', '')) AS street, nullif(lower(regexp_extract(coalesce(address, ''), '^\s*(\d+[A-Za-z]?)', 1)), '') AS hn FROM verify_positions) WHERE hn IS NOT NULL AND street <> '' GROUP BY street""")
def street_density(spark: SparkSession, d: str) -> DataFrame:
    """Distinct house numbers of each street."""
    from placeloom.functions.text import house_number, street_key

    v = table(spark, d, "verify_positions").select(street_key("address").alias("street"), house_number("address", False).alias("hn"))
    return v.where("hn is not null and street <> ''").groupBy("street").agg(F.count_distinct("hn").alias("numbers"))


@query("SELECT s AS source, count(*) AS rows, count(DISTINCT id) AS ids, min(seen_at) AS first_seen, max(seen_at) AS last_seen FROM (SELECT id, seen_at, unnest(sources) AS s FROM verify_positions) GROUP BY s")
def source_tallies(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "verify_positions").select("id", "seen_at", F.explode("sources").alias("source"))
    return v.groupBy("source").agg(F.count("*").alias("rows"), F.count_distinct("id").alias("ids"), F.min("seen_at").alias("first_seen"), F.max("seen_at").alias("last_seen"))


@query("SELECT area_id, min(lng) AS w, min(lat) AS s, max(lng) AS e, max(lat) AS n FROM verify_positions WHERE lat IS NOT NULL AND lng IS NOT NULL GROUP BY area_id")
def bounds(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "verify_positions").where("lat is not null and lng is not null")
    return v.groupBy("area_id").agg(F.min("lng").alias("w"), F.min("lat").alias("s"), F.max("lng").alias("e"), F.max("lat").alias("n"))


@query("""
WITH o AS (SELECT DISTINCT name FROM overture WHERE name IS NOT NULL), s AS (SELECT DISTINCT name FROM crawl_sites WHERE name IS NOT NULL)
SELECT (SELECT count(*) FROM o) AS ours, (SELECT count(*) FROM s) AS theirs, (SELECT count(*) FROM o JOIN s USING (name)) AS both_names, (SELECT count(*) FROM (SELECT name FROM o UNION SELECT name FROM s)) AS either,
round((SELECT count(*) FROM o JOIN s USING (name))::DOUBLE / (SELECT count(*) FROM s), 4) AS rate""")
def coverage_report(spark: SparkSession, d: str) -> DataFrame:
    """Names of two sources: how many, shared, together, and the share covered, in one aggregation."""
    side = lambda t, n: table(spark, d, t).where("name is not null").select("name", F.lit(n).alias("src"))
    each = side("overture", 1).union(side("crawl_sites", 2)).groupBy("name").agg(F.max(F.col("src") == 1).alias("o"), F.max(F.col("src") == 2).alias("s"))
    both = F.count_if(F.col("o") & F.col("s"))
    return each.agg(F.count_if("o").alias("ours"), F.count_if("s").alias("theirs"), both.alias("both_names"), F.count("*").alias("either"), F.round(both.cast("double") / F.count_if("s"), 4).alias("rate"))


@query("""
WITH c AS (SELECT id, list_distinct(list_transform(string_split(coalesce(cuisine, ''), ';'), lambda x: trim(x))) AS ours, list_distinct([lower(category), 'grill']) AS theirs FROM (SELECT id, min(cuisine) AS cuisine, min(category) AS category FROM verify_positions GROUP BY id))
SELECT id, CASE WHEN len(list_intersect(ours, theirs)) = len(theirs) THEN 'agree' WHEN len(list_intersect(ours, theirs)) = 0 THEN 'conflict' ELSE 'extend' END AS verdict FROM c""")
def list_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Whether one list agrees with, extends or contradicts another."""
    c = table(spark, d, "verify_positions").groupBy("id").agg(F.min("cuisine").alias("cuisine"), F.min("category").alias("category"))
    ours = F.array_distinct(F.transform(F.split(F.coalesce("cuisine", F.lit("")), ";"), F.trim))
    return c.select("id", list_verdict(ours, F.array_distinct(F.array(F.lower("category"), F.lit("grill")))).alias("verdict"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())")
def rollup_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("SELECT a.id FROM (SELECT id FROM overture INTERSECT SELECT id FROM overture WHERE release = (SELECT min(release) FROM overture)) a ANTI JOIN (SELECT id FROM overture WHERE release <> (SELECT min(release) FROM overture)) b ON a.id = b.id")
def key_sets(spark: SparkSession, d: str) -> DataFrame:
    """Ids of the oldest release that no other has, by set operations."""
    o = table(spark, d, "overture")
    first = o.agg(F.min("release")).first()[0]
    new = o.where(F.col("release") == first).select("id")
    return o.select("id").intersect(new).subtract(o.where(F.col("release") != first).select("id"))
