"""Match cascades, hosts, ledgers and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeloom.functions.scores import current_name, latest_state
from placeloom.operators import cascade
from placeloom.operators.premises import at_premises
from placeloom.operators.ranking import difference, keep_first, ranked
from placeloom.operators.spatial import attach_host, best_each, within
from placeloom.functions.geo import planar_m
from placeloom.plans.cut import cut_table
from placeloom.queries import query, table
from placeloom.queries import sqltext as Q

_FOOD = ("restaurant", "cafe", "pub")
_RECORDS = r"""
rec AS (SELECT *, sources[1] AS source, coalesce(fsa_id, TRY_CAST(nullif(regexp_extract(osm_fhrs_id, '^\s*0*([0-9]{1,18})\s*$', 1), '') AS BIGINT)) AS number
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at) AS nth FROM verify_positions) WHERE nth = 1)"""
_NEAR = "abs(l.lat - r.lat) < 0.01 AND abs(l.lng - r.lng) < 0.02"
_D = "sqrt(((l.lat - r.lat) * 111320) * ((l.lat - r.lat) * 111320) + ((l.lng - r.lng) * 62500) * ((l.lng - r.lng) * 62500))"
_CODE = f"coalesce({Q.code('l.postcode')} = {Q.code('r.postcode')}, false)"
_PAGE = f"coalesce({Q.page('l.website')} = {Q.page('r.website')}, false)"
_NS = Q.score("l.name", "r.name")


def _records(spark: SparkSession, d: str) -> DataFrame:
    number = F.coalesce("fsa_id", F.regexp_extract("osm_fhrs_id", r"^\s*0*(\d{1,18})\s*$", 1).try_cast("bigint"))
    v = keep_first(table(spark, d, "verify_positions"), "id", F.asc("loaded_at")).withColumn("source", F.get("sources", F.lit(0))).withColumn("number", number)
    return v.select("id", "name", "category", "lat", "lng", "address", "postcode", "phone", "website", "source", "number")


def _register_pairs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, list[cascade.Step]]:
    r = _records(spark, d)
    veto = F.col("l_category").isin(*_FOOD) != F.col("r_category").isin(*_FOOD)
    left, right = (cascade.read(r.where(f"source = '{s}'").drop("website"), "category", "number") for s in ("fsa", "osm"))
    return left, right, cascade.register_steps(veto)


@query(f"""
WITH {_RECORDS},
p AS (SELECT l.id AS fsa, r.id AS osm, {_D} AS d, {_CODE} AS code, coalesce(l.number = r.number, false) AS linked, coalesce((l.category IN ({Q.quoted(_FOOD)})) <> (r.category IN ({Q.quoted(_FOOD)})), false) AS veto, {_NS} AS ns FROM rec l JOIN rec r ON {_NEAR} WHERE l.source = 'fsa' AND r.source = 'osm' AND {_D} <= 150)
SELECT fsa, osm, CASE WHEN linked THEN 'number' ELSE 'name' END AS method, round(CASE WHEN linked THEN 2.0 ELSE ns END + CASE WHEN code THEN 0.3 ELSE 0 END + CASE WHEN d < 50 THEN 0.1 ELSE 0 END, 6) AS score
FROM p WHERE linked OR (NOT veto AND (ns >= 0.5 OR (ns >= 0.34 AND (d < 60 OR code))))""")
def register_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Register and map records within 150 m that can be one, by number or name, with their scores."""
    left, right, steps = _register_pairs(spark, d)
    return cascade.graded(within(left, right, 150), steps).select(F.col("l_id").alias("fsa"), F.col("r_id").alias("osm"), "method", F.round("score", 6).alias("score"))


@query(f"""
WITH RECURSIVE {_RECORDS},
near AS (SELECT l.id AS fsa, r.id AS osm, {_D} AS d, {_CODE} AS code, coalesce(l.number = r.number, false) AS linked, coalesce((l.category IN ({Q.quoted(_FOOD)})) <> (r.category IN ({Q.quoted(_FOOD)})), false) AS veto, {_NS} AS ns FROM rec l JOIN rec r ON {_NEAR} WHERE l.source = 'fsa' AND r.source = 'osm' AND {_D} <= 150),
p AS (SELECT fsa, osm, d, CASE WHEN linked THEN 'number' ELSE 'name' END AS method, CASE WHEN linked THEN 2.0 ELSE ns END + CASE WHEN code THEN 0.3 ELSE 0 END + CASE WHEN d < 50 THEN 0.1 ELSE 0 END AS score FROM near WHERE linked OR (NOT veto AND (ns >= 0.5 OR (ns >= 0.34 AND (d < 60 OR code))))),
n AS (SELECT *, row_number() OVER (ORDER BY fsa, score DESC, osm) AS n FROM p),
g AS (SELECT 0::BIGINT AS n, []::VARCHAR[] AS ls, []::VARCHAR[] AS rs, NULL::VARCHAR AS fsa
  UNION ALL SELECT g.n + 1, CASE WHEN list_contains(ls, n.fsa) OR list_contains(rs, n.osm) THEN ls ELSE list_append(ls, n.fsa) END, CASE WHEN list_contains(ls, n.fsa) OR list_contains(rs, n.osm) THEN rs ELSE list_append(rs, n.osm) END,
  CASE WHEN list_contains(ls, n.fsa) OR list_contains(rs, n.osm) THEN NULL ELSE n.fsa END FROM g JOIN n ON n.n = g.n + 1),
t AS (SELECT n.* FROM g JOIN n USING (n) WHERE g.fsa IS NOT NULL),
c AS (SELECT fsa, count(*) AS candidates FROM near GROUP BY fsa)
SELECT rec.id AS fsa, t.osm, t.method, round(t.score, 2) AS score, round(t.d) AS dist_m, coalesce(c.candidates, 0) AS candidates FROM rec LEFT JOIN t ON t.fsa = rec.id LEFT JOIN c ON c.fsa = rec.id WHERE rec.source = 'fsa'
UNION ALL SELECT NULL, id, NULL, NULL, NULL, NULL FROM rec WHERE source = 'osm' AND id NOT IN (SELECT osm FROM t)""")
def register_merged(spark: SparkSession, d: str) -> DataFrame:
    """The register with the map record each row takes in its order, and the map records left over."""
    left, right, steps = _register_pairs(spark, d)
    return cascade.merged_one_to_one(left, right, 150, steps, mode="in_order").select(F.col("l_id").alias("fsa"), F.col("r_id").alias("osm"), "method", F.round("score", 2).alias("score"), F.round("dist_m").alias("dist_m"), "candidates")


_CHAIN_NS = f"greatest({_NS}, {Q.score('l.name', 'r.name')})"


@query(f"""
WITH {_RECORDS},
p AS (SELECT l.id AS place, r.id AS feature, {_D} AS d, {_CODE} AS code, coalesce(l.number = r.number, false) AS linked, {_PAGE} AS page, {Q.normal('l.name')} = {Q.normal('r.name')} AND length({Q.normal('r.name')}) >= 6 AS same, {Q.gate('l.name', 'r.name')} AS gate, {_NS} AS ns FROM rec l JOIN rec r ON {_NEAR} WHERE l.source IN ('fsa', 'osm') AND r.source IN ('atp', 'servicemap', 'nhs') AND {_D} <= 500),
m AS (SELECT *, CASE WHEN linked THEN 'identifier' WHEN page THEN 'page' WHEN d <= CASE WHEN code THEN 250 ELSE 120 END AND same AND (code OR d < 60) THEN 'exact' WHEN d <= CASE WHEN code THEN 250 ELSE 120 END AND gate = 'yes' AND (ns >= 0.5 OR (ns >= 0.34 AND (d < 60 OR code))) THEN 'name' END AS method FROM p),
s AS (SELECT *, CASE method WHEN 'identifier' THEN 2.5 - d / 1e5 WHEN 'page' THEN 1.8 WHEN 'exact' THEN 2.0 - d / 1e5 ELSE ns + CASE WHEN code THEN 0.3 ELSE 0 END END AS score FROM m WHERE method IS NOT NULL)
SELECT place, feature, method, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, feature) AS n FROM s) WHERE n = 1""")
def chain_cascade(spark: SparkSession, d: str) -> DataFrame:
    """For each register or map record the best record of a chain's or a public list within 500 m: identifier, page, exact name, brand, initials."""
    r = _records(spark, d)
    lists = r.where("source in ('atp', 'servicemap', 'nhs')").withColumn("brand", F.col("name"))
    pairs = cascade.graded(within(r.where("source in ('fsa', 'osm')"), lists, 500), cascade.chain_steps("number"))
    return best_each(pairs, "l_id", F.desc("score"), F.asc("r_id")).select(F.col("l_id").alias("place"), F.col("r_id").alias("feature"), "method", F.round("score", 6).alias("score"))


@query(f"""
WITH {_RECORDS},
o AS (SELECT * FROM (SELECT id, name, lon AS lng, lat, postcode, website, confidence, datasets, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC, release DESC) AS nth FROM overture) WHERE nth = 1 AND lat IS NOT NULL AND lng IS NOT NULL),
p AS (SELECT l.id AS place, r.id AS overture_id, r.confidence, {_D} AS d, {_CODE} AS code, {_PAGE} AS page, coalesce(list_contains(r.datasets, 'meta'), false) AS meta, {_NS} AS ns, {Q.accepted('l.name', 'r.name', _NS, _D, _CODE)} AS ok FROM rec l JOIN o r ON {_NEAR} WHERE {_D} <= 500),
s AS (SELECT *, CASE WHEN page THEN 'page' ELSE 'name' END AS method, CASE WHEN page THEN 1.8 ELSE ns + CASE WHEN code THEN 0.3 ELSE 0 END + CASE WHEN meta THEN 0.15 ELSE 0 END END AS score FROM p WHERE page OR (d <= CASE WHEN code THEN 250 ELSE 120 END AND ok))
SELECT place, overture_id, method, round(score, 6) AS score, coalesce((method = 'page' OR (score >= 0.8 AND d < 60)) AND confidence >= 0.99, false) AS strong FROM (SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, overture_id) AS n FROM s) WHERE n = 1""")
def release_backfill(spark: SparkSession, d: str) -> DataFrame:
    """For each record the release row that may fill its gaps, and whether that row confirms the place."""
    o = keep_first(table(spark, d, "overture"), "id", F.desc("loaded_at"), F.desc("release")).select("id", "name", "lat", F.col("lon").alias("lng"), "postcode", "website", "confidence", "datasets")
    left, right = cut_table(cascade.read(_records(spark, d))), cut_table(cascade.read(o.withColumn("meta", F.array_contains("datasets", "meta")), "confidence", "meta"))
    pairs = cascade.graded(cascade.release_pairs(left, right), cascade.release_steps(F.col("r_meta")))
    best = best_each(pairs, "l_id", F.desc("score"), F.asc("r_id"))
    strong = cascade.strong_agreement(F.col("method"), F.col("score"), F.col("dist_m"), F.col("r_confidence"))
    return best.select(F.col("l_id").alias("place"), F.col("r_id").alias("overture_id"), "method", F.round("score", 6).alias("score"), strong.alias("strong"))


@query(f"""
WITH {_RECORDS},
p AS (SELECT l.id AS place, r.id AS feature, {_D} AS d, {_CODE} AS code, {Q.gate('l.name', 'r.name')} AS gate, {_NS} AS ns FROM rec l JOIN rec r ON {_NEAR} WHERE l.source = 'osm' AND r.source = 'fsa' AND (l.category = r.category OR l.category IN ({Q.quoted(_FOOD)})) AND {_D} <= CASE WHEN r.category IN ({Q.quoted(_FOOD)}) THEN 500 ELSE 120 END AND (r.category IN ({Q.quoted(_FOOD)}) OR {_CODE})),
s AS (SELECT *, ns + CASE WHEN code THEN 0.3 ELSE 0 END AS score FROM p WHERE gate = 'yes' AND (ns >= 0.5 OR (ns >= 0.34 AND (d < 60 OR code))))
SELECT place, feature, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, feature) AS n FROM s) WHERE n = 1""")
def rows_with_own_rules(spark: SparkSession, d: str) -> DataFrame:
    """For each map record the best row of a list whose rows say what they may join: categories, reach, postcode or not."""
    r = _records(spark, d)
    food = F.coalesce(F.col("category").isin(*_FOOD), F.lit(False))
    rows = r.where("source = 'fsa'").withColumn("kinds", F.array_compact(F.array(F.col("category"), *map(F.lit, _FOOD)))).withColumn("reach", F.when(food, 500).otherwise(120)).withColumn("strict", ~food)
    left, right = cascade.read(r.where("source = 'osm'"), "category"), cascade.read(rows, "kinds", "reach", "strict")
    pairs = cascade.graded(cascade.row_pairs(left, right, 500), cascade.row_steps())
    return best_each(pairs, "l_id", F.desc("score"), F.asc("r_id")).select(F.col("l_id").alias("place"), F.col("r_id").alias("feature"), F.round("score", 6).alias("score"))


@query(f"""
WITH {_RECORDS},
k AS (SELECT id, name, source, {Q.code('postcode')} AS pc, {Q.number('address')} AS hn FROM rec),
h AS (SELECT pc, hn, min(id) AS host FROM k WHERE source = 'osm' AND pc IS NOT NULL AND hn IS NOT NULL GROUP BY pc, hn HAVING count(*) = 1),
g AS (SELECT k.id, k.name, CASE WHEN k.source = 'fsa' THEN h.host END AS hosted_in FROM k LEFT JOIN h USING (pc, hn)),
c AS (SELECT hosted_in AS id, list_sort(list(id)) AS hosted FROM g WHERE hosted_in IS NOT NULL GROUP BY hosted_in)
SELECT g.id, g.name, h.id AS host_id, h.name AS host_name, c.hosted FROM g LEFT JOIN g h ON h.id = g.hosted_in LEFT JOIN c ON c.id = g.id""")
def records_with_hosts(spark: SparkSession, d: str) -> DataFrame:
    """Every record with the map record that holds it, and with those it holds."""
    r = at_premises(_records(spark, d)).select("id", "name", "source", "pc", "hn")
    hosted = attach_host(r.where("source = 'fsa'"), r.where("source = 'osm'"), ["pc", "hn"], "id").select("id", "name", "hosted_in")
    rest = r.where("source <> 'fsa' or source is null").select("id", "name", F.lit(None).cast("string").alias("hosted_in"))
    out = cascade.with_hosts(hosted.unionByName(rest))
    return out.select("id", "name", F.col("host.id").alias("host_id"), F.col("host.name").alias("host_name"), F.transform("hosted", lambda h: h["id"]).alias("hosted"))


@query(f"""
WITH {_RECORDS}
SELECT {Q.code('postcode')} AS pc, {Q.number('address')} AS hn, count(*) AS companies FROM rec WHERE source = 'ch' AND {Q.code('postcode')} IS NOT NULL GROUP BY ALL""")
def companies_per_address(spark: SparkSession, d: str) -> DataFrame:
    """How many companies are registered at one address."""
    return at_premises(_records(spark, d).where("source = 'ch'")).where("pc is not null").groupBy("pc", "hn").agg(F.count("*").alias("companies"))


_CRAWL = "SELECT *, CASE WHEN website IS NULL OR trim(website) = '' THEN 'no website' WHEN fetch_ok IS NULL THEN 'not fetched' WHEN NOT fetch_ok THEN 'failed' WHEN name_on_page IS NULL THEN 'name unknown' WHEN name_on_page THEN 'named' ELSE 'other name' END AS status FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at) AS nth FROM crawl_sites) WHERE nth = 1"


def _crawl(spark: SparkSession, d: str) -> DataFrame:
    s = keep_first(table(spark, d, "crawl_sites"), "id", F.asc("loaded_at"))
    blank = F.coalesce(F.trim("website"), F.lit("")) == ""
    status = F.when(blank, "no website").when(F.col("fetch_ok").isNull(), "not fetched").when(~F.col("fetch_ok"), "failed").when(F.col("name_on_page").isNull(), "name unknown").when(F.col("name_on_page"), "named").otherwise("other name")
    return s.withColumn("status", status)


@query(f"WITH c AS ({_CRAWL}) SELECT status, count(*) AS sites, sum(count(*) FILTER (WHERE status IN ('failed', 'not fetched'))) OVER () = 0 AS complete FROM c GROUP BY status")
def ledger_counts(spark: SparkSession, d: str) -> DataFrame:
    """Sites by what became of them, and whether none is left to fetch."""
    counts = _crawl(spark, d).groupBy("status").agg(F.count("*").alias("sites"))
    left = counts.agg(F.coalesce(F.sum(F.when(F.col("status").isin("failed", "not fetched"), F.col("sites"))), F.lit(0)).alias("left"))
    return counts.crossJoin(F.broadcast(left)).select("status", "sites", (F.col("left") == 0).alias("complete"))


@query(f"WITH c AS ({_CRAWL}) SELECT count(*) AS sites, count(*) FILTER (WHERE status IN ('no website', 'not fetched')) AS skipped, count(*) FILTER (WHERE fetch_ok) AS fetched, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'named') AS named, count(DISTINCT {Q.code('postcode')}) AS postcodes, max(crawled_at) AS latest FROM c")
def crawl_counters(spark: SparkSession, d: str) -> DataFrame:
    """One row of counters over the crawl."""
    n = lambda c: F.count(F.when(c, 1))
    s = F.col("status")
    return at_premises(_crawl(spark, d).withColumn("address", F.lit(None).cast("string"))).agg(F.count("*").alias("sites"), n(s.isin("no website", "not fetched")).alias("skipped"), n(F.col("fetch_ok")).alias("fetched"), n(s == "failed").alias("failed"), n(s == "named").alias("named"), F.count_distinct("pc").alias("postcodes"), F.max("crawled_at").alias("latest"))


@query("""
WITH e AS (SELECT id, max(confidence) AS confidence, bool_or(lat IS NOT NULL AND lon IS NOT NULL) AS drawable FROM overture GROUP BY id)
SELECT id, drawable, row_number() OVER (ORDER BY drawable DESC, CASE WHEN drawable THEN confidence END DESC NULLS LAST, id) AS rank FROM e""")
def hidden_after_drawable(spark: SparkSession, d: str) -> DataFrame:
    """Places ranked by confidence; those without a position follow after all others, in the order of their ids."""
    e = table(spark, d, "overture").groupBy("id").agg(F.max("confidence").alias("confidence"), F.bool_or(F.col("lat").isNotNull() & F.col("lon").isNotNull()).alias("drawable"))
    # Drawable rows have a score of 0 or more, or none at all, which still comes before those that are hidden.
    score = F.when(F.col("drawable"), F.coalesce("confidence", F.lit(-1.0))).otherwise(-2.0)
    return ranked(e.withColumn("score", score), "score", "id").select("id", "drawable", "rank")


@query("""
WITH d AS (SELECT id, min(struct_pack(r := release, lat := lat, lon := lon)) AS a, max(struct_pack(r := release, lat := lat, lon := lon)) AS b FROM overture WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY id HAVING count(DISTINCT release) > 1),
x AS (SELECT id, sqrt(((a.lat - b.lat) * 111320) * ((a.lat - b.lat) * 111320) + ((a.lon - b.lon) * 62500) * ((a.lon - b.lon) * 62500)) AS m FROM d)
SELECT id, round(m) AS metres, row_number() OVER (ORDER BY round(m) DESC, id) AS place FROM x""")
def moved_farthest_first(spark: SparkSession, d: str) -> DataFrame:
    """Places of more than one release by how far they moved between the first and the last, farthest first."""
    at = F.struct(F.col("release").alias("r"), "lat", "lon")
    d_ = table(spark, d, "overture").where("lat is not null and lon is not null").groupBy("id").agg(F.min(at).alias("a"), F.max(at).alias("b")).where("a.r <> b.r")
    metres = F.round(planar_m(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon")))
    return ranked(d_.select("id", metres.alias("metres")), "metres", "id", rank="place").select("id", "metres", "place")


@query(r"SELECT id, name, row_number() OVER (ORDER BY hash_key, id) AS place FROM (SELECT id, min(name) AS name, lower(coalesce(min(name), '')) AS hash_key FROM crawl_sites GROUP BY id)")
def base_order(spark: SparkSession, d: str) -> DataFrame:
    """Sites in the order of their names, as a file of them is written: small letters by code point, then the id."""
    s = table(spark, d, "crawl_sites").groupBy("id").agg(F.min("name").alias("name")).withColumn("key", F.lower(F.coalesce("name", F.lit(""))))
    return ranked(s, "key", "id", rank="place", ascending=True).select("id", "name", "place")


@query("""
WITH e AS (SELECT o_custkey, list(o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS states, list(struct_pack(n := o_orderpriority, e := CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) ORDER BY o_orderdate, o_orderkey) AS names FROM orders GROUP BY o_custkey)
SELECT o_custkey, CASE WHEN list_contains(states, 'F') THEN 'ceased' WHEN list_contains(states, 'O') THEN 'registered' ELSE 'unknown' END AS state, coalesce(list_filter(names, lambda x: x.e IS NULL)[-1].n, names[-1].n) AS name FROM e""")
def latest_states(spark: SparkSession, d: str) -> DataFrame:
    """State and current name out of a history: orders stand for the entries of a register, priorities for names that end when an order is filled."""
    e = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey", F.col("o_orderstatus").alias("text"), F.col("o_orderpriority").alias("name"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("ends")))).alias("entries")
    )
    return e.select("o_custkey", latest_state(F.col("entries"), {"ceased": ("F",), "registered": ("O",)}).alias("state"), current_name(F.col("entries")).alias("name"))
