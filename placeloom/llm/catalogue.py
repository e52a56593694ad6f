"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeloom.llm import addresses, leakage, matching, names, repetition, survivorship, tokenization


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _registered(spark: SparkSession, d: str) -> DataFrame:
    """verify_positions with the register number of each record and its one source."""
    typed = F.regexp_extract("osm_fhrs_id", r"^\s*0*(\d{1,18})\s*$", 1).try_cast("bigint")
    return table(spark, d, "verify_positions").withColumn("number", F.coalesce("fsa_id", typed)).withColumn("source", F.get("sources", F.lit(0)))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """The record whose phone, website and hours survive; the trust table holds as it is, so that the most trusted claim wins."""
    out = survivorship.survivors(_registered(spark, d), table(spark, d, "source_trust"), "number", strength=None, vote="max")
    return out.select(F.col("group_key").alias("fsa_id"), "field", "winner_id")


#: Rounds of truth discovery in p2_fused; its SQL has as many.
FUSION_ROUNDS = 6


def p2_fused(spark: SparkSession, d: str) -> DataFrame:
    """The same groups with reliabilities learnt from agreement, and values chosen by the sum of their sources' votes."""
    out = survivorship.survivors(_registered(spark, d), table(spark, d, "source_trust"), "number", rounds=FUSION_ROUNDS, tolerance=0.0)
    return out.select(F.col("group_key").alias("fsa_id"), "field", "value", "winner_id", F.round("support", 4).alias("support"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Records at one location, by address and postcode alone; towns are learnt from them."""
    return addresses.pairs(addresses.same_premises(table(spark, d, "verify_positions"), area=None), "location")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    entities = names.link_names(table(spark, d, "aliases"), "alias_id", "registered_name", "alias_name")
    return addresses.pairs(entities, "entity").toDF("alias_id_a", "alias_id_b")


def _sites(spark: SparkSession, d: str, once: bool) -> DataFrame:
    towns = table(spark, d, "areas").select(F.element_at(F.split("area_id", "/"), -1))
    return matching.match(table(spark, d, "overture"), table(spark, d, "crawl_sites"), towns=towns, left_once=once)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """A site has one place, a place may have several sites."""
    return _sites(spark, d, False).select(F.col("left_id").alias("overture_id"), F.col("right_id").alias("site_id"))


def p5_confidence(spark: SparkSession, d: str) -> DataFrame:
    """The one-to-one matching with its marginals."""
    return _sites(spark, d, True).select(F.col("left_id").alias("overture_id"), F.col("right_id").alias("site_id"), F.round("p", 4).alias("p"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenization.encode(table(spark, d, "documents"))


def p6_decoded(spark: SparkSession, d: str) -> DataFrame:
    """The texts again, decoded from their ids."""
    return tokenization.decode(tokenization.encode(table(spark, d, "documents")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id").distinct()


def p7_scrubbed(spark: SparkSession, d: str) -> DataFrame:
    """Documents that lost a leaked passage, without it."""
    docs = table(spark, d, "documents")
    found = leakage.leaks(docs, table(spark, d, "eval_items"))
    return leakage.scrub(docs.select("doc_id", "text"), found).where("removed > 0")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetition(table(spark, d, "documents"), limit=0.30).select("doc_id")


def p8_share(spark: SparkSession, d: str) -> DataFrame:
    """The share of every document."""
    out = repetition.repetition(table(spark, d, "documents"), cascade=False)
    return out.select("doc_id", F.round("share", 6).alias("share"))


QUERIES = {f.__name__: f for f in (p2_found, p2_fused, p3_found, p4_found, p5_found, p5_confidence, p6_ids, p6_decoded, p7_found, p7_scrubbed, p8_found, p8_share)}

_SHARES = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '\p{L}+') AS ws FROM documents WHERE text IS NOT NULL),
g AS (SELECT doc_id, i, ws[i:i + 4] AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, gram ORDER BY i) AS nth FROM g),
l AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM r WHERE nth > 1) GROUP BY doc_id),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN 0.0::DOUBLE ELSE coalesce(n, 0)::DOUBLE / len(ws) END AS share FROM w LEFT JOIN l USING (doc_id))
"""

_CLAIMS = r"""
WITH r AS (SELECT *, coalesce(sources[1], '') AS source, coalesce(fsa_id, TRY_CAST(nullif(regexp_extract(osm_fhrs_id, '^\s*0*([0-9]{1,18})\s*$', 1), '') AS BIGINT)) AS number FROM verify_positions),
g AS (SELECT number FROM r WHERE number IS NOT NULL GROUP BY number HAVING count(DISTINCT id) >= 2),
c AS (
  SELECT number, 'phone' AS field, id, source, seen_at, phone AS raw, regexp_replace(regexp_replace(regexp_replace(phone, '\(0\)', '', 'g'), '[^0-9+]', '', 'g'), '^(\+|00)(44|358)0?|^0', '') AS value FROM r WHERE number IS NOT NULL AND length(regexp_replace(phone, '[^0-9]', '', 'g')) >= 9 AND regexp_matches(phone, '[1-9]')
  UNION ALL SELECT number, 'website', id, source, seen_at, website, regexp_replace(regexp_replace(lower(trim(website)), '^(https?://)?(www\.)?', ''), '[?#].*$|/+$', '', 'g') FROM r WHERE number IS NOT NULL AND regexp_matches(lower(trim(website)), '^(https?://)?(www\.)?[a-z0-9][a-z0-9-]*(\.[a-z0-9-]+)*\.[a-z]{2,}(:[0-9]+)?([/?#].*)?$') AND NOT regexp_matches(lower(trim(website)), '^(https?://)?www\.[^./?#]*/?$')
  UNION ALL SELECT number, 'opening_hours_osm', id, source, seen_at, opening_hours_osm, regexp_replace(lower(opening_hours_osm), '\s+', '', 'g') FROM r WHERE number IS NOT NULL AND (regexp_matches(opening_hours_osm, '[0-9]{1,2}[:.][0-9]{2}\s*[-–]\s*[0-9]{1,2}[:.][0-9]{2}') OR contains(opening_hours_osm, '24/7'))),
v AS (SELECT DISTINCT number, field, value, source FROM c),
w0 AS (SELECT source, field, coalesce(max(weight), 0.1) AS prior, coalesce(max(weight), 0.1) AS weight FROM (SELECT DISTINCT source, field FROM c) LEFT JOIN source_trust USING (source, field) GROUP BY ALL)
"""


def _fusion_round(k: int) -> str:
    """Support of values under the weights of round ``k``, and the weights of the next."""
    return f"""
, s{k} AS (SELECT number, field, value, sum(weight) AS support FROM v JOIN w{k} USING (source, field) GROUP BY ALL),
t{k} AS (SELECT number, field, sum(support) AS total FROM s{k} GROUP BY ALL),
w{k + 1} AS (SELECT source, field, prior, (sum(support / total) + 20 * prior) / (count(*) + 20) AS weight FROM v JOIN s{k} USING (number, field, value) JOIN t{k} USING (number, field) JOIN w{k} USING (source, field) GROUP BY source, field, prior)"""


_FUSED = _CLAIMS + "".join(map(_fusion_round, range(FUSION_ROUNDS))) + f"""
, e AS (SELECT c.*, weight FROM c JOIN w{FUSION_ROUNDS} USING (source, field) JOIN g USING (number)),
val AS (SELECT number, field, value, round(sum(weight), 9) AS support FROM (SELECT DISTINCT number, field, value, source, weight FROM e) GROUP BY ALL)
SELECT number AS fsa_id, field, raw AS value, id AS winner_id, round(support, 4) AS support FROM e JOIN val USING (number, field, value)
QUALIFY row_number() OVER (PARTITION BY number, field ORDER BY support DESC, weight DESC, seen_at DESC NULLS LAST, id, raw) = 1"""

ORACLE = {
    "p2_found": """
WITH r AS (SELECT *, coalesce(fsa_id, TRY_CAST(nullif(regexp_extract(osm_fhrs_id, '^\\s*0*([0-9]{1,18})\\s*$', 1), '') AS BIGINT)) AS number FROM verify_positions),
g AS (SELECT number FROM r WHERE number IS NOT NULL GROUP BY number HAVING count(DISTINCT id) >= 2),
c AS (
  SELECT number, 'phone' AS field, id, sources[1] AS source, seen_at FROM r WHERE length(regexp_replace(phone, '[^0-9]', '', 'g')) >= 9 AND regexp_matches(phone, '[1-9]')
  UNION ALL SELECT number, 'website', id, sources[1], seen_at FROM r WHERE regexp_matches(lower(trim(website)), '^(https?://)?(www\\.)?[a-z0-9][a-z0-9-]*(\\.[a-z0-9-]+)*\\.[a-z]{2,}(:[0-9]+)?([/?#].*)?$') AND NOT regexp_matches(lower(trim(website)), '^(https?://)?www\\.[^./?#]*/?$')
  UNION ALL SELECT number, 'opening_hours_osm', id, sources[1], seen_at FROM r WHERE regexp_matches(opening_hours_osm, '[0-9]{1,2}[:.][0-9]{2}\\s*-\\s*[0-9]{1,2}[:.][0-9]{2}') OR contains(opening_hours_osm, '24/7'))
SELECT fsa_id, field, winner_id FROM (
  SELECT number AS fsa_id, c.field, id AS winner_id, row_number() OVER (PARTITION BY number, c.field ORDER BY coalesce(weight, 0.1) DESC, seen_at DESC NULLS LAST, id) AS nth
  FROM c JOIN g USING (number) LEFT JOIN source_trust t ON t.source = c.source AND t.field = c.field) WHERE nth = 1""",
    "p2_fused": _FUSED,
    "p6_decoded": "SELECT doc_id, text FROM documents",
    "p8_found": _SHARES + "SELECT doc_id FROM s WHERE share >= 0.30",
    "p8_share": _SHARES + "SELECT doc_id, round(share, 6) AS share FROM s UNION ALL SELECT doc_id, NULL FROM documents WHERE text IS NULL",
}
