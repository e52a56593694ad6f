"""Names, addresses and web addresses in plain form, and their scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeloom.functions import text as T
from placeloom.functions.scores import any_date, place_hash, text_hash36
from placeloom.queries import query, table
from placeloom.queries import sqltext as Q

_NORMAL = r"trim(regexp_replace(regexp_replace(replace(regexp_replace(lower(coalesce({c}, '')), '\b(ltd|limited|plc|the|oy|ab)\b', '', 'g'), '&', 'and'), '[^a-z0-9åäö ]', ' ', 'g'), '\s+', ' ', 'g'))"
_CHAIN = r"trim(regexp_replace(regexp_replace(replace(regexp_replace(lower(coalesce({c}, '')), '\b(ltd|limited|plc|the)\b', '', 'g'), '&', 'and'), '[^a-z0-9åäö ]', ' ', 'g'), '\s+', ' ', 'g'))"


@query(f"""
SELECT DISTINCT id, {_NORMAL.format(c="name")} AS normal, trim(regexp_replace(regexp_replace(lower(coalesce(name, '')), '[^a-z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g')) AS ascii,
regexp_replace(lower(coalesce(name, '')), '[^a-z0-9åäö]', '', 'g') AS dedupe, regexp_replace(lower(coalesce(name, '')), '[^a-zåäö]', '', 'g') AS letters, replace({_NORMAL.format(c="name")}, ' ', '') AS compact FROM crawl_sites""")
def plain_names(spark: SparkSession, d: str) -> DataFrame:
    """A name in the plain forms that different comparisons use."""
    return table(spark, d, "crawl_sites").select("id", T.normal_name("name").alias("normal"), T.ascii_name("name").alias("ascii"), T.dedupe_name("name").alias("dedupe"), T.letters_only("name").alias("letters"), T.compact_name("name").alias("compact")).distinct()


@query(r"""
SELECT DISTINCT alias_id, trim(regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(lower(coalesce(registered_name, '')), '[^\p{L}\p{N} ]', ' ', 'g'), '\s+', ' ', 'g')), '^(?:(?:oy|ab|oyj|ky|tmi|ry|ltd|osk|abp)(?:\s+|$))+', ''), '(?:(?:^|\s+)(?:oy|ab|oyj|ky|tmi|ry|ltd|osk|abp))+$', '')) AS register_name,
array_to_string(list_filter(string_split(trim(regexp_replace(regexp_replace(lower(coalesce(registered_name, '')), '[''’`]', '', 'g'), '[^\p{L}\p{N}_]+', ' ', 'g')), ' '), lambda w: w NOT IN ('ltd', 'limited', 'plc', 'llp', 'the', 'a', 'an')), ' ') AS rule_name FROM aliases""")
def register_names(spark: SparkSession, d: str) -> DataFrame:
    """Registered names without words of law at their ends, and as pair rules read them."""
    return table(spark, d, "aliases").select("alias_id", T.register_name("registered_name").alias("register_name"), T.rule_name("registered_name").alias("rule_name")).distinct()


_TOKENS = "list_distinct(list_filter(string_split({n}, ' '), lambda w: length(w) >= 3 AND w NOT IN ('and', 'of', 'de', 'la', 's')))"


@query(f"""
WITH n AS (SELECT DISTINCT alias_id, {_CHAIN.format(c="registered_name")} AS a, {_CHAIN.format(c="alias_name")} AS b FROM aliases WHERE alias_name IS NOT NULL),
t AS (SELECT *, {_TOKENS.format(n="a")} AS x, {_TOKENS.format(n="b")} AS y, replace(a, ' ', '') AS ca, replace(b, ' ', '') AS cb FROM n),
s AS (SELECT *, CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0 ELSE len(list_intersect(x, y))::DOUBLE / greatest(len(x), len(y)) END AS o FROM t)
SELECT DISTINCT alias_id, round(CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0 WHEN least(length(ca), length(cb)) >= 8 AND (contains(ca, cb) OR contains(cb, ca)) THEN greatest(o, 0.9) ELSE o END, 6) AS score FROM s""")
def name_scores(spark: SparkSession, d: str) -> DataFrame:
    """How well the two names of an alias row agree."""
    return table(spark, d, "aliases").where("alias_name is not null").select("alias_id", F.round(T.name_score("registered_name", "alias_name"), 6).alias("score")).distinct()


@query(f"""
WITH a AS (SELECT DISTINCT alias_id, registered_name AS a, alias_name AS b FROM aliases WHERE alias_name IS NOT NULL AND trim(alias_name) <> ''),
s AS (SELECT *, {Q.anchored("a", "b")} AS score FROM a)
SELECT alias_id, round(score, 6) AS score, {Q.accepted("a", "b", "score", "100.0", "false")} AS accepted, {Q.gate("a", "b")} AS gate, {Q.brand("a", "b", T.BRAND_STOP)} AS brand FROM s""")
def name_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Anchored score, acceptance, brand gate and brand equality of the two names of an alias row."""
    a = table(spark, d, "aliases").where("alias_name is not null and trim(alias_name) <> ''").select("alias_id", "registered_name", "alias_name").distinct()
    s = a.withColumn("score", T.anchored_score("registered_name", "alias_name"))
    return s.select("alias_id", F.round("score", 6).alias("score"), T.accept("registered_name", "alias_name", F.col("score"), F.lit(100.0), F.lit(False)).alias("accepted"), T.brand_gate("registered_name", "alias_name").alias("gate"), T.same_brand("registered_name", "alias_name").alias("brand"))


@query(r"""
SELECT DISTINCT id, coalesce(nullif(lower(regexp_extract(coalesce(address, ''), '^\s*(\d+[A-Za-z]?)', 1)), ''), nullif(lower(regexp_extract(coalesce(address, ''), ',\s*(\d+[A-Za-z]?)\b', 1)), '')) AS house_number,
nullif(lower(regexp_replace(coalesce(postcode, ''), '\s', '', 'g')), '') AS pc,
coalesce(nullif(lower(replace(regexp_extract(upper(coalesce(address, '')), '\b([A-Z]{1,2}[0-9][A-Z0-9]?) ?([0-9][A-Z]{2})\b'), ' ', '')), ''), nullif(regexp_extract(coalesce(address, ''), '\b([0-9]{5})\b', 1), '')) AS found_pc FROM verify_positions""")
def address_parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "verify_positions").select("id", T.house_number("address").alias("house_number"), T.postcode("postcode").alias("pc"), T.postcode_in("address").alias("found_pc")).distinct()


@query(r"""
SELECT DISTINCT id, trim(regexp_replace(split_part(regexp_replace(lower(coalesce(address, '')), '^\s*\d+[a-z]?(\s*-\s*\d+[a-z]?)?[ ,]*', ''), ',', 1), '\s+\d+\s?[a-z]?\s*$', '')) AS street FROM verify_positions""")
def street_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "verify_positions").select("id", T.street_key("address").alias("street")).distinct()


_KEY = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(website)), '^(https?:)?//', ''), '^www\.', ''), '[?#].*$', ''), '/+$', '')"


@query(f"""
WITH k AS (SELECT id, {_KEY} AS k FROM overture WHERE website IS NOT NULL)
SELECT DISTINCT id, k AS key, contains(k, '/') AS deep, split_part(k, '/', 1) AS host,
CASE WHEN regexp_matches(split_part(k, '/', 1), '(^|\\.)(facebook\\.com|instagram\\.com|twitter\\.com|x\\.com|tiktok\\.com|linktr\\.ee|chirpbook\\.example)$') THEN 'social' WHEN regexp_matches(split_part(k, '/', 1), '(^|\\.)(just-eat\\.co\\.uk|deliveroo\\.co\\.uk|ubereats\\.com|booking\\.com|tripadvisor\\.com|tripadvisor\\.co\\.uk|orderhub\\.example)$') THEN 'marketplace' ELSE 'own' END AS kind
FROM k WHERE k <> '' AND NOT regexp_matches(k, '\\s')""")
def url_keys(spark: SparkSession, d: str) -> DataFrame:
    """Web addresses in plain form, and whether they are of the place's own."""
    o = table(spark, d, "overture").where("website is not null").select("id", T.url_key("website").alias("u"), T.url_host("website").alias("host"), T.site_kind("website").alias("kind")).where("u is not null")
    return o.select("id", "u.key", "u.deep", "host", "kind").distinct()


@query(f"""
WITH o AS (SELECT DISTINCT id, {_KEY} AS k FROM overture WHERE website IS NOT NULL), s AS (SELECT DISTINCT id, {_KEY} AS k FROM crawl_sites WHERE website IS NOT NULL)
SELECT o.id AS overture_id, s.id AS site_id FROM o JOIN s USING (k) WHERE contains(k, '/') AND NOT regexp_matches(k, '\\s')""")
def page_join(spark: SparkSession, d: str) -> DataFrame:
    """Places and sites with one page (home pages don't count)."""
    side = lambda t, n: table(spark, d, t).select(F.col("id").alias(n), T.url_key("website").alias("u")).where("u.deep").select(n, "u.key").distinct()
    return side("overture", "overture_id").join(side("crawl_sites", "site_id"), "key").drop("key")


@query("""
SELECT DISTINCT id, list_filter(coalesce(socials, []), lambda u: contains(lower(u), 'facebook.com') OR contains(lower(u), 'chirpbook.example'))[1] AS social, trim(coalesce(phone, '')) <> '' AND NOT starts_with(lower(trim(coalesce(phone, ''))), 'http') AS bare FROM overture""")
def social_picks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "overture").select("id", T.pick_social(F.coalesce("socials", F.array().cast("array<string>")), ("facebook.com", "chirpbook.example")).alias("social"), T.is_handle("phone").alias("bare")).distinct()


@query(r"""
SELECT DISTINCT area_id, list_distinct(list_filter(string_split(regexp_replace(lower(name), '[^a-zåäö]+', ' ', 'g'), ' '), lambda w: length(w) >= 4 AND w NOT IN ('high', 'street', 'road', 'town', 'station', 'north', 'south', 'east', 'west', 'saint'))) AS words, regexp_replace(regexp_replace(lower(area_id), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM areas""")
def area_words(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "areas").select("area_id", T.locality_words("name").alias("words"), T.slug("area_id").alias("slug")).distinct()


@query(r"""
WITH RECURSIVE v AS (SELECT DISTINCT id, concat_ws('|', name, postcode) AS t, lower(trim(name)) || '|' || printf('%.5f', round(lat::DECIMAL(20, 10), 5)) || '|' || printf('%.5f', round(lng::DECIMAL(20, 10), 5)) AS p FROM verify_positions WHERE name IS NOT NULL AND lat IS NOT NULL AND lng IS NOT NULL),
u AS (SELECT *, list_reduce(list_prepend(5381::BIGINT, list_transform(string_split(t, ''), lambda c: unicode(c)::BIGINT)), lambda h, c: (h * 33 + c) % 4294967296) AS h FROM v),
b AS (SELECT id, p, h AS x, '' AS s FROM u UNION ALL SELECT id, p, x // 36, substr('0123456789abcdefghijklmnopqrstuvwxyz', (x % 36)::INTEGER + 1, 1) || s FROM b WHERE x > 0)
SELECT DISTINCT id, s AS text36, substr(sha1(p), 1, 16) AS place16 FROM b WHERE x = 0""")
def record_hashes(spark: SparkSession, d: str) -> DataFrame:
    """Stable keys of records from their text and place."""
    v = table(spark, d, "verify_positions").where("name is not null and lat is not null and lng is not null")
    return v.select("id", text_hash36(F.concat_ws("|", "name", "postcode")).alias("text36"), place_hash(F.col("name"), F.col("lat"), F.col("lng")).alias("place16")).distinct()


@query("""
SELECT DISTINCT id, coalesce(TRY_CAST(try_strptime(trim(fsa_rating_date), '%Y-%m-%d') AS DATE), TRY_CAST(try_strptime(trim(fsa_rating_date), '%d/%m/%Y') AS DATE)) AS rated FROM verify_positions WHERE fsa_rating_date IS NOT NULL""")
def rating_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates written in either of two forms."""
    return table(spark, d, "verify_positions").where("fsa_rating_date is not null").select("id", any_date(F.col("fsa_rating_date")).alias("rated")).distinct()


@query(r"""
SELECT doc_id, nullif(trim(regexp_replace(regexp_extract(text, '<b[^>]*>([^<]*)</b>', 1), '\s+', ' ', 'g')), '') AS bold, regexp_matches(text, '<[a-zA-Z/][^>]*>') AS markup FROM documents WHERE text IS NOT NULL""")
def markup_in_text(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").where("text is not null")
    return t.select("doc_id", F.nullif(F.trim(F.regexp_replace(F.regexp_extract("text", r"<b[^>]*>([^<]*)</b>", 1), r"\s+", " ")), F.lit("")).alias("bold"), F.col("text").rlike(r"<[a-zA-Z/][^>]*>").alias("markup"))


@query()
def visible_texts(spark: SparkSession, d: str) -> DataFrame:
    """Documents as a reader sees them."""
    from placeloom.functions.pages import visible_text

    return table(spark, d, "documents").select("doc_id", visible_text(F.col("text")).alias("text"))


@query("""
SELECT doc_id, CASE WHEN regexp_matches(lower(text), 'ticket office|table by the window') THEN 'front' WHEN regexp_matches(lower(text), 'kitchen|chef|bakery oven') THEN 'kitchen' ELSE 'other' END AS class FROM documents WHERE text IS NOT NULL""")
def ordered_classes(spark: SparkSession, d: str) -> DataFrame:
    """The first of ordered patterns that a text fulfils."""
    rules = [("ticket office|table by the window", "front"), ("kitchen|chef|bakery oven", "kitchen")]
    return table(spark, d, "documents").where("text is not null").select("doc_id", T.first_match(F.lower("text"), rules, "other").alias("class"))
