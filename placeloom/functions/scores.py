"""Ratings, evidence, freshness and hashes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Trust in each kind of evidence, and the ages in days between which a map record's trust runs down.
TRUST = {
    "fsa-linked": 1.0, "servicemap-record": 1.0, "ch-corroborated": 0.8, "prh-listed": 0.8, "atp-contributor": 0.8, "chain-record": 0.8, "nhs-listed": 0.7, "recent-osm-touch": 0.7,
    "overture-direct": 0.6, "overture-agreed": 0.7, "ta-record": 0.4, "aged-osm-floor": 0.3,
}
FRESH_DAYS, STALE_DAYS = 182, 547


def bayes_rating(stars: Column, prior: Column, weight: float = 10.0) -> Column:
    """Mean of five star counts (best first) drawn to ``prior`` as by ``weight`` further votes, 3 places."""
    n = sum((stars[i] for i in range(1, 5)), stars[0])
    total = sum((stars[i] * (5 - i) for i in range(1, 5)), stars[0] * 5)
    return F.round((weight * prior + total) / (weight + n), 3)


def positive_share(stars: Column) -> Column:
    """Share of the two best stars; null without votes."""
    n = sum((stars[i] for i in range(1, 5)), stars[0])
    return F.when(n > 0, (stars[0] + stars[1]) / n)


def review_band(n: Column) -> Column:
    """How many reviews, told roughly: exact below 5, then by 5, 10 and 50."""
    by = lambda k: F.concat(F.lit("~"), (F.floor(n / k + 0.5) * k).cast("string"))
    return F.when(n.isNull(), "").when(n < 5, n.cast("string")).when(n < 20, by(5)).when(n < 100, by(10)).otherwise(by(50))


def recommended(bayes: Column, n: Column) -> Column:
    return F.coalesce((bayes >= 4.0) & (n >= 5), F.lit(False))


def age_days(then: Column, now: Column) -> Column:
    """Whole days from ``then`` to ``now``; null if ``then`` is."""
    return F.floor((F.unix_micros(now) - F.unix_micros(then)) / 86_400_000_000).cast("int")


def legs(sources: Column, touched_days: Column, strong: Column | None = None, created: Column | None = None) -> Column:
    """Evidence of a record: array of (rule, age). A map record is fresh, running down, at its floor, or undated but vouched for."""
    has = lambda s: F.array_contains(sources, s)
    leg = lambda ok, rule, age=None: F.when(F.coalesce(ok, F.lit(False)), F.struct(F.lit(rule).alias("rule"), (F.lit(None) if age is None else age).cast("int").alias("age")))
    vouched = has("fsa") | has("ch") | has("servicemap")
    fresh, aging = touched_days < FRESH_DAYS, touched_days < STALE_DAYS
    osm = (
        F.when(~F.coalesce(has("osm"), F.lit(False)), None)
        .when(fresh, F.struct(F.lit("recent-osm-touch").alias("rule"), F.lit(None).cast("int").alias("age")))
        .when(aging, F.struct(F.lit("aged-osm-touch").alias("rule"), touched_days.cast("int").alias("age")))
        .when(touched_days.isNotNull() | ~vouched, F.struct(F.lit("aged-osm-touch").alias("rule"), F.lit(STALE_DAYS).alias("age")))
        .otherwise(F.struct(F.lit("recent-osm-touch").alias("rule"), F.lit(None).cast("int").alias("age")))
    )
    simple = {"atp": "atp-contributor", "fsa": "fsa-linked", "ch": "ch-corroborated", "nhs": "nhs-listed", "servicemap": "servicemap-record", "ta": "ta-record", "chain": "chain-record", "prh": "prh-listed"}
    all_ = [leg(has(s), rule) for s, rule in simple.items()] + [osm, leg(created == "ov-direct" if created is not None else F.lit(False), "overture-direct"), leg(strong if strong is not None else F.lit(False), "overture-agreed")]
    return F.array_compact(F.array(*all_))


def leg_weight(rule: Column, age: Column, trust: dict[str, float] | None = None) -> Column:
    trust = trust or TRUST
    f = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - (age - FRESH_DAYS) / float(STALE_DAYS - FRESH_DAYS)))
    out = F.lit(0.0)
    for name, w in trust.items():
        out = F.when(rule == name, w).otherwise(out)
    return F.when(rule == "aged-osm-touch", trust["recent-osm-touch"] * f + trust["aged-osm-floor"] * (1 - f)).otherwise(out)


def tier(evidence: Column, trust: dict[str, float] | None = None) -> Column:
    """Sum of the weights, at most 3, one place."""
    total = F.aggregate(evidence, F.lit(0.0), lambda acc, e: acc + leg_weight(e["rule"], e["age"], trust))
    return F.bround(F.least(total, F.lit(3.0)), 1)


def place_rank(tier_: Column, bayes: Column) -> Column:
    return F.bround(tier_ * 10 + F.coalesce(bayes, F.lit(0.0)) / 10, 2)


def half_life(value: Column, age: Column, half: float) -> Column:
    """``value`` that halves every ``half`` days (at least 2)."""
    return value * F.pow(F.lit(2.0), -age / max(2.0, half))


def richness(columns: dict[str, str]) -> Column:
    """Per cent of the columns that hold something; an array does if it isn't empty. ``columns``: name -> type."""
    full = [F.when(F.size(F.col(c)) > 0, 1).otherwise(0) if t.startswith("array") else F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", 1).otherwise(0) for c, t in columns.items()]
    return F.round(100 * sum(full[1:], full[0]) / len(full)).cast("int")


def first_full(*columns: Column) -> Column:
    """The first that isn't null or blank."""
    return F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in columns))


def list_verdict(ours: Column, theirs: Column) -> Column:
    """'agree' if they add nothing, 'conflict' if nothing is shared, else 'extend'; null without a list."""
    new = F.size(F.array_except(theirs, ours))
    none = F.size(F.array_intersect(theirs, ours)) == 0
    return F.when((F.size(F.coalesce(ours, F.array())) == 0) | (F.size(F.coalesce(theirs, F.array())) == 0), None).when(new == 0, "agree").when(none, "conflict").otherwise("extend")


def text_hash36(c: Column) -> Column:
    """Multiply-by-33 hash of the text's 16-bit code units, 32 bits, in base 36 small letters."""
    units = F.regexp_extract_all(F.hex(F.encode(c, "UTF-16BE")), F.lit("....").cast("string"), F.lit(0))
    h = F.aggregate(F.transform(units, lambda u: F.conv(u, 16, 10).cast("long")), F.lit(5381).cast("long"), lambda acc, u: (acc * 33 + u).bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.lower(F.conv(h.cast("string"), 10, 36))


def place_hash(name: Column, lat: Column, lng: Column) -> Column:
    """First 16 signs of the SHA-1 of name and place; coordinates as decimals of five places, halves up."""
    five = lambda v: F.round(v.cast("decimal(20,10)"), 5).cast("decimal(12,5)").cast("string")
    return F.substring(F.sha1(F.concat_ws("|", F.lower(F.trim(name)), five(lat), five(lng)).cast("binary")), 1, 16)


def any_date(c: Column, formats: tuple[str, ...] = ("yyyy-MM-dd", "dd/MM/yyyy")) -> Column:
    """The date in the first format that fits; null if none does."""
    return F.coalesce(*(F.to_date(F.try_to_timestamp(F.trim(c), F.lit(f))) for f in formats))


def affirmed(c: Column) -> Column:
    """True for a Y, else null: absent is not denied."""
    return F.when(F.upper(F.trim(c)) == "Y", True)


def max_confidence(top: Column, parts: Column, dataset: str) -> Column:
    """The greater of a record's confidence and those of one contributor's parts (dataset, confidence)."""
    theirs = F.array_max(F.transform(F.filter(parts, lambda s: s["dataset"] == dataset), lambda s: s["confidence"]))
    return F.greatest(F.coalesce(top, F.lit(0.0)), F.coalesce(theirs, F.lit(0.0)))


def latest_state(entries: Column, states: dict[str, tuple[str, ...]]) -> Column:
    """The first of ``states`` of whose words one is the ``text`` of an entry; 'unknown' if none is. Give the state that ends all others first."""
    texts = F.transform(entries, lambda e: e["text"])
    out = F.lit("unknown")
    for state, words in reversed(states.items()):
        out = F.when(F.arrays_overlap(texts, F.array(*map(F.lit, words))), state).otherwise(out)
    return out


def current_name(entries: Column) -> Column:
    """The ``name`` of the last entry whose ``ends`` is null, else of the last of all."""
    live = F.filter(entries, lambda e: e["ends"].isNull())
    return F.coalesce(F.try_element_at(live, F.lit(-1))["name"], F.try_element_at(entries, F.lit(-1))["name"])
