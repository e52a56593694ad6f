"""Postal addresses of one location in different writing: parsed parts, sorted neighbourhoods, tolerant scores."""

from __future__ import annotations

import re
import unicodedata
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeloom.llm.names import near
from placeloom.operators.components import components
from placeloom.plans.cut import cut, small, spread

# Kinds of street and how they are shortened.
STREET_KINDS = {
    "road": ["road", "rd"],
    "street": ["street", "st", "str"],
    "terrace": ["terrace", "terr", "tce", "ter"],
    "lane": ["lane", "ln", "la"],
    "avenue": ["avenue", "ave", "av"],
    "parade": ["parade", "par", "pde"],
    "drive": ["drive", "dr", "drv"],
    "square": ["square", "sq"],
    "gardens": ["gardens", "gdns", "gdn"],
    "crescent": ["crescent", "cres", "cr"],
    "place": ["place", "pl"],
    "close": ["close", "cl"],
    "court": ["court", "ct"],
    "way": ["way"],
    "row": ["row"],
    "hill": ["hill"],
}
# Endings of Finnish street names and how they are shortened.
STREET_ENDINGS = {"polku": "plk", "raitti": "rt", "kuja": "kj", "katu": "k", "tie": "t"}
# Words that name a country.
COUNTRIES = {"united kingdom", "great britain", "england", "suomi", "finland", "uk", "gb", "fi"}
# Parts that don't belong to the location.
INSIDE = re.compile(
    r"\b(?:(?:ground|first|second|third|top|lower|upper) (?:floor|fl)\b|basement\b|\d+(?:st|nd|rd|th) floor\b|floor \d+\b|\d+\s*\.?\s*(?:krs|kerros)\b|katutaso\b|sisapiha\b|"
    r"(?:rear|side|back|front|main) entrance\b(?: [a-z]\b)?|entrance [a-z0-9]\b|rappu [a-z0-9]\b|(?:at the )?rear(?: of)?\b|opposite the \w+|next to the \w+|opposite \w+)"
)
UNIT = re.compile(r"\b(?:unit|yksikko|liiketila)\s*(?:no\b\.?|nro\b\.?|number)?\s*#?\s*(\d+)\b|\bu\s?(\d+)\b")
POSTCODE_GB = re.compile(r"\b([a-z]{2}\d{1,2})\s*(\d[a-z]{2})\b")
POSTCODE_FI = re.compile(r"(?<![\d-])\b(\d{5})\b")
NUMBER = re.compile(r"\b(?:no\b\.?\s*|nro\b\.?\s*)?(\d{1,4})(?:\s*(?:-|–|—|to|/)\s*(\d{1,4})\b|\s*-?\s*([a-z])\b)?(?![a-z])")
PLACEHOLDERS = {"", "-", "n/a", "na", "none", "null", "?", "unknown", "tbc", "x", ".", "ei ole"}
_KIND = {short: kind for kind, all_ in STREET_KINDS.items() for short in all_}


def folded(s: str) -> str:
    """Small letters without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", s.casefold()) if not unicodedata.combining(c))


def parse(address: str, postcode: str | None) -> dict | None:
    """Parts of an address: number (with its range and letter), unit, street, kind, postcode and leftover words; None if it names no place."""
    s = folded(address)
    if s.strip() in PLACEHOLDERS:
        return None
    code, part = "", re.sub(r"[^a-z0-9]", "", folded(postcode or ""))
    s = re.sub(r"\s+", " ", re.sub(r"[;/|\n\t]", ",", s.replace("’", "'")))
    for rule in (POSTCODE_GB, POSTCODE_FI):
        m = rule.search(s)
        if m:
            code = "".join(m.groups())
            s = s[: m.start()] + "," + s[m.end() :]
            break
    if re.fullmatch(r"[a-z]{2}\d{1,2}\d[a-z]{2}|\d{5}", part):
        code = part
    elif not code and re.fullmatch(r"[a-z]{2}\d{1,2}|\d{3,4}", part):
        code = part + "*"
    unit = ""
    if m := UNIT.search(s):
        unit = (m[1] or m[2]).lstrip("0")
        s = s[: m.start()] + "," + s[m.end() :]
    s = INSIDE.sub(",", s)
    if code.endswith("*"):
        s = re.sub(rf"\b{code[:-1]}\b", ",", s) if code[0].isalpha() else s
    number = ""
    at = -1
    for m in NUMBER.finditer(s):
        number = m[1].lstrip("0") + (f"-{m[2].lstrip('0')}" if m[2] else "") + (m[3] or "")
        at = m.start()
        end = m.end()
        break
    if at >= 0:
        s = s[:at] + " # " + s[end:]
    tokens = re.findall(r"#|[^\W\d_]+(?:'[^\W\d_]+)*|,", re.sub(r"(?<=[^\W\d_])\.", " ", s))
    return {"number": number, "unit": unit, "code": code, "tokens": tokens}


def _endings(word: str) -> tuple[str, str] | None:
    for kind in STREET_ENDINGS:
        if word.endswith(kind) and len(word) > len(kind) + 2:
            return word[: -len(kind)], kind
    return None


def _shortened(word: str) -> tuple[str, str]:
    """The stem before a shortened ending; stems end in a vowel, so two consonants tell a long short form."""
    for kind, short in STREET_ENDINGS.items():
        if word.endswith(short) and len(word) > len(short) + 3 and word[-len(short) - 1] in "aeiouy":
            return word[: -len(short)], kind
    return word, ""


def street_of(tokens: list[str], town: str) -> tuple[str, str]:
    """(name, kind) of the street; a kind that isn't told for sure is empty."""
    words = [t for t in tokens if t != "saint"]
    hash_at = words.index("#") if "#" in words else -1
    best: tuple[int, str, str] | None = None
    for i, w in enumerate(words):
        if w in "#,":
            continue
        before = words[i - 1] if i and words[i - 1] not in "#," else ""
        far = abs(i - hash_at) if hash_at >= 0 else 0
        kind = _KIND.get(w)
        if not kind and len(w) >= 4:
            kind = next((k for k in STREET_KINDS if near(w, k, 1) <= 1 and len(k) > 3), None)
            far += 2
        if kind and before:
            cand = (far, before, kind)
        elif (e := _endings(w)) is not None and w != town:
            cand = (far, *e)
        else:
            continue
        if best is None or cand[0] < best[0]:
            best = cand
    if best:
        return best[1], best[2]
    # No kind is written or recognised: the word next to the number that isn't the town.
    order = ([hash_at - 1, hash_at + 1, hash_at - 2, hash_at + 2] if hash_at >= 0 else []) + list(range(len(words)))
    for i in order:
        if 0 <= i < len(words) and words[i] not in "#," and len(words[i]) > 2 and near(words[i], town, 2) > 2:
            return _shortened(words[i])
    return "", ""


COLUMNS = ("number", "unit", "town", "name", "kind", "code", "words")


def _agree_code(a: str, b: str) -> int | None:
    """Edits between two postcodes as far as both are written; None if one is missing."""
    if not a or not b:
        return None
    if a[-1] == "*" or b[-1] == "*":
        n = min(len(a.rstrip("*")), len(b.rstrip("*")))
        return near(a[:n], b[:n], 3)
    return near(a, b, 3)


def same_place(a: tuple, b: tuple) -> bool:
    """Whether two forms (see COLUMNS) denote one location. Number, letter and unit must be equal; towns, streets and postcodes may be mistyped."""
    if a[0] != b[0] or a[1] != b[1] or (a[2] and b[2] and a[2] != b[2]) or (a[4] and b[4] and a[4] != b[4]):
        return False
    edits = near(a[3], b[3], 2)
    if edits > 2:
        return False
    code = _agree_code(a[5], b[5])
    if code is not None and code > 2:
        return False
    if not (a[2] and b[2]):
        town, words = (a[2], b[6]) if a[2] else (b[2], a[6])
        told = bool(town) and any(near(w, town, 2) <= 2 for w in words.split() if len(w) > 4)
        if not told and code != 0:
            return False
    if not (a[4] and b[4]) and (code is None or code > 1):
        # Without a kind only the postcode tells a street from others of its name.
        return a[4] == b[4] and edits == 0
    short = min(len(a[3]), len(b[3]))
    return edits <= (2 if code is not None and code <= 1 and short >= 6 else 1 if short >= 5 else 0)


def forms(records: DataFrame, id: str, address: str, postcode: str, area: str | None) -> DataFrame:
    """(id, number, unit, town, name, kind, code, words) of every record whose address names a place."""
    local = F.lower(F.element_at(F.split(F.coalesce(F.col(area), F.lit("")), "/"), -1)) if area else F.lit("")
    src = records.where(F.col(id).isNotNull() & F.col(address).isNotNull()).select(F.col(id).alias("id"), F.col(address).alias("address"), F.col(postcode).alias("postcode"), local.alias("town")).distinct()
    kind = src.schema["id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, out = [], [[] for _ in range(6)]
            for i, (a, p, t) in enumerate(zip(*(b.column(c).to_pylist() for c in ("address", "postcode", "town")), strict=True)):
                got = parse(a, p)
                if got is None or not got["number"]:
                    continue
                name, what = street_of(got["tokens"], t)
                if not name:
                    continue
                keep.append(i)
                words = " ".join(w for w in got["tokens"] if w not in "#," and w != name)
                for column, v in zip(out, (got["number"], got["unit"], name, what, got["code"], words), strict=True):
                    column.append(v)
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("id").take(rows), b.column("town").take(rows), *(pa.array(c, pa.string()) for c in out)], ["id", "town", "number", "unit", "name", "kind", "code", "words"])

    got = spread(src).mapInArrow(read, f"id {kind}, town string, number string, unit string, name string, kind string, code string, words string")
    # The first two signs of a postcode tell the town; which one is learnt from the records that have both.
    got = cut(got)
    start = F.when(F.length("code") >= 3, F.substring("code", 1, 2))
    told = got.where("town <> ''").groupBy(start.alias("start"), "town").agg(F.count("*").alias("n")).where("start is not null")
    towns = told.groupBy("start").agg(F.max_by("town", F.struct("n", "town")).alias("by_code"), (F.max("n") / F.sum("n")).alias("share")).where("share > 0.8").drop("share") if area else cut(_learnt(got.withColumn("start", start)))
    names = (got.where("town <> ''").select(F.col("town").alias("by_word")) if area else towns.select(F.col("by_code").alias("by_word"))).distinct()
    known = got.withColumn("start", start).join(small(towns), "start", "left").withColumn("town", F.when(F.col("town") == "", F.coalesce("by_code", F.lit(""))).otherwise(F.col("town")))
    lost = known.where("town = ''").withColumn("word", F.explode_outer(F.split("words", " "))).join(small(names), F.col("word") == F.col("by_word"), "left").groupBy("id", "number", "unit", "name", "kind", "code", "words").agg(F.coalesce(F.min("by_word"), F.lit("")).alias("town"))
    whole = known.where("town <> ''").select("id", *COLUMNS).unionByName(lost.select("id", *COLUMNS))
    # A missing kind of street is filled in where the place has one kind only.
    one = whole.where("kind <> ''").groupBy("number", "unit", "town", "name").agg(F.min("kind").alias("only"), F.max("kind").alias("other")).where("only = other").drop("other")
    filled = whole.where("kind = ''").join(one, ["number", "unit", "town", "name"], "left").withColumn("kind", F.coalesce("only", "kind"))
    return whole.where("kind <> ''").unionByName(filled.select("id", *COLUMNS)).withColumn("words", F.when(F.col("town") == "", F.col("words")).otherwise(F.lit("")))


def _learnt(got: DataFrame) -> DataFrame:
    """(start, by_code): the town of each beginning of a postcode, learnt from the words that addresses have beside the street: the commonest one, if a fifth of the addresses there have it and four in five of those that have it lie there."""
    known = got.where("start is not null")
    words = known.select("start", F.explode(F.array_distinct(F.split("words", " "))).alias("word")).where(F.length("word") > 3).groupBy("start", "word").agg(F.count("*").alias("n"))
    total = words.groupBy("word").agg(F.sum("n").alias("everywhere"))
    here = known.groupBy("start").agg(F.count("*").alias("rows"))
    return words.join(total, "word").join(here, "start").where("n >= 0.2 * rows and n >= 0.8 * everywhere").groupBy("start").agg(F.max_by("word", F.struct("n", "word")).alias("by_code"))


def _without(word: Column) -> Column:
    """The word and what is left of it without one or two letters; words two edits apart share one of these."""
    one = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1)))
    return F.array_distinct(F.concat(F.array(word), one(word), F.flatten(F.transform(one(word), one))))


def _town_told(distinct: DataFrame) -> DataFrame:
    """Forms without a town, once for each town that one of their words may be, mistyped: (form, near_town)."""
    lost = distinct.where("town = ''").select("form", F.explode(F.split("words", " ")).alias("word")).where(F.length("word") > 4)
    spelt = lost.select("word").distinct().select("word", F.explode(_without(F.col("word"))).alias("key"))
    towns = distinct.where("town <> ''").select(F.col("town").alias("near_town")).distinct().select("near_town", F.explode(_without(F.col("near_town"))).alias("key"))
    return lost.join(spelt.join(towns, "key").select("word", "near_town").distinct(), "word").select("form", "near_town").distinct()


def _pass(rows: DataFrame, block: list, sort: Column, window: int, shared: int) -> DataFrame:
    """Edges (a, b) of one pass. Rows of a block are read in order; each is compared with the ``window`` rows before it and with all before it whose sort key begins alike."""

    def slide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: deque[tuple] = deque()
        last = None
        for b in batches:
            left, right = [], []
            rows = zip(*(b.column(c).to_pylist() for c in ("block", "sort", "form", *COLUMNS)), strict=True)
            for at, key, form, *parts in rows:
                if at != last:
                    held.clear()
                    last = at
                start = key[:shared]
                while len(held) > window and held[0][0] != start:
                    held.popleft()
                for _, other, theirs in held:
                    if same_place(parts, theirs):
                        left.append(form), right.append(other)
                held.append((start, form, parts))
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    # Blocks of one hash only add comparisons.
    keyed = rows.select(F.xxhash64(*block).alias("block"), sort.alias("sort"), "form", *COLUMNS)
    return keyed.repartition("block").sortWithinPartitions("block", "sort", "form").mapInArrow(slide, "a long, b long")


def same_premises(records: DataFrame, id: str = "id", address: str = "address", postcode: str = "postcode", area: str | None = "area_id", window: int = 10, shared: int = 2) -> DataFrame:
    """The location of every record whose address names one: (id, location).

    Addresses are taken apart (number with letter or range, unit, street, kind of street, postcode, town) in any
    order of parts; floors, entrances, directions and countries are left out; shortened kinds are written out.
    Equal forms are one from then on. Multi-pass sorted neighbourhoods follow: by town and street, by town and
    street read backwards, and by postcode. Forms whose town isn't known stand in the blocks of all towns that one of
    their words may be but for typing, and meet others by the beginning of their postcode, in both orders. In each pass
    a form is compared with the ``window`` forms before it in its block and with all before it that begin with the same ``shared`` letters, so
    that long blocks lose nothing. Two forms match (:func:`same_place`) if number, letter and unit are equal and
    street, postcode and town agree but for mistyped or transposed letters. Matches are closed transitively.

    Null, blank and placeholder addresses, addresses without a number or a street, and null ids have no location.
    Repeated records count once; an id with several addresses has several rows. ``area`` holds the town of a record;
    with None, towns are learnt from the addresses and postcodes (:func:`_learnt`). Empty tables give no rows.
    """
    # A form is named by a hash of its parts.
    known = cut(forms(records, id, address, postcode, area).withColumn("form", F.xxhash64(*COLUMNS)))
    distinct = known.select("form", *COLUMNS).distinct()
    strict, place = ["number", "unit"], ["number", "unit", "near_town"]
    lost = cut(_town_told(distinct))
    stands = distinct.where("town <> ''").withColumn("near_town", F.col("town")).unionByName(distinct.where("town = ''").join(lost, "form"))
    begins = distinct.where("length(code) >= 3").withColumn("begin", F.substring("code", 1, 3))
    beside = begins.join(begins.where("town = ''").select(*strict, "begin").distinct(), [*strict, "begin"], "left_semi")
    edges = (
        _pass(stands, place, F.col("name"), window, shared)
        .unionByName(_pass(stands, place, F.reverse("name"), window, shared))
        .unionByName(_pass(distinct.where("length(code) >= 5 and code not like '%*'"), [*strict, "code"], F.col("name"), window, shared))
        .unionByName(_pass(beside, [*strict, "begin"], F.col("name"), window, shared))
        .unionByName(_pass(beside, [*strict, "begin"], F.reverse("name"), window, shared))
    )
    found = components(edges)
    return known.select("id", "form").join(found, F.col("form") == F.col("node"), "left").select("id", F.coalesce("component", "form").alias("location"))


def pairs(members: DataFrame, by: str, id: str = "id") -> DataFrame:
    """(id_a, id_b) of different ids with the same ``by``, id_a < id_b."""
    m = members.select(F.col(by).alias("by"), F.col(id).alias("id")).distinct()
    return m.withColumnRenamed("id", "id_a").join(m.withColumnRenamed("id", "id_b"), "by").where("id_a < id_b").select("id_a", "id_b").distinct()
