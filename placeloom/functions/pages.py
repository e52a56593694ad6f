"""Facts in the HTML of a page."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def visible_text(c: Column, keep_alt: bool = True) -> Column:
    """Text that a reader sees: without scripts, styles, comments and tags; alt and title texts stay; blanks collapsed."""
    out = F.regexp_replace(c, r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->", " ")
    if keep_alt:
        out = F.regexp_replace(out, r"""(?is)<[^>]*?\b(?:alt|title)\s*=\s*["']([^"']*)["'][^>]*>""", " $1 ")
    return F.trim(F.regexp_replace(entities(F.regexp_replace(out, r"(?s)<[^>]*>", " ")), r"[\s\x{00A0}]+", " "))


def entities(c: Column) -> Column:
    """Character references resolved. Only texts that hold one pass through Python."""

    @F.pandas_udf("string")
    def resolve(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: html.unescape(t) if isinstance(t, str) else None)

    return F.when(F.contains(c, F.lit("&")), resolve(c)).otherwise(c)


def title(c: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(F.regexp_extract(c, r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " ")), F.lit(""))


def meta(c: Column, name: str) -> Column:
    """Content of a meta tag, whichever attribute comes first; empty is null."""
    quoted = re.escape(name)
    a = F.regexp_extract(c, rf"""(?is)<meta[^>]*?(?:name|property)\s*=\s*["']{quoted}["'][^>]*?content\s*=\s*["']([^"']*)["']""", 1)
    b = F.regexp_extract(c, rf"""(?is)<meta[^>]*?content\s*=\s*["']([^"']*)["'][^>]*?(?:name|property)\s*=\s*["']{quoted}["']""", 1)
    return F.nullif(F.trim(F.coalesce(F.nullif(a, F.lit("")), b)), F.lit(""))


def links(c: Column) -> Column:
    """Distinct targets of the page's links, in order; anchors, scripts, mail and phone left out."""
    found = F.regexp_extract_all(c, F.lit(r"""(?is)<a\b[^>]*?href\s*=\s*["']([^"'#][^"']*)["']"""), F.lit(1))
    return F.array_distinct(F.filter(F.transform(found, lambda u: F.trim(u)), lambda u: ~F.lower(u).rlike(r"^(javascript|mailto|tel|data):")))


# Words of links to pages that may state opening hours, English and Finnish.
HOUR_WORDS = ("hour", "hours", "open", "opening", "openings", "times", "visit", "visiting", "contact", "contacts", "find", "findus", "location", "locations", "about", "aukioloajat", "yhteystiedot")


def hour_links(c: Column, host: Column, most: int = 3, about: tuple[str, ...] = HOUR_WORDS) -> Column:
    """Links on the page's own host of whose words one is in ``about``: the first ``most``."""
    path = lambda u: F.regexp_replace(F.lower(u), r"^https?://[^/?#]+", "")
    telling = lambda u: F.arrays_overlap(F.split(path(u), "[^a-z]+"), F.array(*map(F.lit, about)))
    site = lambda u: F.regexp_replace(F.regexp_extract(F.lower(u), r"^https?://([^/?#]+)", 1), r"^www\.", "")
    return F.slice(F.filter(links(c), lambda u: telling(u) & site(u).isin("", host)), 1, most)


def linked_data(c: Column) -> Column:
    """array<string>: every object inside the page's JSON-LD, however deep, as JSON. Broken blocks are skipped."""

    @F.pandas_udf("array<string>")
    def nodes(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [json.dumps(n, ensure_ascii=False, sort_keys=True) for n in iter_nodes(t)] if isinstance(t, str) else None)

    return F.when(F.lower(c).contains("ld+json"), nodes(c)).otherwise(F.when(c.isNotNull(), F.array().cast("array<string>")))


def iter_nodes(page: str) -> Iterator[dict]:
    """Objects of all JSON-LD blocks, outer ones first."""
    for m in re.finditer(r"""<script[^>]*application/ld\+json[^>]*>(.*?)</script>""", page, re.S | re.I):
        try:
            todo = [json.loads(m[1].strip())]
        except ValueError:
            continue
        while todo:
            node = todo.pop(0)
            if isinstance(node, dict):
                yield node
                todo += [v for v in node.values() if isinstance(v, dict | list)]
            elif isinstance(node, list):
                todo += [v for v in node if isinstance(v, dict | list)]


def identity(c: Column) -> Column:
    """Names that a page gives itself: title, og:site_name and the names in its linked data; distinct, not blank."""
    named = F.transform(linked_data(c), lambda n: F.get_json_object(n, "$.name"))
    return F.array_distinct(F.filter(F.concat(F.array(title(c), meta(c, "og:site_name")), named), lambda n: n.isNotNull() & (F.trim(n) != "")))


def name_on_page(words: Column, text: Column, code: Column) -> Column:
    """True if a telling word of the name or the postcode is on the page, false if there is text without them, null if there is no text or nothing to look for."""
    low = F.lower(text)
    said = F.exists(words, lambda w: F.contains(low, w))
    coded = F.contains(F.regexp_replace(low, r"\s", ""), code)
    nothing = (F.size(F.coalesce(words, F.array().cast("array<string>"))) == 0) & code.isNull()
    return F.when(text.isNull() | (F.trim(text) == "") | nothing, None).otherwise(F.coalesce(said, F.lit(False)) | F.coalesce(coded, F.lit(False)))


def needs_script(c: Column) -> Column:
    """A page with little text of its own and the root of a script application."""
    return (F.length(visible_text(c)) < 200) & F.lower(c).rlike(r"""id=["'](root|app|__next|__nuxt)["']|<noscript""")


def host_is_dead(failures: Column, last: Column, now: Column, least: int = 2, days: int = 7) -> Column:
    """Failed often enough, and not long enough ago to try again."""
    return (failures >= least) & (F.unix_micros(now) - F.unix_micros(last) < days * 86_400_000_000)
