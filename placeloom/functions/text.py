"""Names, words, addresses, postcodes and web addresses as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of law and articles that a plain name leaves out.
LEGAL_BASE = ("ltd", "limited", "plc", "the", "oy", "ab")
LEGAL_CHAIN = ("ltd", "limited", "plc", "the")
# Words that never tell names apart.
STOP_WORDS = ("and", "of", "de", "la", "s")
# Words of towns, streets and trade that don't anchor a brand.
GENERIC_WORDS = (
    "southend", "leigh", "westcliff", "chalkwell", "shoebury", "shoeburyness", "thorpe", "essex", "london", "high", "street", "road", "avenue", "broadway", "parade", "town", "centre", "center", "branch", "store",
    "station", "sea", "old", "new", "north", "south", "east", "west", "great", "little", "upper", "lower", "saint", "on",
)


def _s(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def normal_name(c: Column | str, drop: tuple[str, ...] = LEGAL_BASE, keep: str = "a-z0-9åäö", ampersand: bool = True) -> Column:
    """Lower case, ``drop`` words out, & written out, other signs as blanks, single blanks. Null counts as empty."""
    out = F.lower(_s(c))
    if drop:
        out = F.regexp_replace(out, rf"\b({'|'.join(drop)})\b", "")
    if ampersand:
        out = F.replace(out, F.lit("&"), F.lit("and"))
    return F.trim(F.regexp_replace(F.regexp_replace(out, f"[^{keep} ]", " "), r"\s+", " "))


def loose_name(c: Column | str) -> Column:
    """:func:`normal_name` with blanks left as they fall."""
    out = F.regexp_replace(F.lower(_s(c)), rf"\b({'|'.join(LEGAL_BASE)})\b", "")
    return F.regexp_replace(F.replace(out, F.lit("&"), F.lit("and")), "[^a-z0-9åäö ]", " ")


def ascii_name(c: Column | str) -> Column:
    """Letters a to z and digits, everything else a blank."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(_s(c)), "[^a-z0-9 ]", " "), r"\s+", " "))


# Latin letters with marks and the plain letters they fold to.
_MARKED = "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿšžœ"
_PLAIN = "aaaaaaaceeeeiiiinoooooouuuuyyszo"


def folded_name(c: Column | str) -> Column:
    """:func:`ascii_name` after Latin letters lost their marks."""
    return ascii_name(F.translate(F.lower(_s(c)), _MARKED, _PLAIN))


def letters_only(c: Column | str) -> Column:
    return F.regexp_replace(F.lower(_s(c)), "[^a-zåäö]", "")


def compact_name(c: Column | str, drop: tuple[str, ...] = LEGAL_BASE) -> Column:
    """:func:`normal_name` without blanks."""
    return F.replace(normal_name(c, drop), F.lit(" "), F.lit(""))


def dedupe_name(c: Column | str) -> Column:
    """Lower case letters and digits only."""
    return F.regexp_replace(F.lower(_s(c)), "[^a-z0-9åäö]", "")


def register_name(c: Column | str, legal: tuple[str, ...] = ("oy", "ab", "oyj", "ky", "tmi", "ry", "ltd", "osk", "abp")) -> Column:
    """Small letters, signs as blanks, words of law stripped from both ends as often as they stand there."""
    words = "|".join(legal)
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower(_s(c)), r"[^\p{L}\p{N} ]", " "), r"\s+", " "))
    return F.trim(F.regexp_replace(F.regexp_replace(plain, rf"^(?:(?:{words})(?:\s+|$))+", ""), rf"(?:(?:^|\s+)(?:{words}))+$", ""))


def rule_name(c: Column | str, drop: tuple[str, ...] = ("ltd", "limited", "plc", "llp", "the", "a", "an")) -> Column:
    """Apostrophes out, every other sign a blank, suffixes and articles out; letters of all scripts stay."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(_s(c)), "['’`]", ""), r"[^\p{L}\p{N}_]+", " ")
    return F.array_join(F.filter(F.split(F.trim(bare), " "), lambda w: ~w.isin(*drop)), " ")


def words(name: Column, least: int = 3, stop: tuple[str, ...] = ()) -> Column:
    """Distinct words of a plain name with at least ``least`` letters."""
    keep = lambda w: (F.length(w) >= least) & ~w.isin(*stop) if stop else F.length(w) >= least
    return F.array_distinct(F.filter(F.split(name, " "), keep))


def stem(w: Column) -> Column:
    """Without a plural s."""
    return F.when(w.endswith("s") & ~w.endswith("ss"), F.substring(w, 1, F.length(w) - 1)).otherwise(w)


def stems(name: Column, least: int = 3, stop: tuple[str, ...] = ()) -> Column:
    return F.array_distinct(F.filter(F.transform(words(name, least), stem), lambda w: ~w.isin(*stop)) if stop else F.transform(words(name, least), stem))


def overlap(a: Column, b: Column) -> Column:
    """Shared words over the words of the longer side; 0 if a side has none."""
    most = F.greatest(F.size(a), F.size(b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / most)


def contained(a: Column, b: Column, least: int) -> Column:
    """Whether one text of at least ``least`` letters stands in the other."""
    return (F.least(F.length(a), F.length(b)) >= least) & (F.contains(a, b) | F.contains(b, a))


def name_score(a: Column | str, b: Column | str, least_inside: int = 8, drop: tuple[str, ...] = LEGAL_CHAIN, stop: tuple[str, ...] = STOP_WORDS) -> Column:
    """Share of common words of the longer name, lifted to .9 if one name without blanks contains the other; 0 if a side has no words."""
    x, y = words(normal_name(a, drop), 3, stop), words(normal_name(b, drop), 3, stop)
    return scored(x, y, compact_name(a, drop), compact_name(b, drop), least_inside)


def scored(x: Column, y: Column, bare_x: Column, bare_y: Column, least_inside: int = 8) -> Column:
    """:func:`name_score` of names whose words and forms without blanks are there."""
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).when(contained(bare_x, bare_y, least_inside), F.greatest(overlap(x, y), F.lit(0.9))).otherwise(overlap(x, y))


def anchored_score(a: Column | str, b: Column | str, generic: tuple[str, ...] = GENERIC_WORDS) -> Column:
    """Like :func:`name_score` over word stems that aren't generic; a name without any can only be contained in the other (6 letters)."""
    x, y = stems(normal_name(a), 3, generic), stems(normal_name(b), 3, generic)
    inside = contained(compact_name(a), compact_name(b), 6)
    return F.when(inside, F.greatest(overlap(x, y), F.lit(0.9))).otherwise(overlap(x, y))


def accept(a: Column | str, b: Column | str, score: Column, distance: Column, same_code: Column) -> Column:
    """Whether two nearby names are taken as one: equal, contained, or sharing a telling word and scoring enough."""
    x, y = normal_name(a), normal_name(b)
    shared = F.size(F.array_except(F.array_intersect(words(x, 3, STOP_WORDS), words(y, 3, STOP_WORDS)), F.array(*map(F.lit, GENERIC_WORDS)))) > 0
    enough = (score >= 0.5) | ((score >= 0.34) & ((distance < 60) | F.coalesce(same_code, F.lit(False))))
    return ((x == y) & (F.length(x) >= 6)) | contained(compact_name(a), compact_name(b), 8) | (shared & enough)


def telling(name: Column, least: int) -> Column:
    """Words of a plain name that tell it from others: not the usual, nor those of towns, streets and trade."""
    return words(name, least, STOP_WORDS + GENERIC_WORDS)


def brand_gate(name: Column | str, brand: Column | str) -> Column:
    """'yes' if a telling word of the brand stands in the name, 'no' if not, 'initials' if the brand has single letters only."""
    b, n = words(normal_name(brand, LEGAL_CHAIN), 1, STOP_WORDS), words(normal_name(name, LEGAL_CHAIN), 1, STOP_WORDS)
    b = F.filter(b, lambda w: w != "")
    long = F.filter(b, lambda w: F.length(w) >= 2)
    told = F.size(F.array_except(F.array_intersect(long, n), F.array(*map(F.lit, GENERIC_WORDS)))) > 0
    return F.when(F.size(b) == 0, "no").when(F.size(long) == 0, "initials").when(told, "yes").otherwise("no")


# Words that two occupants of one place may share without being of one brand.
BRAND_STOP = (
    "and", "the", "of", "pub", "bar", "inn", "cafe", "restaurant", "hotel", "shop", "store", "food", "southend", "leigh", "london",
    "high", "street", "road", "sea", "old", "new", "north", "south", "east", "west", "hackney", "essex",
)


def same_brand(a: Column | str, b: Column | str, common: tuple[str, ...] = BRAND_STOP) -> Column:
    """Whether two occupants are of one brand.

    They share a telling word (six letters or more, or three and not ``common``), or one name goes on from the other's
    four letters or more with common and short words only, or both are equal: as they stand, or, from four letters
    on, without blanks.
    """
    idle = lambda w: (F.length(w) < 3) | w.isin(*common)
    names = [normal_name(c, ()) for c in (a, b)]
    telling = [F.filter(F.split(n, " "), lambda w: (F.length(w) >= 6) | ~idle(w)) for n in names]
    first = F.length(names[0]) <= F.length(names[1])
    brief, full = F.when(first, names[0]).otherwise(names[1]), F.when(first, names[1]).otherwise(names[0])
    goes_on = (F.length(brief) >= 4) & full.startswith(F.concat(brief, F.lit(" "))) & F.forall(F.split(F.substr(full, F.length(brief) + 2), " "), idle)
    bare = [F.replace(n, F.lit(" "), F.lit("")) for n in names]
    equal = ((brief == full) & (brief != "")) | ((bare[0] == bare[1]) & (F.length(bare[0]) >= 4))
    return F.arrays_overlap(*telling) | goes_on | equal


def house_number(c: Column | str, anywhere: bool = True) -> Column:
    """Leading number with its letter, else (``anywhere``) the first one after a comma; null if there is none."""
    some = lambda p: F.nullif(F.lower(F.regexp_extract(_s(c), p, 1)), F.lit(""))
    first = some(r"^\s*(\d+[A-Za-z]?)")
    return F.coalesce(first, some(r",\s*(\d+[A-Za-z]?)\b")) if anywhere else first


def trailing_number(c: Column | str) -> Column:
    """The number that ends the first part of an address, as Finnish addresses have it."""
    return F.nullif(F.lower(F.regexp_extract(_s(c), r"^[^,]*?(\d+\s?[A-Za-z]?)\s*(?:,|$)", 1)), F.lit(""))


def postcode(c: Column | str) -> Column:
    """Without blanks, lower case; empty is null."""
    return F.nullif(F.lower(F.regexp_replace(_s(c), r"\s", "")), F.lit(""))


def postcode_in(c: Column | str) -> Column:
    """The postcode in an address: the British form, else five digits."""
    british = F.regexp_extract(F.upper(_s(c)), r"\b([A-Z]{1,2}[0-9][A-Z0-9]?) ?([0-9][A-Z]{2})\b", 0)
    return F.coalesce(F.nullif(F.lower(F.replace(british, F.lit(" "), F.lit(""))), F.lit("")), F.nullif(F.regexp_extract(_s(c), r"\b([0-9]{5})\b", 1), F.lit("")))


def street_key(c: Column | str) -> Column:
    """Name of the street without numbers before or after it."""
    first = F.regexp_replace(F.lower(_s(c)), r"^\s*\d+[a-z]?(\s*-\s*\d+[a-z]?)?[ ,]*", "")
    part = F.split_part(first, F.lit(","), F.lit(1))
    return F.trim(F.regexp_replace(part, r"\s+\d+\s?[a-z]?\s*$", ""))


def locality_words(c: Column | str, generic: tuple[str, ...] = GENERIC_WORDS) -> Column:
    """Words of four letters or more in an area's id or name that could be taken for a brand's."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(_s(c)), "[^a-zåäö]+", " "), " "), lambda w: (F.length(w) >= 4) & ~w.isin(*generic)))


def url_key(c: Column | str, homepages: bool = False) -> Column:
    """Struct (key, deep): host and path without scheme, www, query and closing slash; null for blank or broken ones. ``deep`` tells a page from a home page."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(F.trim(_s(c))), r"^(https?:)?//", ""), r"^www\.", "")
    bare = F.regexp_replace(F.regexp_replace(bare, r"[?#].*$", ""), r"/+$", "")
    return F.when((bare != "") & ~bare.rlike(r"\s"), F.struct(bare.alias("key"), F.contains(bare, F.lit("/")).alias("deep")))


def url_host(c: Column | str) -> Column:
    return F.split_part(url_key(c)["key"], F.lit("/"), F.lit(1))


# Hosts of social networks and of marketplaces.
SOCIAL_HOSTS = ("facebook.com", "instagram.com", "twitter.com", "x.com", "tiktok.com", "linktr.ee", "chirpbook.example")
MARKET_HOSTS = ("just-eat.co.uk", "deliveroo.co.uk", "ubereats.com", "booking.com", "tripadvisor.com", "tripadvisor.co.uk", "orderhub.example")


def site_kind(c: Column | str, social: tuple[str, ...] = SOCIAL_HOSTS, market: tuple[str, ...] = MARKET_HOSTS) -> Column:
    """'social', 'marketplace' or 'own'; null without an address."""
    host = url_host(c)
    under = lambda hosts: F.lit(False) if not hosts else _any([(host == h) | host.endswith("." + h) for h in hosts])
    return F.when(host.isNull(), None).when(under(social), "social").when(under(market), "marketplace").otherwise("own")


def _any(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return out


def pick_social(socials: Column | str, domains: tuple[str, ...]) -> Column:
    """The first of ``socials`` that holds one of ``domains``."""
    arr = F.col(socials) if isinstance(socials, str) else socials
    return F.get(F.filter(arr, lambda u: _any([F.contains(F.lower(u), F.lit(d)) for d in domains])), F.lit(0))


def is_handle(c: Column | str) -> Column:
    """A handle that somebody typed, not an address."""
    t = F.trim(_s(c))
    return (t != "") & ~F.lower(t).startswith("http")


def slug(c: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(_s(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def first_match(c: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The label of the first pattern that occurs, in order; the rules are a parameter of the caller."""
    out = F.lit(default).cast("string")
    for pattern, label in reversed(rules):
        out = F.when(c.rlike(pattern), label).otherwise(out)
    return out


def tag_match(tags: Column, rules: list[tuple[str, set[str] | None, str]], default: str | None = None) -> Column:
    """The label of the first rule (key, values or None for any, label) that a map of tags fulfils."""
    out = F.lit(default).cast("string")
    for key, values, label in reversed(rules):
        v = F.try_element_at(tags, F.lit(key))
        out = F.when(v.isin(*sorted(values)) if values else v.isNotNull(), label).otherwise(out)
    return out


def contact(tags: Column, key: str) -> Column:
    """``key``, else ``contact:key``; empty is null."""
    some = lambda k: F.nullif(F.trim(F.try_element_at(tags, F.lit(k))), F.lit(""))
    return F.coalesce(some(key), some(f"contact:{key}"))


def joined(*parts: Column, by: str = ", ") -> Column:
    """Parts that aren't blank, joined."""
    return F.concat_ws(by, *(F.nullif(F.trim(p), F.lit("")) for p in parts))


def search_text(*columns: str) -> Column:
    """Text that a search looks in; nulls are empty."""
    return F.lower(F.concat_ws(" ", *(_s(c) for c in columns)))
