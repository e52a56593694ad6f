"""SQL expressions of the plain names and scores of ``functions.text``, for the queries' SQL."""

from __future__ import annotations

from placeloom.functions.text import GENERIC_WORDS, LEGAL_BASE, LEGAL_CHAIN, STOP_WORDS


#: Records of verify_positions, one row an id, with their source, register number, postcode and house number.
RECORDS = r"""
rec AS (SELECT *, sources[1] AS source, coalesce(fsa_id, TRY_CAST(nullif(regexp_extract(osm_fhrs_id, '^\s*0*([0-9]{1,18})\s*$', 1), '') AS BIGINT)) AS number,
  nullif(lower(regexp_replace(coalesce(postcode, ''), '\s', '', 'g')), '') AS pc,
  coalesce(nullif(lower(regexp_extract(coalesce(address, ''), '^\s*(\d+[A-Za-z]?)', 1)), ''), nullif(lower(regexp_extract(coalesce(address, ''), ',\s*(\d+[A-Za-z]?)\b', 1)), '')) AS hn
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at) AS nth FROM verify_positions) WHERE nth = 1)"""
#: Metres in the plane between l and r.
METRES = "sqrt(((l.lat - r.lat) * 111320) * ((l.lat - r.lat) * 111320) + ((l.lng - r.lng) * 62500) * ((l.lng - r.lng) * 62500))"


def quoted(words: tuple[str, ...]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def normal(c: str, drop: tuple[str, ...] = LEGAL_BASE) -> str:
    bare = rf"regexp_replace(lower(coalesce({c}, '')), '\b({'|'.join(drop)})\b', '', 'g')" if drop else f"lower(coalesce({c}, ''))"
    return rf"trim(regexp_replace(regexp_replace(replace({bare}, '&', 'and'), '[^a-z0-9åäö ]', ' ', 'g'), '\s+', ' ', 'g'))"


def words(name: str, least: int = 3, stop: tuple[str, ...] = ()) -> str:
    return f"list_distinct(list_filter(string_split({name}, ' '), lambda w: length(w) >= {least}{f' AND w NOT IN ({quoted(stop)})' if stop else ''}))"


def inside(a: str, b: str, least: int) -> str:
    return f"(least(length({a}), length({b})) >= {least} AND (contains({a}, {b}) OR contains({b}, {a})))"


def score(a: str, b: str) -> str:
    """Name score of two columns."""
    x, y = (words(normal(c, LEGAL_CHAIN), 3, STOP_WORDS) for c in (a, b))
    p, q = (f"replace({normal(c, LEGAL_CHAIN)}, ' ', '')" for c in (a, b))
    o = f"len(list_intersect({x}, {y}))::DOUBLE / greatest(len({x}), len({y}), 1)"
    return f"(CASE WHEN len({x}) = 0 OR len({y}) = 0 THEN 0.0 WHEN {inside(p, q, 8)} THEN greatest({o}, 0.9) ELSE {o} END)"


def anchored(a: str, b: str) -> str:
    """Anchored score of two columns."""
    bare = "lambda w: CASE WHEN ends_with(w, 's') AND NOT ends_with(w, 'ss') THEN substr(w, 1, length(w) - 1) ELSE w END"
    stems = lambda c: f"list_distinct(list_filter(list_transform({words(normal(c), 3)}, {bare}), lambda w: w NOT IN ({quoted(GENERIC_WORDS)})))"
    x, y = stems(a), stems(b)
    p, q = (f"replace({normal(c)}, ' ', '')" for c in (a, b))
    o = f"CASE WHEN len({x}) = 0 OR len({y}) = 0 THEN 0.0 ELSE len(list_intersect({x}, {y}))::DOUBLE / greatest(len({x}), len({y})) END"
    return f"(CASE WHEN {inside(p, q, 6)} THEN greatest({o}, 0.9) ELSE {o} END)"


def gate(name: str, brand: str) -> str:
    b, n = (words(normal(c, LEGAL_CHAIN), 1, STOP_WORDS) for c in (brand, name))
    long = f"list_filter({b}, lambda w: length(w) >= 2)"
    told = f"len(list_filter(list_intersect({long}, {n}), lambda w: w NOT IN ({quoted(GENERIC_WORDS)}))) > 0"
    return f"(CASE WHEN len({b}) = 0 THEN 'no' WHEN len({long}) = 0 THEN 'initials' WHEN {told} THEN 'yes' ELSE 'no' END)"


def accepted(a: str, b: str, score_: str, distance: str, code: str) -> str:
    x, y = normal(a), normal(b)
    shared = f"len(list_filter(list_intersect({words(x, 3, STOP_WORDS)}, {words(y, 3, STOP_WORDS)}), lambda w: w NOT IN ({quoted(GENERIC_WORDS)}))) > 0"
    p, q = (f"replace({n}, ' ', '')" for n in (x, y))
    return f"(({x} = {y} AND length({x}) >= 6) OR {inside(p, q, 8)} OR ({shared} AND ({score_} >= 0.5 OR ({score_} >= 0.34 AND ({distance} < 60 OR {code})))))"


def code(c: str) -> str:
    return rf"nullif(lower(regexp_replace(coalesce({c}, ''), '\s', '', 'g')), '')"


def number(c: str) -> str:
    """House number of an address."""
    return rf"coalesce(nullif(lower(regexp_extract(coalesce({c}, ''), '^\s*(\d+[A-Za-z]?)', 1)), ''), nullif(lower(regexp_extract(coalesce({c}, ''), ',\s*(\d+[A-Za-z]?)\b', 1)), ''))"


def page(c: str) -> str:
    """Key of a page that is no home page, else null."""
    k = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce({c}, ''))), '^(https?:)?//', ''), '^www\\.', ''), '[?#].*$', ''), '/+$', '')"
    return rf"(CASE WHEN {k} <> '' AND NOT regexp_matches({k}, '\s') AND contains({k}, '/') THEN {k} END)"


def brand(a: str, b: str, stop: tuple[str, ...]) -> str:
    """Brand equality of two occupants."""
    x, y = normal(a, ()), normal(b, ())
    telling = lambda n: f"list_filter(string_split({n}, ' '), lambda w: length(w) >= 6 OR (length(w) >= 3 AND w NOT IN ({quoted(stop)})))"
    tail = lambda p, q: f"(length({q}) >= 4 AND starts_with({p}, {q} || ' ') AND len(list_filter(string_split(substr({p}, length({q}) + 2), ' '), lambda w: length(w) >= 3 AND w NOT IN ({quoted(stop)}))) = 0)"
    p, q = (f"replace({n}, ' ', '')" for n in (x, y))
    return f"(len(list_intersect({telling(x)}, {telling(y)})) > 0 OR ({x} <> '' AND {x} = {y}) OR {tail(x, y)} OR {tail(y, x)} OR (least(length({p}), length({q})) >= 4 AND {p} = {q}))"
