"""Variant spellings of the names of people, firms and clubs."""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placeloom.operators.components import components
from placeloom.plans.cut import cut_parts, cut_table, passing, release, spread

# Forms of address and law, and joining words, that don't tell names apart.
IDLE = set("ltd limited plc llp oy oyj ab uk gb inc co company the of by and ja och et mr mrs ms miss mx dr sir esq sole trader owner prop ta partnership partners lp".split())
# Words that firms add and leave out.
SOFT = set("group services supplies brothers associates international sons holdings trading cafe".split())
# Usual shortenings of business words; others are told by their letters (short_for).
SHORT = {
    "grp": "group", "svcs": "services", "serv": "services", "svc": "services", "bros": "brothers", "bro": "brothers", "assocs": "associates", "intl": "international", "int": "international",
    "suppl": "supplies", "supp": "supplies", "photog": "photography", "pharm": "pharmacy", "ctrg": "catering", "cater": "catering", "stnry": "stationery",
    "vet": "veterinary", "vets": "veterinary", "acct": "accountancy", "accts": "accountancy", "soc": "society", "comm": "community", "assn": "association", "htl": "hotel", "ctr": "centre",
    "hse": "house", "rest": "restaurant", "rav": "ravintola", "lib": "library", "gdn": "garden",
}
# Nicknames and the names they stand for.
NICK = {
    "joe": "joseph", "joey": "joseph", "will": "william", "bill": "william", "billy": "william", "nick": "nicholas", "nicky": "nicholas", "veke": "veikko", "ulla": "ursula", "ursel": "ursula",
    "ollie": "oliver", "hanne": "hannele", "hannah": "hannele", "hanna": "hannele", "gabby": "gabriella", "gabi": "gabriella", "gaby": "gabriella", "ella": "gabriella", "fred": "frederick", "freddie": "frederick", "freddy": "frederick",
    "iggy": "ignatius", "ignace": "ignatius", "sue": "susannah", "susie": "susannah", "suzy": "susannah", "rob": "robert", "bob": "robert", "bobby": "robert", "robbie": "robert", "zak": "zacharias", "zach": "zacharias", "zack": "zacharias",
    "ted": "theodore", "theo": "theodore", "teddy": "theodore", "len": "leonard", "lenny": "leonard", "leo": "leonard", "charlie": "charlotte", "lottie": "charlotte", "tony": "anthony", "ant": "anthony",
    "maggie": "margaret", "meg": "margaret", "peggy": "margaret", "pippa": "philippa", "pip": "philippa", "liz": "elizabeth", "beth": "elizabeth", "lizzie": "elizabeth", "betty": "elizabeth", "eliza": "elizabeth", "kate": "katherine", "kathy": "katherine", "katie": "katherine", "kat": "katherine", "kitty": "katherine",
    "deb": "deborah", "debbie": "deborah", "debs": "deborah", "nell": "hannele",
}
GIVEN = set(NICK.values())
#: A gram that one form in so many has, or fewer, weighs most.
RAREST = 1000.0


@lru_cache(maxsize=500_000)
def _signs(word: str) -> int:
    """The signs of a word as bits."""
    bits = 0
    for c in word:
        bits |= 1 << ord(c) % 61
    return bits


@lru_cache(maxsize=200_000)
def near(a: str, b: str, most: int) -> int:
    """Edits between ``a`` and ``b``, a transposition of neighbours being one; ``most + 1`` if there are more."""
    if a == b:
        return 0
    # An edit changes two signs at most.
    if abs(len(a) - len(b)) > most or (_signs(a) ^ _signs(b)).bit_count() > 2 * most:
        return most + 1
    i, n = 0, min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    before: list[int] = []
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


def words_of(name: str) -> tuple[str, ...]:
    """The telling words of a name in plain, written-out form, in alphabetical order. Soft words are kept, idle ones are not."""
    s = re.sub(r"([a-zäöåéèü])([A-ZÄÖÅ][a-zäöåéèü])", r"\1 \2", name)
    s = "".join(c for c in unicodedata.normalize("NFKD", s.casefold()) if not unicodedata.combining(c))
    s = re.sub(r"\bt/a\b|\(uk\)|\bint'l\b", lambda m: " international " if m[0] == "int'l" else " ", s)
    s = re.sub(r"['’]s\b", " ", s)
    s = re.sub(r"['’]", "", s)
    out: list[str] = []
    for w in re.findall(r"[^\W_]+", s):
        w = SHORT.get(w, w)
        w = NICK.get(w, w)
        if w not in IDLE:
            out.append(w)
    # "Assoc." is an association of a community, else associates.
    out = [("association" if "community" in out else "associates") if w == "assoc" else w for w in out]
    return tuple(sorted(out)) or tuple(sorted(re.findall(r"[^\W_]+", s)))


def _slack(w: str) -> int:
    return 0 if len(w) < 4 else 1 if len(w) < 6 else 2


@lru_cache(maxsize=200_000)
def _idle(w: str) -> bool:
    """Soft, or a mistyped soft or idle word."""
    return w in SOFT or (len(w) > 4 and any(len(k) > 4 and near(w, k, 1) <= 1 for k in (*SOFT, *IDLE)))


@lru_cache(maxsize=200_000)
def _given(w: str) -> bool:
    return any(near(w, g, 1) <= 1 for g in GIVEN)


def short_for(w: str, v: str) -> bool:
    """Whether ``w`` can be ``v`` shortened: three letters or more of it in their order, the first among them."""
    if not 3 <= len(w) < len(v) or w[0] != v[0]:
        return False
    letters = iter(v)
    return all(c in letters for c in w)


def _letters(w: str, words: list[str]) -> list[str] | None:
    """Words, one for each letter of ``w``, whose first letters these are (in any order); None if there are none."""
    left, out = list(words), []
    for c in w:
        v = next((v for v in left if len(v) > 2 and v[0] == c), None)
        if v is None:
            return None
        left.remove(v)
        out.append(v)
    return out


def same_name(a: tuple[str, ...], b: tuple[str, ...]) -> bool:
    """Whether two names (see :func:`words_of`) can be of one entity.

    Every telling word must have a partner: equal, mistyped by up to two letters, shortened, an initial of it, or the
    initials of several. Only soft words and middle initials may stand alone; at least one word of four letters or
    more must be equal but for typing.
    """
    if a == b:
        return True
    left, right = list(a), list(b)
    firm = 0
    for w in a:
        if w in right:
            left.remove(w)
            right.remove(w)
            firm += len(w) > 3 and w not in SOFT and w not in GIVEN
    for w in sorted(left, key=len, reverse=True):
        if len(w) > 1:
            slack = _slack(w)
            best = min(((n, v) for v in right if len(v) > 1 and (n := near(w, v, slack)) <= slack), default=None)
            if best:
                left.remove(w)
                right.remove(best[1])
                firm += len(w) > 3 and w not in SOFT and w not in GIVEN
    for these, those in ((left, right), (right, left)):
        for w in [w for w in these if len(w) == 1]:
            full = next((v for v in those if v[0] == w and _given(v)), None)
            if full:
                these.remove(w)
                those.remove(full)
    # Shortened words, and initials of two to four words.
    for these, those in ((left, right), (right, left)):
        for w in [w for w in these if 2 <= len(w) <= 8]:
            if full := next((v for v in those if short_for(w, v)), None):
                these.remove(w)
                those.remove(full)
            elif len(w) <= 4 and (every := _letters(w, those)):
                these.remove(w)
                for v in every:
                    those.remove(v)
    # A missing blank: one word is two of the other name's.
    for these, those in ((left, right), (right, left)):
        for w in [w for w in these if len(w) > 8]:
            two = next(((x, y) for x in those for y in those if x != y and len(x) > 2 and len(y) > 2 and abs(len(x) + len(y) - len(w)) < 2 and near(w, x + y, 1) <= 1), None)
            if two:
                these.remove(w)
                those.remove(two[0])
                those.remove(two[1])
                firm += 1
    # A full name beside its own initial on one side, the initial alone on the other.
    for these, other in ((left, b), (right, a)):
        for w in [w for w in these if w in GIVEN and w[0] in other]:
            these.remove(w)
    if firm == 0 and not (len(a) == len(b) == 1):
        return False
    rest = left + right
    return all(len(w) == 1 or _idle(w) for w in rest) and not any(len(w) == 1 for w in left) * any(len(w) == 1 for w in right)


def plain_names(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with the name ``columns`` in plain form (telling words, one blank between), null where nothing is left."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in columns:
                plain = [" ".join(words_of(n)) or None if n else None for n in b.column(c).to_pylist()]
                b = b.set_column(b.schema.get_field_index(c), c, pa.array(plain, pa.string()))
            yield b

    return df.mapInArrow(read, df.schema)


def grams_of(form: str, gram: int) -> list[list[str]]:
    """The different n-grams of each word of three letters or more of a form, its ends marked."""
    words = [f"^{w}$" for w in form.split(" ") if len(w) > 2]
    return [list(dict.fromkeys(w[i : i + gram] for i in range(max(len(w) - gram + 1, 1)))) for w in words]


def weighed(form: str, df: dict[str, int], n: float, gram: int) -> dict[str, float]:
    """The vector of a form, of length 1: its grams, in order, with their weights; ``df`` of ``n`` forms have a gram.

    All grams of a word weigh alike, log(1 + n / df) squared of the word's middle ``df``, at most that of one form in
    ``RAREST``. So a typing error in a common word, or in a name of which many spellings are there, does not outweigh
    the letters that are right, and weights go by the share of the forms, not by their number.
    """
    out: dict[str, float] = {}
    for grams in grams_of(form, gram):
        middle = sorted((df[g] for g in grams), reverse=True)[len(grams) // 2]
        w = math.log(1 + min(n / middle, RAREST)) ** 2
        for g in grams:
            out[g] = max(w, out.get(g, 0.0))
    length = math.sqrt(sum(w * w for w in out.values()))
    return {g: out[g] / length for g in sorted(out)}


def _grams(forms: DataFrame, gram: int) -> DataFrame:
    """(form_id, gram) of :func:`grams_of`, each once."""
    word = lambda w: F.concat(F.lit("^"), w, F.lit("$"))
    cuts = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - gram + 1, F.lit(1))), lambda i: F.substr(w, i, F.lit(gram)))
    long = F.filter(F.split("form", " "), lambda w: F.length(w) > 2)
    return spread(forms).select("form_id", F.explode(F.array_distinct(F.flatten(F.transform(long, lambda w: cuts(word(w)))))).alias("gram"))


def vectors(forms: DataFrame, least: float, gram: int, list_: int, at_once: int) -> DataFrame:
    """(form_id, form, words, kept, pieces): the vector of each form (:func:`weighed`) in little room.

    ``words`` are the weights of its words' grams in the order of :func:`grams_of`. For its different grams in order,
    ``kept`` has a bit for those that the prefix filter keeps (see :func:`alike`), and ``pieces`` the number of pieces
    in which the forms of a kept gram meet, 0 if no other form has it. Grams meet their numbers for a part of the
    forms at a time, of ``at_once`` entries or four a form, whichever is more.
    """
    total = float(forms.count())
    df = cut_table(_grams(forms, gram).groupBy("gram").agg(F.count("*").alias("df")))
    slices = max(1, math.ceil((df.agg(F.sum("df")).first()[0] or 0) / max(at_once, 4 * total)))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(5)]
            for me, form, v in zip(*(b.column(c).to_pylist() for c in ("form_id", "form", "v")), strict=True):
                df = {x["gram"]: x["df"] for x in v}
                vector = weighed(form, df, total, gram)
                upto, dropped = 0.0, set()
                for g in sorted(vector, key=lambda g: (-df[g], g)):
                    upto += vector[g] ** 2
                    if upto >= least * least:
                        break
                    dropped.add(g)
                kept = np.packbits([g not in dropped for g in vector]).tobytes()
                pieces = [0 if g in dropped or df[g] < 2 else -(-df[g] // list_) for g in vector]
                # A word weighs as its lightest gram: others may be heavier by another word.
                words = [min(vector[g] for g in grams) for grams in grams_of(form, gram)]
                for column, value in zip(out, (me, form, words, kept, pieces), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.string(), pa.list_(pa.float32()), pa.binary(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["form_id", "form", "words", "kept", "pieces"])

    def part(k: int) -> DataFrame:
        mine = forms if slices == 1 else forms.where(F.pmod(F.xxhash64("form_id"), F.lit(slices)) == k)
        whole = _grams(mine, gram).join(df, "gram").groupBy("form_id").agg(F.collect_list(F.struct("gram", "df")).alias("v")).join(mine, "form_id")
        return whole.select("form_id", "form", "v").mapInArrow(weigh, "form_id long, form string, words array<float>, kept binary, pieces array<int>")

    out = cut_parts(part(k) for k in range(slices))
    release(df)
    return out


def _stable(*parts: object) -> int:
    return zlib.crc32("|".join(map(str, parts)).encode())


def alike(forms: DataFrame, least: float = 0.25, gram: int = 4, top: int | None = None, held: int = 200_000, list_: int = 500, at_once: int = 1_000_000) -> DataFrame:
    """Pairs (a, b, sim), a < b, of ``forms`` (form_id, form) that can be of one entity (:func:`same_name`) and whose n-gram vectors (:func:`weighed`) have a cosine of ``least``.

    A sparse similarity join: each vector keeps its rarest grams and drops the commonest as long as those have less
    than ``least`` of its length. The order of grams is the same for all, so pairs that reach ``least`` share a kept
    gram and none is missed. Kept grams are dealt to lots of about ``held`` entries; a form goes once to each lot in
    which it has grams, and the forms of a gram are compared there by a matrix product of their whole vectors. A gram
    of more than ``list_`` forms is split into pieces of which each two meet in a lot of their own, so no task grows
    with it. A pair comes out at the first gram that both have kept, so pairs are never shuffled. Lots are dealt in
    rounds of ``at_once`` entries or two a form, whichever is more, and what was dealt goes with the round, so the
    disks hold a fixed number of bytes a form however often the commonest grams meet. ``top`` keeps the best partners
    of each form only; None keeps all.
    """
    spark = forms.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        last = None
        for b in batches:
            for lot, *row in zip(*(b.column(c).to_pylist() for c in ("lot", "form_id", "form", "words", "kept", "lists")), strict=True):
                if lot != last and rows:
                    yield _met(rows, gram, least)
                    rows = []
                last = lot
                rows.append(tuple(row))
        if rows:
            yield _met(rows, gram, least)

    with passing(spark) as keep:
        whole = vectors(forms, least, gram, list_, at_once)
        size, entries = whole.agg(F.count("*"), F.sum(F.aggregate("pieces", F.lit(0).cast("long"), lambda n, x: n + x))).first()
        entries = entries or 0
        rounds = max(1, math.ceil(entries / max(at_once, 2 * size)))
        lots = max(parts * rounds, -(-entries // held))

        def one(k: int) -> DataFrame:
            def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    out: list[list] = [[] for _ in range(6)]
                    for me, form, words, kept, pieces in zip(*(b.column(c).to_pylist() for c in ("form_id", "form", "words", "kept", "pieces")), strict=True):
                        lists: dict[int, list[str]] = {}
                        for at, (g, n) in enumerate(zip(_in_order(form, gram), pieces, strict=True)):
                            mine = _stable(me) % n if n > 1 else 0
                            for other in range(n):
                                low, high = min(mine, other), max(mine, other)
                                lot = _stable(g, low, high) % lots
                                if lot % rounds == k:
                                    lists.setdefault(lot, []).append(f"{at}\t{low}\t{high}\t{mine}" if n > 1 else str(at))
                        for lot, names in lists.items():
                            for column, value in zip(out, (lot, me, form, words, kept, names), strict=True):
                                column.append(value)
                    kinds = (pa.int32(), pa.int64(), pa.string(), pa.list_(pa.float32()), pa.binary(), pa.list_(pa.string()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["lot", "form_id", "form", "words", "kept", "lists"])

            dealt = spread(whole).mapInArrow(deal, "lot int, form_id long, form string, words array<float>, kept binary, lists array<string>")
            by = F.floor(F.col("lot") / rounds).cast("int") % parts
            return dealt.repartitionById(parts, by).sortWithinPartitions("lot").mapInArrow(meet, "a long, b long, sim double")

        pairs = cut_parts(one(k) for k in range(rounds))
        return keep(pairs if top is None else cut_table(_best(pairs, top)))


def _in_order(form: str, gram: int) -> list[str]:
    return sorted({g for grams in grams_of(form, gram) for g in grams})


def _weights(form: str, words: list[float], gram: int) -> list[float]:
    """The weights of the grams of a form in their order, out of those of its words."""
    out: dict[str, float] = {}
    for grams, w in zip(grams_of(form, gram), words, strict=True):
        for g in grams:
            out[g] = max(w, out.get(g, 0.0))
    return [out[g] for g in sorted(out)]


def _met(rows: list[tuple], gram: int, least: float) -> pa.RecordBatch:
    """Pairs of a lot: ``rows`` are (form_id, form, weights of its words, bits of its kept grams, its lists here by the gram's place)."""
    own = [_in_order(form, gram) for _, form, *_ in rows]
    number = {g: k for k, g in enumerate(sorted({g for grams in own for g in grams}))}
    columns = [np.array([number[g] for g in grams], np.int64) for grams in own]
    # Less than 0 where not kept.
    weights = [np.array(_weights(form, words, gram), np.float32) * np.where(np.unpackbits(np.frombuffer(kept, np.uint8), count=len(grams)), 1, -1).astype(np.float32) for grams, (_, form, words, kept, _) in zip(own, rows, strict=True)]
    texts = [tuple(form.split(" ")) for _, form, *_ in rows]
    lists: dict[tuple[str, ...], list[tuple[int, str]]] = {}
    for k, (*_, names) in enumerate(rows):
        for name in names:
            at, *piece = name.split("\t")
            low, high, mine = piece or ("0", "0", "0")
            lists.setdefault((own[k][int(at)], low, high), []).append((k, mine))
    out: list[tuple[int, int, float]] = []
    for (g, low, high), members in lists.items():
        if len(members) < 2:
            continue
        ks = [k for k, _ in members]
        flat = np.concatenate([columns[k] for k in ks])
        seen, place, times = np.unique(flat, return_inverse=True, return_counts=True)
        # A gram of one form adds nothing to any product.
        shared = np.cumsum(times > 1) - 1
        told = times[place] > 1
        cells = np.repeat(np.arange(len(ks)), [len(columns[k]) for k in ks])[told], shared[place[told]]
        values = np.concatenate([weights[k] for k in ks])[told]
        matrix = np.zeros((len(ks), int(shared[-1]) + 1), np.float32)
        matrix[cells] = np.abs(values)
        sims = matrix @ matrix.T
        hit = sims >= least
        # Pairs that have kept an earlier gram both come out there.
        before = int(np.searchsorted(seen[times > 1], number[g]))
        if before:
            matrix[cells] = values > 0
            hit &= matrix[:, :before] @ matrix[:, :before].T < 0.5
        if low != high:
            side = np.array([mine == low for _, mine in members])
            hit &= side[:, None] != side[None, :]
        for i, j in zip(*np.nonzero(np.triu(hit, 1))):
            if same_name(texts[ks[i]], texts[ks[j]]):
                x, y = rows[ks[i]][0], rows[ks[j]][0]
                out.append((min(x, y), max(x, y), float(sims[i, j])))
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["a", "b", "sim"])


def _best(pairs: DataFrame, top: int) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim"))
    best = both.withColumn("nth", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))).where(F.col("nth") <= top)
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sim").distinct()


def average_linkage(links: list[tuple[int, int, float]], least: float) -> dict[int, int]:
    """Cluster (its smallest node) of each node; the closest clusters merge while the mean of all their links reaches ``least``. A missing link counts 0."""
    size = {x: 1 for a, b, _ in links for x in (a, b)}
    members = {x: [x] for x in size}
    total: dict[int, dict[int, float]] = {x: {} for x in size}
    for a, b, s in links:
        if a != b:
            total[a][b] = total[b][a] = max(s, total[a].get(b, 0.0))
    while True:
        best = max(((s / (size[a] * size[b]), -a, -b) for a, near_ in total.items() for b, s in near_.items() if a < b), default=None)
        if best is None or best[0] < least:
            return {x: k for k, xs in members.items() for x in xs}
        a, b = -best[1], -best[2]
        for c, s in total.pop(b).items():
            total[c].pop(b)
            if c != a:
                total[a][c] = total[c][a] = total[a].get(c, 0.0) + s
        size[a] += size.pop(b)
        members[a] += members.pop(b)


def cluster(links: DataFrame, least: float = 0.2, most: int = 400) -> DataFrame:
    """(node, cluster) by average linkage over ``links`` (a, b, sim).

    Components of at most ``most`` links are clustered in one task each. Larger ones are clustered by rounds of joins
    in which all clusters that are each other's nearest merge; average linkage gives the same tree that way, and no
    component is ever held whole.
    """
    parts = components(links)
    within = links.join(parts.withColumnRenamed("node", "a"), "a")
    within = cut_table(within.join(within.groupBy("component").agg(F.count("*").alias("n")), "component"))

    def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, float]] = []
        last = None

        def settled() -> pa.RecordBatch:
            got = average_linkage(held, least)
            return pa.RecordBatch.from_arrays([pa.array(list(got), pa.int64()), pa.array(list(got.values()), pa.int64())], ["node", "cluster"])

        for batch in batches:
            for c, *link in zip(*(batch.column(n).to_pylist() for n in ("component", "a", "b", "sim")), strict=True):
                if c != last and held:
                    yield settled()
                    held = []
                last = c
                held.append(tuple(link))
        if held:
            yield settled()

    parts_n = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    done = within.where(F.col("n") <= most).select("component", "a", "b", "sim").repartition(parts_n, "component").sortWithinPartitions("component").mapInArrow(one_by_one, "node long, cluster long")
    big = within.where(F.col("n") > most).select("a", "b", "sim")
    if big.isEmpty():
        return done
    return done.unionByName(_by_rounds(big, least))


def _by_rounds(links: DataFrame, least: float) -> DataFrame:
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    own = cut_table(nodes.withColumn("cluster", F.col("node")))
    while True:
        size = own.groupBy("cluster").agg(F.count("*").alias("size"))
        near_ = links.join(own.toDF("a", "ca"), "a").join(own.toDF("b", "cb"), "b").where("ca <> cb").groupBy(F.least("ca", "cb").alias("x"), F.greatest("ca", "cb").alias("y")).agg(F.sum("sim").alias("total"))
        mean = near_.join(size.toDF("x", "sx"), "x").join(size.toDF("y", "sy"), "y").select("x", "y", (F.col("total") / (F.col("sx") * F.col("sy"))).alias("mean")).where(F.col("mean") >= least)
        order = F.struct("mean", -F.col("x"), -F.col("y"))
        best = mean.select("x", "y", "mean", F.explode(F.array("x", "y")).alias("me")).groupBy("me").agg(F.max_by(F.struct("x", "y"), order).alias("pair"))
        merge = cut_table(best.groupBy("pair").agg(F.count("*").alias("n")).where("n = 2").select(F.col("pair.y").alias("cluster"), F.col("pair.x").alias("into")))
        if merge.isEmpty():
            return own
        last, own = own, cut_table(own.join(merge, "cluster", "left").select("node", F.coalesce("into", "cluster").alias("cluster")))
        release(last)
        release(merge)


def link_names(records: DataFrame, id: str, name: str, other: str | None = None, least: float = 0.25, mean: float = 0.2, top: int | None = None) -> DataFrame:
    """The entity of every record with a name: (id, entity).

    Names are put into plain form (idle words dropped, shortened words and nicknames written out, order ignored) and
    each distinct form gets an n-gram vector. Pairs over the threshold are checked word by word (:func:`alike`) and
    grouped by average linkage. A name in ``other`` connects the entity of its record with
    the one that is registered under it, if the records of one entity only use it; a name that several entities use,
    or that nobody registered, connects nothing.

    Null, blank and signs-only names have no entity; repeated records count once; an id with several names has a row
    for each. Names of any length are read whole. Empty tables give no rows; other columns are ignored.
    """
    src = records.where(F.col(id).isNotNull()).select(F.col(id).alias("id"), F.col(name).alias("name"), (F.col(other) if other else F.lit(None)).cast("string").alias("other"))
    with passing(records.sparkSession) as keep:
        rows = cut_table(plain_names(spread(src), ["name", "other"]).where("name is not null").distinct())
        forms = cut_table(rows.select(F.col("name").alias("form")).union(rows.select("other")).where("form is not null").distinct().withColumn("form_id", F.monotonically_increasing_id()))
        with passing(records.sparkSession) as keep_groups:
            links = alike(forms, least, top=top).withColumn("sim", 0.5 + F.col("sim") / 2)
            groups = keep_groups(cut_table(forms.join(cluster(links, mean), F.col("form_id") == F.col("node"), "left").select("form", F.coalesce("cluster", "form_id").alias("cluster"))))
        release(forms)
        known = keep(cut_table(rows.join(groups.toDF("name", "mine"), "name").join(groups.toDF("other", "theirs"), "other", "left").select("id", "mine", "theirs")))
    used = known.where("theirs is not null and theirs <> mine").groupBy("theirs").agg(F.min("mine").alias("mine"), F.max("mine").alias("also")).where("mine = also")
    across = used.join(known.select(F.col("mine").alias("theirs")).distinct(), "theirs", "left_semi").select(F.col("mine").alias("a"), F.col("theirs").alias("b"))
    met = components(across)
    return known.join(met, F.col("mine") == F.col("node"), "left").select("id", F.coalesce("component", "mine").alias("entity")).distinct()
