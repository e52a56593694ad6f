"""Evaluation passages inside training text, found with a generalised suffix automaton over words."""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from placeloom.plans.cut import spread

_TAG = re.compile(r"<[/!]?[A-Za-z][^<>]*>|<!--.*?-->|&#?\w{1,10};", re.S)
_INVISIBLE = "­​‌‍⁠﻿"
_SECOND = "\u0080-¿€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
_WORD = re.compile(rf"(?:Ã[{_SECOND}]|[^\W_]|[{_INVISIBLE}̀-ͯ])+")
_BROKEN = re.compile(rf"Ã[{_SECOND}]")
_ACCENT = re.compile(rf"[{_INVISIBLE}\u0300-\u036f]+")
_LETTERS = re.compile(r"[^\W_]+")


def _mend(m: re.Match) -> str:
    for code in ("cp1252", "latin-1"):
        try:
            return m[0].encode(code).decode()
        except UnicodeError:
            pass
    return m[0]


def _plain(text: str) -> str:
    """Letter case, accents, invisible signs and doubly encoded letters taken away."""
    if text.isascii():
        return text.lower()
    if "Ã" in text:
        text = _BROKEN.sub(_mend, text)
    return _ACCENT.sub("", unicodedata.normalize("NFKD", text.casefold()))


def _unmarked(text: str) -> str:
    return _TAG.sub(lambda m: " " * len(m[0]), text) if "<" in text or "&" in text else text


def plain_words(text: str) -> list[str]:
    """Normalised words of ``text``."""
    return _LETTERS.findall(_plain(_unmarked(text)))


def places_of(text: str) -> tuple[list[int], list[int]]:
    """First and last position in ``text`` of each of its :func:`plain_words`."""
    found = [m.span() for m in _WORD.finditer(_unmarked(text)) for _ in _LETTERS.findall(_plain(m[0]))]
    return [a for a, _ in found], [b for _, b in found]


class Automaton:
    """Generalised suffix automaton of the items' words. ``seeds[s]`` holds every (item, position, whether at most two texts have them) at which the last ``seed`` words read occur."""

    def __init__(self, items: list[tuple[object, list[str]]], seed: int, common: list[set[int]] | None = None):
        """``common`` holds, for each item, where the runs of ``seed`` words begin that more than two texts have."""
        self.seed, self.names = seed, [name for name, _ in items]
        self.common = common or [set()] * len(items)
        step, link, size = [{}], [-1], [0]
        ends: list[list[tuple[int, int]]] = [[]]
        for k, (_, words) in enumerate(items):
            last = 0
            for pos, w in enumerate(words):
                if (q := step[last].get(w)) is not None:
                    if size[q] == size[last] + 1:
                        last = q
                    else:
                        last = self._clone(step, link, size, ends, last, w, q)
                else:
                    cur = len(step)
                    step.append({}), link.append(0), size.append(size[last] + 1), ends.append([])
                    p = last
                    while p != -1 and w not in step[p]:
                        step[p][w] = cur
                        p = link[p]
                    if p != -1:
                        q = step[p][w]
                        link[cur] = q if size[q] == size[p] + 1 else self._clone(step, link, size, ends, p, w, q)
                    last = cur
                ends[last].append((k, pos))
        self.step, self.link, self.size = step, link, size
        # Occurrences gather at the states whose shortest string has at most `seed` words and whose longest has at least as many.
        self.home = [-1] * len(step)
        gathered: dict[int, list[tuple[int, int, bool]]] = {}
        for s in sorted(range(1, len(step)), key=size.__getitem__):
            if size[s] >= seed:
                up = link[s]
                h = self.home[s] = s if size[up] < seed else self.home[up]
                gathered.setdefault(h, []).extend((k, p, p - seed + 1 not in self.common[k]) for k, p in ends[s])
        self.seeds = {h: np.array(found, np.int64).reshape(-1, 3) for h, found in gathered.items()}

    @staticmethod
    def _clone(step, link, size, ends, p, w, q) -> int:
        new = len(step)
        step.append(dict(step[q])), link.append(link[q]), size.append(size[p] + 1), ends.append([])
        link[q] = new
        while p != -1 and step[p].get(w) == q:
            step[p][w] = new
            p = link[p]
        return new

    def spots(self, words: list[str]) -> list[tuple[int, int]]:
        """(position in ``words``, state) of the ends of all runs of ``seed`` words that an item shares."""
        step, link, size, home, need = self.step, self.link, self.size, self.home, self.seed
        out: list[tuple[int, int]] = []
        root = step[0]
        s = n = 0
        for i, w in enumerate(words):
            if s:
                while s and w not in step[s]:
                    s = link[s]
                    n = size[s]
                s = step[s].get(w, 0)
                n = n + 1 if s else 0
            else:
                s = root.get(w, 0)
                n = 1 if s else 0
            if s and n >= need:
                out.append((i, home[s]))
        return out

    def read(self, words: list[str], gap: int = 1, least: float = 0) -> dict[int, list[tuple[int, int, bool]]]:
        """Item -> (position in ``words``, position in the item, whether at most two texts have it) of the ends of all shared runs of ``seed`` words.

        Left out are runs that lie with too few others, at most ``gap`` words apart in ``words``, to cover ``least`` words; a chain of ``least`` words has none of them.
        """
        spots = self.spots(words)
        if not spots or self.seed * len(spots) < least:
            return {}
        at = np.fromiter((i for i, _ in spots), np.int64, len(spots))
        found = [self.seeds[state] for _, state in spots] if together(at, np.zeros_like(at), self.seed, gap, least).any() else []
        if not found:
            return {}
        at = np.repeat(at, [len(f) for f in found])
        item, pos, rare = np.concatenate(found).T
        order = np.lexsort((pos, at, item))
        item, at, pos, rare = item[order], at[order], pos[order], rare[order]
        ok = together(at, item, self.seed, gap, least)
        hits: dict[int, list[tuple[int, int, bool]]] = {}
        for k, *hit in zip(*(x[ok].tolist() for x in (item, at, pos, rare))):
            hits.setdefault(k, []).append(tuple(hit))
        return hits


def together(at: np.ndarray, item: np.ndarray, seed: int, gap: int, least: float) -> np.ndarray:
    """Which ends ``at`` of runs of ``seed`` words, in order within an ``item``, lie among others at most ``gap`` words apart that cover ``least`` words with them."""
    away = np.diff(at, prepend=0)
    new = np.diff(item, prepend=-1) != 0
    new |= away > gap + seed
    new[0] = True
    group = np.cumsum(new) - 1
    return np.bincount(group, np.where(new, seed, np.minimum(away, seed)))[group] >= least


def chains(hits: list[tuple[int, int, bool]], seed: int, gap: int, least: float = 0) -> Iterator[tuple[int, int, int, int, int, int, list[tuple[int, int]]]]:
    """(matched words, first, last word in the text, first, last word in the item, rare runs, ends of the runs) of the runs that follow each other in both, at most ``gap`` words apart, if ``least`` words match."""
    best: list[tuple[int, int, int, int]] = []  # matched words, first in the text, first in the item, rare runs
    before: list[int] = []
    used = set()
    low = 0
    hits = sorted(set(hits))
    for j, (i, p, rare) in enumerate(hits):
        mine, back = (seed, i - seed + 1, p - seed + 1, rare), -1
        while hits[low][0] < i - gap - seed:
            low += 1
        for h in range(j - 1, low - 1, -1):
            di, dp = i - hits[h][0], p - hits[h][1]
            if di > 0 and 0 < dp <= gap + seed:
                got = best[h][0] + min(di, dp, seed)
                if got > mine[0]:
                    mine, back = (got, best[h][1], best[h][2], best[h][3] + rare), h
                    if di == dp == 1:
                        break
        if back >= 0:
            used.add(back)
        best.append(mine)
        before.append(back)
    for j, (i, p, _) in enumerate(hits):
        if j not in used and best[j][0] >= least:
            ends, h = [], j
            while h >= 0:
                ends.append(hits[h][:2])
                h = before[h]
            yield best[j][0], best[j][1], i, best[j][2], p, best[j][3], ends[::-1]


def _onward(words: list[str], i: int, item: list[str], p: int, step: int, changes: int) -> list[tuple[int, int]]:
    """Equal words (position in ``words``, in ``item``) from a place on, in the direction ``step``, over at most ``changes`` changed or left out words."""
    out = []
    while 0 <= i < len(words) and 0 <= p < len(item) and words[i] == item[p]:
        out.append((i, p))
        i, p = i + step, p + step
    if changes and 0 <= i < len(words) and 0 <= p < len(item):
        out += max((_onward(words, at, item, p + step, step, changes - 1) for at in (i + step, i)), key=len)
    return out


def _between(words: list[str], text: range, item: list[str], own: range) -> dict[int, int]:
    """Most equal words (position in ``item`` -> in ``words``) of two short ranges, in their order."""
    best: list[dict[int, int]] = [{} for _ in range(len(text) + 1)]
    for q in own:
        row = [best[0]]
        for k, i in enumerate(text):
            row.append(best[k] | {q: i} if words[i] == item[q] else max(best[k + 1], row[k], key=len))
        best = row
    return best[-1]


def kept_words(words: list[str], item: list[str], chain: tuple, seed: int, changes: int) -> tuple[dict[int, int], dict[int, int]]:
    """(position in the item -> in ``words``, of every equal word of a chain, words between its runs and up to ``changes`` changes past its ends included; words too many before a position in the item)."""
    kept = {p - s: i - s for i, p in chain[6] for s in range(seed)}
    runs, extra = sorted(kept), {}
    for a, b in zip(runs, runs[1:]):
        if kept[b] - kept[a] > b - a:
            extra[b] = kept[b] - kept[a] - (b - a)
        kept |= _between(words, range(kept[a] + 1, kept[b]), item, range(a + 1, b))
    for i, p in _onward(words, chain[1] - 1, item, chain[3] - 1, -1, changes) + _onward(words, chain[2] + 1, item, chain[4] + 1, 1, changes):
        kept[p] = i
    return kept, extra


def passage(kept: dict[int, int], extra: dict[int, int], length: int, least_words: int, most_changed: float, stock: set[int]) -> list[int]:
    """Positions of the kept words of an item of ``length`` words from the first to the last that belongs to a window of
    ``least_words`` or more of its words of which about ``most_changed`` are changed, left out or too many; empty if there
    is none. Windows whose wording is stock throughout don't count; ``stock`` holds where such wording begins."""
    low, high = max(0, min(kept) - least_words), min(length, max(kept) + 1 + least_words)
    total = [0]
    for q in range(low, high):
        total.append(total[-1] + (q in kept) - extra.get(q, 0))
    first = last = None
    for n in range(least_words, min(high - low, least_words + least_words // 2) + 1):
        need = n - int(n * most_changed + 0.5)
        for p in range(low, high - n + 1):
            if total[p + n - low] - total[p - low] >= need:
                own = [q for q in range(p, p + n) if q in kept]
                if not all(q in stock for q in range(own[0], own[-1] + 2 - stock_words(least_words, most_changed))):
                    first, last = own[0] if first is None else min(first, own[0]), own[-1] if last is None else max(last, own[-1])
    return [] if first is None else [q for q in sorted(kept) if first <= q <= last]


def stock_words(least_words: int, most_changed: float) -> int:
    """Words of the shortest passage: ``least_words`` without the changed ones."""
    return least_words - int(least_words * most_changed + 0.5)


def plain_items(items: DataFrame, lengths: list[int]) -> DataFrame:
    """(item_id, words, text_key, common): the items' normalised words, a key of equal texts, and for each of ``lengths`` where the runs of so many words begin that stand in more than two different texts."""
    kind = items.schema["item_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array([plain_words(t) for t in b.column("text").to_pylist()], pa.list_(pa.string()))], ["item_id", "words"])

    plain = items.mapInArrow(read, f"item_id {kind}, words array<string>").withColumn("text_key", F.sha2(F.array_join("words", " "), 256))
    texts = plain.select("text_key", "words").dropDuplicates(["text_key"])
    for k, n in enumerate(lengths):
        starts = F.sequence(F.lit(0), F.size("words") - n)
        runs = texts.where(F.size("words") >= n).select("text_key", F.explode(starts).alias("pos"), "words").select("text_key", "pos", F.array_join(F.slice("words", F.col("pos") + 1, n), " ").alias("run"))
        many = runs.select("run", "text_key").distinct().groupBy("run").agg(F.count("*").alias("n")).where("n > 2").select("run")
        plain = plain.join(runs.join(many, "run").groupBy("text_key").agg(F.collect_list("pos").alias(f"common{k}")), "text_key", "left")
    return plain.select("item_id", "words", "text_key", F.array(*(F.coalesce(f"common{k}", F.array().cast("array<int>")) for k in range(len(lengths)))).alias("common"))


def leaks(
    documents: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least_words: int = 20,
    least_share: float = 0.75,
    least_rare: int = 4,
    seed: int = 3,
    gap: int = 5,
    block_words: int = 200_000,
    most_changed: float = 0.1,
) -> DataFrame:
    """Passages of items in documents: (doc_id, item_id, matched, span, coverage, begin, end).

    Words are compared without letter case, punctuation, accents, invisible signs and markup. Each text is streamed
    once through a generalised suffix automaton of the items' words; the matches of at least ``seed`` words are
    chained where they follow each other in text and item, at most ``gap`` words apart, so that changed and missing
    words do not break a passage. A passage is reported

    * if ``least_words`` or more words of the item stand in the text in their order, about ``most_changed`` of them
      changed or left out. Wording that more than two different item texts have throughout is stock and doesn't count,
      and where another item's passage has more of the text's words of that place, the passage is that item's;
    * if it spans ``least_words`` words of the item (a tenth less, as its ends may be changed words), of which
      ``least_share`` match, and ``least_rare`` of its runs stand in at most two different item texts, or it has half
      as many words again.

    ``coverage`` is the share of the item that it spans; ``begin`` and ``end`` are its place in the text. Of
    overlapping passages of one item the longest is reported.

    The items are taken in blocks of about ``block_words`` words, each of which is held by every task, and every
    block meets all documents; so memory does not grow with either table, and what is common to items is counted over
    all of them. Null, empty and blank texts, and null ids, have no passages. Repeated documents and repeated items
    each come out once for every repetition. Whole texts are read. Empty tables give no rows.
    """
    docs = spread(documents.where(F.col(text).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).withColumn("doc_key", F.xxhash64("text"))
    known = items.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    item_type = known.schema["item_id"].dataType
    kinds = docs.schema["doc_id"].dataType.simpleString(), item_type.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, matched int, span int, coverage double, begin int, end int, doc_key long, text_key string, close boolean, at array<int>"
    changes = int(least_words * most_changed + 0.5)

    def against(block: list[tuple[object, list[str], str, list[set[int]]]]) -> DataFrame:
        held = documents.sparkSession.sparkContext.broadcast(block)
        name = uuid.uuid4().hex

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree, told = _tree(name, held, seed)
            for b in batches:
                out: list[list] = [[] for _ in range(11)]
                for d, t, dk in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("doc_key").to_pylist(), strict=True):
                    words = plain_words(t)
                    if len(words) < least_words * least_share:
                        continue
                    first = last = None
                    for k, hits in tree.read(words, gap, 0.6 * least_words).items():
                        if len(hits) < least_words * least_share * 0.4:
                            continue
                        item, key, stock = told[k]
                        got = []
                        # Past its ends, and between its runs, a passage has more equal words than the runs hold.
                        for c in chains(hits, seed, gap, 0.6 * least_words):
                            span = c[4] - c[3] + 1
                            if span >= 0.9 * least_words and c[0] >= least_share * span and (c[5] >= least_rare or c[0] >= 1.5 * least_words):
                                at = sorted({i - s for i, _ in c[6] for s in range(seed)})
                                got.append((c[0], c[1], c[2], c[3], c[4], False, at))
                            else:
                                kept, extra = kept_words(words, item, c, seed, changes + 1)
                                if own := passage(kept, extra, len(item), least_words, most_changed, stock):
                                    at = sorted(kept[q] for q in own)
                                    got.append((len(own), at[0], at[-1], own[0], own[-1], True, at))
                        if got and first is None:
                            first, last = places_of(t)
                        taken: list[tuple[int, int]] = []
                        for n, i, j, p, q, close, at in sorted(got, key=lambda c: (-c[0], c[1], c[3])):
                            if all(j < o or i > u for o, u in taken):
                                taken.append((i, j))
                                row = (d, tree.names[k], n, q - p + 1, (q - p + 1) / len(item), first[i], last[j], dk, key, close, at)
                                for column, v in zip(out, row, strict=True):
                                    column.append(v)
                types = [*_types(b, item_type), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], [f.split(" ")[0] for f in schema.split(", ")])

        return docs.mapInArrow(scan, schema)

    found, block, size = None, [], 0
    for row in plain_items(known, [seed, stock_words(least_words, most_changed)]).toLocalIterator():
        block.append((row["item_id"], row["words"], row["text_key"], [set(c) for c in row["common"]]))
        size += len(row["words"])
        if size >= block_words:
            found, block, size = (against(block) if found is None else found.unionByName(against(block))), [], 0
    if block or found is None:
        found = against(block) if found is None else found.unionByName(against(block))
    return _own(found)


_trees: dict[str, tuple] = {}


def _tree(name: str, held: Broadcast, seed: int) -> tuple[Automaton, list[tuple[list[str], str, set[int]]]]:
    """The automaton of a block of items, built where it is used, and (words, text_key, stock) of each item; a worker holds one at a time."""
    if name not in _trees:
        _trees.clear()
        block = held.value
        _trees[name] = Automaton([(item, words) for item, words, _, _ in block], seed, [common[0] for *_, common in block]), [(words, key, common[1]) for _, words, key, common in block]
    return _trees[name]


def _own(found: DataFrame) -> DataFrame:
    """``found`` without the close wordings of whose place in the text another item's passage has more words."""
    names = ["item_id", "matched", "span", "coverage", "begin", "end"]
    more = lambda x: lambda y: (y["text_key"] != x["text_key"]) & (F.size(F.filter(y["at"], lambda i: (i >= F.array_min(x["at"])) & (i <= F.array_max(x["at"])))) > F.size(x["at"]))
    all_ = found.groupBy("doc_id", "doc_key").agg(F.collect_list(F.struct(*names, "text_key", "close", "at")).alias("all"))
    left = all_.select("doc_id", F.explode(F.filter("all", lambda x: ~(x["close"] & F.exists("all", more(x))))).alias("one"))
    return left.select("doc_id", *(F.col(f"one.{n}").alias(n) for n in names))


def _types(batch: pa.RecordBatch, item_type: DataType) -> list[pa.DataType]:
    return [batch.schema.field("doc_id").type, to_arrow_type(item_type), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32()]


def scrub(documents: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = 20, most_coverage: float = 1.0) -> DataFrame:
    """``documents`` with the found passages cut out that span ``least_words`` words (a tenth less, as in :func:`leaks`) or cover ``most_coverage`` of an item; adds ``removed`` (characters).

    A text without such a passage stays as it is, null included; overlapping passages are cut once.
    """
    spans = (
        found.where((F.col("span") >= 0.9 * least_words) | (F.col("coverage") >= most_coverage))
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("_cuts"))
        .withColumnRenamed("doc_id", "_doc")
    )
    zero = F.struct(F.lit("").alias("kept"), F.lit(0).alias("at"))
    # Positions of Python and SQL both count characters.
    part = lambda acc, c: F.struct(
        F.concat(acc["kept"], F.when(c["begin"] > acc["at"], F.substring(F.col(text), acc["at"] + 1, c["begin"] - acc["at"])).otherwise(F.lit(""))).alias("kept"),
        F.greatest(acc["at"], c["end"]).alias("at"),
    )
    done = F.aggregate("_cuts", zero, part, lambda acc: F.concat(acc["kept"], F.substring(F.col(text), acc["at"] + 1, F.length(text))))
    joined = documents.join(spans, F.col(doc_id) == F.col("_doc"), "left").withColumn("_new", F.when(F.col("_cuts").isNotNull(), done).otherwise(F.col(text)))
    return joined.withColumn("removed", F.coalesce(F.length(text) - F.length("_new"), F.lit(0))).withColumn(text, F.col("_new")).drop("_new", "_cuts", "_doc")
