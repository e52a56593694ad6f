"""Repeated content inside single documents, by a cascade of rules ordered by what each rejects for its cost."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeloom.plans.cut import spread

_LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case."""
    return _LETTERS.findall(text.lower())


def repeated_share(words: list[str], run: int = 5) -> float:
    """Share of the words that lie in a run of ``run`` words which already began earlier; 0 without words."""
    seen: set[tuple[str, ...]] = set()
    lying = upto = 0
    for i, gram in enumerate(zip(*(words[k:] for k in range(run)), strict=False)):
        if gram in seen:
            lying += i + run - max(upto, i)
            upto = i + run
        else:
            seen.add(gram)
    return lying / len(words) if words else 0.0


# Each rule gives an upper bound of the share; a document whose bound stays under the limit is rejected.


def _few_words(text: str, words: Callable[[], list[str]], run: int) -> float:
    """A repeated run needs ``run + 1`` words and the gaps between them."""
    return 1.0 if len(text) > 2 * run else 0.0


def _squeezed(text: str, words: Callable[[], list[str]], run: int) -> float:
    """Every word of a repeated run has occurred before, so the share is at most that of the later copies of words."""
    w = words()
    return 1 - len(set(w)) / len(w) if w else 0.0


def _pairs(text: str, words: Callable[[], list[str]], run: int) -> float:
    """The same with pairs of words: of a repeated run all but one word begin a repeated pair."""
    w = words()
    if len(w) < 2:
        return 0.0
    again = len(w) - 1 - len(set(zip(w, w[1:], strict=False)))
    return again * run / (run - 1) / len(w)


RULES: dict[str, Callable[[str, Callable[[], list[str]], int], float]] = {"few_words": _few_words, "squeezed": _squeezed, "pairs": _pairs}


def order_rules(sample: list[str], limit: float, run: int) -> list[tuple[str, float, float]]:
    """(rule, rejected share, seconds a text), by rejection per cost, greedily: each rule is judged on the texts that the rules before it let pass."""
    left, ordered, rest = list(sample), [], dict(RULES)
    while rest:
        tried = []
        for name, rule in rest.items():
            began = time.perf_counter()
            passed = [t for t in left if rule(t, lambda t=t: words_of(t), run) >= limit]
            cost = (time.perf_counter() - began) / max(1, len(left))
            rejected = 1 - len(passed) / max(1, len(left))
            tried.append((rejected / max(cost, 1e-9), name, rejected, cost, passed))
        _, name, rejected, cost, left = max(tried)
        ordered.append((name, rejected, cost))
        rest.pop(name)
    return ordered


def repetition(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    limit: float = 0.3,
    run: int = 5,
    cascade: bool = True,
    sample_rows: int = 500,
) -> DataFrame:
    """Repeated share of each document: (doc_id, share, stage).

    With ``cascade`` only documents whose share reaches ``limit`` come out. Cheap rules that bound the share from
    above run first; their cost and rejection are measured on a sample of about ``sample_rows`` texts and the rules
    are ordered by rejection per cost. They never reject a document that reaches the limit, so the sample decides
    the speed, not the result. ``stage`` tells how many rules a document that comes
    out has passed, the exact one among them. Without ``cascade`` every document comes
    out with its exact share.

    A word is a run of letters; letter case, digits and punctuation don't count. A null text has a null share
    (and no row with ``cascade``); a text without words has share 0. Whole texts are read; repeated rows come out
    for each repetition; an empty table gives no rows; a null id stays null. Other columns are ignored.
    """
    docs = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rules: list[str] = []
    if cascade:
        docs = docs.where(F.col("text").isNotNull())
        n = docs.count()
        sample = [r["text"] for r in docs.select("text").sample(False, min(1.0, sample_rows / max(1, n)), 11).limit(2 * sample_rows).collect()]
        rules = [name for name, rejected, _ in order_rules(sample, limit, run) if rejected > 0.02] if sample else list(RULES)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, shares, stages = [], [], []
            for i, t in enumerate(b.column("text")):
                t = t.as_py()
                if t is None:
                    keep.append(i), shares.append(None), stages.append(0)
                    continue
                held: list[list[str]] = []

                def words(t=t, held=held) -> list[str]:
                    if not held:
                        held.append(words_of(t))
                    return held[0]

                if any(RULES[r](t, words, run) < limit for r in rules):
                    continue
                share = repeated_share(words(), run)
                if not cascade or share >= limit:
                    keep.append(i), shares.append(share), stages.append(len(rules) + 1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(keep, pa.int64())), pa.array(shares, pa.float64()), pa.array(stages, pa.int32())], ["doc_id", "share", "stage"])

    return spread(docs).mapInArrow(scan, f"doc_id {kind}, share double, stage int")
