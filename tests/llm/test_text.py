import random
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from placeloom.llm import leakage, repetition, survivorship, tokenization

T = datetime


# --- repeated content


def _share(words, run=5):
    grams = [tuple(words[i : i + run]) for i in range(len(words) - run + 1)]
    lying = {p for i, g in enumerate(grams) if g in grams[:i] for p in range(i, i + run)}
    return len(lying) / len(words) if words else 0.0


@given(st.lists(st.sampled_from("abc"), max_size=40))
@settings(max_examples=200, deadline=None)
def test_share_is_that_of_the_definition_and_rules_bound_it(words):
    share = repetition.repeated_share(words)
    assert share == pytest.approx(_share(words))
    text = " ".join(words)
    for rule in repetition.RULES.values():
        assert rule(text, lambda: words, 5) >= share - 1e-12


def test_repetition_of_a_table(spark):
    loop = "say it again and again my friend, "
    rows = [(1, loop * 50, 7), (2, "all of these words are quite different from one another here", 7), (3, None, 7), (4, "", 7), (5, " \n", 7), (1, loop * 50, 7), (6, "a1b2c3d4e5" * 20_000, 7), (None, loop * 9, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, share int")
    got = sorted((r.doc_id or 0 for r in repetition.repetition(df).collect()))
    assert got == [0, 1, 1, 6]
    exact = {r.doc_id: r.share for r in repetition.repetition(df, cascade=False).collect()}
    assert exact[3] is None and exact[4] == exact[5] == exact[2] == 0 and exact[1] == pytest.approx(_share(repetition.words_of(loop * 50)))
    assert repetition.repetition(df.where("false")).count() == 0


# --- leaked passages

ITEM = "when the old mill was sold its miller kept two keys and a ledger of every sack that left by the northern gate before the flood of that year took the bridge and half the road to town"
OTHER = "the glass house behind our school holds nine lemon trees whose fruit is picked by hand each winter and carried in baskets to the kitchen where three cooks make a dark marmalade"


def _leaks(spark, docs, items=((1, ITEM), (2, OTHER)), **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    return leakage.leaks(d, spark.createDataFrame(list(items), "item_id long, text string"), **kw)


def test_leaks(spark):
    w = ITEM.split()
    loose = " ".join("<b>" + x.upper() + "</b>," if i % 3 else x for i, x in enumerate(w[3:30]) if i % 10 != 7)
    docs = [
        (1, f"Before. {ITEM} After.", "x"), (2, loose.replace("e", "é"), "x"), (3, " ".join(w[:9]) + " and that is all", "x"), (4, None, "x"), (5, "", "x"), (6, "nothing to see " * 5000, "x"),
        (7, OTHER + " " + ITEM, "x"), (8, " ".join(reversed(w)), "x"), (1, f"Before. {ITEM} After.", "x"), (9, "x " * 50_000 + ITEM, "x"), (10, "​".join(ITEM), "x"),
    ]
    found = _leaks(spark, docs).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (1, 1), (2, 1), (7, 1), (7, 2), (9, 1), (10, 1)]
    assert all(docs[0][1][r.begin : r.end] == ITEM and r.coverage == 1 for r in found if r.doc_id == 1)
    blocks = _leaks(spark, docs, block_words=5).collect()
    assert sorted((r.doc_id, r.item_id) for r in blocks) == sorted((r.doc_id, r.item_id) for r in found)
    assert _leaks(spark, docs, items=[(None, ITEM), (3, None), (4, "")]).count() == 0
    assert leakage.leaks(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_stock_wording_of_many_items_is_no_leak(spark):
    stock = "details may change at short notice so please check with the office before you travel and bring proof of your booking with you"
    items = [(k, f"{OTHER if k == 0 else ITEM} item{k} {stock}") for k in range(6)]
    assert _leaks(spark, [(1, "we say that " + stock, "x")], items).count() == 0


def test_passages_of_shared_wording_are_leaks(spark):
    rng = random.Random(6)
    pieces = [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(7)) for _ in range(6)]
    # Each piece stands in three items and more, but none of their passages of 20 words does.
    items = [(k, " ".join(rng.sample(pieces, 5))) for k in range(12)] + [(k, ITEM) for k in (20, 21, 22)]
    w, t = items[0][1].split(), ITEM.split()
    changed = [x if i not in (1, 17) else "changed" for i, x in enumerate(t[5:25])]
    docs = [
        (1, "Before " + " ".join(w[4:24]), "x"), (2, " ".join(w[4:23]), "x"), (3, " ".join(t[3:23]) + " after", "x"), (4, " ".join(t[3:20]) + " after", "x"), (5, " ".join(changed), "x"),
        (6, " ".join(x for i, x in enumerate(w[4:25]) if i not in (6, 12)), "x"), (7, items[0][1], "x"),
    ]
    for kw in ({}, {"block_words": 40}):
        got = {(r.doc_id, r.item_id) for r in _leaks(spark, docs, items, **kw).collect()}
        assert {(1, 0), (6, 0), (7, 0)} <= got and {(d, k) for d in (3, 5) for k in (20, 21, 22)} <= got
        assert not any(d == 4 for d, _ in got)
    # Where one item is held whole, others that differ from it in two words of 20 are not.
    near = [(40, ITEM)] + [(k, " ".join(f"other{k}" if i in (6, 12) else x for i, x in enumerate(t[5:25])) + f" {k} and {OTHER}") for k in (41, 42, 43)]
    for kw in ({}, {"block_words": 40}):
        assert {r.item_id for r in _leaks(spark, [(1, ITEM, "x")], near, **kw).collect()} == {40}


def test_scrub(spark):
    docs = spark.createDataFrame([(1, f"Before. {ITEM} After."), (2, "clean"), (3, None)], "doc_id long, text string")
    found = leakage.leaks(docs, spark.createDataFrame([(1, ITEM)], "item_id long, text string"))
    assert {r.doc_id: (r.text, r.removed) for r in leakage.scrub(docs, found).collect()} == {1: ("Before.  After.", len(ITEM)), 2: ("clean", 0), 3: (None, 0)}


def test_scrub_cuts_what_leaks_reports(spark):
    part = " ".join(ITEM.split()[4:22])
    docs = spark.createDataFrame([(1, f"Before xx {part} xx after.")], "doc_id long, text string")
    found = leakage.leaks(docs, spark.createDataFrame([(1, ITEM)], "item_id long, text string"))
    assert [r.span for r in found.collect()] == [18]
    assert [(r.text, r.removed) for r in leakage.scrub(docs, found).collect()] == [("Before xx  xx after.", len(part))]


def test_automaton_finds_all_shared_runs():
    rng = random.Random(4)
    items = [(k, rng.choices("abcd", k=30)) for k in range(5)]
    tree, words = leakage.Automaton(items, 3), rng.choices("abcd", k=200)
    got = {(k, i, p) for k, hits in tree.read(words).items() for i, p, _ in hits}
    assert got == {(k, i, p) for k, (_, w) in enumerate(items) for i in range(2, 200) for p in range(2, 30) if words[i - 2 : i + 1] == w[p - 2 : p + 1]}


# --- token ids


def test_ids_equal_those_of_the_tokenizer(spark):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(str(P.path("byte_bpe_50k.json")))
    tok.encode_special_tokens = True
    rng = random.Random(5)
    bits = ["a", "é", "é", " ", "  ", "\n", "\t", " ", " ", "​", "\x1c", "\x85", "'s", "'LL", "1", "½", "中", "!", "<|endoftext|>", "👩‍🍳", "﻿", "͸", "\U00031350", "\U000323b0", "Ⅷ", "_", "\r\n", "　", "᠎"]
    texts = ["", None, " ", "the " * 30_000, "x" * 20_000] + ["".join(rng.choices(bits, k=rng.randint(1, 14))) for _ in range(600)]
    df = spark.createDataFrame([(i, t, "y") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    out = tokenization.encode(df)
    got = {r.doc_id: r.ids for r in out.collect()}
    assert got == {i: None if t is None else tok.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    back = {r.doc_id: r.text for r in tokenization.decode(out).collect()}
    assert back == dict(enumerate(texts))
    assert tokenization.encode(df.where("false")).count() == 0


# --- survivors

RECORDS = "fsa long, id string, source string, seen_at timestamp, phone string, website string, opening_hours_osm string, winner_id int"
TRUST = [("osm", "phone", 0.6), ("nhs", "phone", 0.8), ("osm", "website", 0.7), ("nhs", "website", 0.7), ("osm", "opening_hours_osm", 0.8)]


def _survivors(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 0) for r in rows], RECORDS)
    out = survivorship.survivors(df, spark.createDataFrame(TRUST, "source string, field string, weight double"), "fsa", **kw)
    return {(r.group_key, r.field): (r.winner_id, r.value) for r in out.collect()}


def test_winner_by_trust_then_time_then_id(spark):
    rows = [
        (1, "a", "osm", T(2030, 1, 2), "01632 000001", "http://a.example/x", "n/a"), (1, "b", "nhs", T(2029, 1, 1), "+44 1632 000002", "www.b.example", None), (1, "b", "nhs", T(2029, 1, 1), "+44 1632 000002", "www.b.example", None),
        (2, "c", "osm", T(2030, 1, 1), "0000000000", "https://www.", "24/7"), (2, "d", "osm", T(2030, 1, 1), "call", "www.d", "Mo-Fr 09:00-17:00"),
        (3, "e", "osm", T(2030, 1, 1), "01632 000003", None, None), (None, "f", "osm", T(2030, 1, 1), "01632 000004", None, None),
        (4, "g", None, None, "01632 000005", None, None), (4, "h", "zzz", T(2030, 1, 1), "01632 000006", None, None), (4, None, "nhs", T(2031, 1, 1), "01632 000007", None, None),
    ]
    assert _survivors(spark, rows, strength=None, vote="max") == {(1, "phone"): ("b", "+44 1632 000002"), (1, "website"): ("a", "http://a.example/x"), (2, "opening_hours_osm"): ("c", "24/7"), (4, "phone"): ("h", "01632 000006")}
    assert _survivors(spark, [], strength=None, vote="max") == {}


def test_reliability_is_learnt_from_agreement(spark):
    rows = []
    for g in range(40):
        rows += [(g, f"{g}-{s}", s, T(2030, 1, 1), f"01632 {v:06}", None, None) for s, v in (("osm", g), ("atp", g), ("nhs", 900_000 + g), ("ch", g))]
    out = _survivors(spark, rows, strength=2.0)
    assert all(v == f"01632 {g:06}" for (g, _), (_, v) in out.items()) and len(out) == 40
