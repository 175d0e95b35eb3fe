"""Ranked search against a brute-force version."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from stipend.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id bigint, text string, id string, score int, rank int, text_no int"
ITEMS = "item_id bigint, text string, `item` string, score int"


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def expected(docs, items, k):
    found = [(d, terms(t)) for d, t in docs]
    with_terms = sum(bool(t) for _, t in found)
    total = sum(len(t) for _, t in found)
    holding = Counter(x for _, t in found for x in set(t))
    out = Counter()
    for item, text in items:
        scored = []
        for doc, t in found:
            tf, score = Counter(t), 0
            for x in terms(text):
                if tf[x]:
                    w = math.floor(1000 * math.log((2 * with_terms + 2) / (2 * holding[x] + 1)))
                    m = 75 + 25 * len(t) * with_terms // total
                    score += w * (1_000_000_000 * tf[x] // (1000 * tf[x] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scored)[:k], 1):
            out[item, rank, doc, -score] += 1
    return out


def sample():
    rng = random.Random(7)
    words = ["stone", "STONE", "sto", "one", "river", "naïve", "Über", "東京", "x1", "a", "привет", "tone"]
    docs = [(n, " ,;\n"[n % 4].join(rng.choice(words) for _ in range(rng.randrange(1, 30)))) for n in range(60)]
    docs += [(100, None), (101, ""), (102, " .;\n"), (103, docs[3][1]), (104, docs[3][1]), docs[5], docs[5],
             (None, docs[3][1]), (None, None), (105, "stone river " * 9000), (106, "ÜBER über stone one")]
    items = [(n, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 9)))) for n in range(15)]
    items += [items[2], (50, items[2][1]), (51, None), (52, ""), (53, "absent"), (None, "river, one"), (54, "-- a")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 16])
def test_search(spark, block_bytes):
    docs, items = sample()
    rows = spark.createDataFrame([(*d, "x", 1, 2, 3) for d in docs], DOCS).repartition(3)
    asked = spark.createDataFrame([(*i, "y", 1) for i in items], ITEMS).repartition(2)
    got = lexical.search(rows, asked, 4, block_bytes=block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == expected(docs, items, 4)


def test_search_of_nothing(spark):
    docs, items = sample()
    rows = spark.createDataFrame([(*d, "x", 1, 2, 3) for d in docs], DOCS)
    asked = spark.createDataFrame([(*i, "y", 1) for i in items], ITEMS)
    for d, i in ((rows.limit(0), asked), (rows, asked.limit(0)), (rows.where("doc_id = 100"), asked),
                 (rows, asked.where("item_id > 50 and item_id < 54"))):
        assert lexical.search(d, i, 3).count() == 0


def test_long_texts_are_searched_in_pieces(monkeypatch):
    monkeypatch.setattr(lexical, "_PIECE", 7)
    rng = random.Random(1)
    text = " ".join(rng.choice(["ab", "abc", "b", "ü" * 40]) for _ in range(200)).encode()
    folded = text.translate(lexical._FOLD)
    known = [b"ab", b"b", "ü".encode() * 40, b"c"]
    counts = lexical.count_terms(lexical.automaton(known), folded)
    want = Counter(lexical.terms_of(text))
    assert {known[n]: c for n, c in counts.items()} == {t: want[t] for t in known if want[t]}


def test_rows_held_by_a_task_are_bounded(monkeypatch):
    monkeypatch.setattr(lexical, "_HELD", 10)
    scorer = lexical._Scorer([(0, 0, 5), (0, 1, 7), (1, 1, 2)], 2, [10, 11], 100, 1000, 3)
    best, rng, every = lexical._Best(scorer), random.Random(2), []
    for doc in rng.sample(range(500), 200):
        counts = Counter({0: rng.randrange(1, 4), 1: 1})
        best.offer(doc, 10, counts)
        every += [(n, -s, doc) for n, s in zip((10, 11), scorer.scores(10, counts).tolist())]
        assert best.size <= 14
    want = [sorted(r for r in every if r[0] == n)[:3] for n in (10, 11)]
    got = sorted((r["text_no"], -r["score"], r["id"]) for r in best.rows().to_pylist())
    assert got == want[0] + want[1]


def test_scores_do_not_overflow():
    scorer = lexical._Scorer([(0, 0, 24_000 * 1_000_000)], 1, [1], 50_000_000_000, 10**13, 1)
    got = scorer.scores(10_000_000_000, Counter({0: 5_000_000_000}))
    m = 75 + 25 * 10_000_000_000 * 50_000_000_000 // 10**13
    assert got.dtype == np.int64 and got[0] == 24_000 * 10**6 * (10**9 * 5 * 10**9 // (5 * 10**12 + 12 * m))
