"""MinHash near-duplicates against a brute-force version."""

import random

import numpy as np
import pytest

from stipend.llm import minhash

SCHEMA = "doc_id bigint, text string, node int, n int, row string, kept int, k1 int"


def sets_of(texts, words):
    out = []
    for text in texts:
        found = (text or "").encode().lower().split()
        joined = [b" ".join(found[n : n + words]) for n in range(len(found) - words + 1)]
        out.append(set(joined or ([b" ".join(found)] if found else [])))
    return out


def expected(rows, words=2, percent=80):
    sets = sets_of([t for _, t in rows], words)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in enumerate(sets):
        for b, y in enumerate(sets[:a]):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[root(a)] = root(b)
    least = {}
    for n, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(n)] = min(least.get(root(n), doc), doc)
    out = []
    for n, (doc, _) in enumerate(rows):
        component = least.get(root(n)) if sets[n] else doc
        out.append((doc, len(sets[n]), component, not sets[n] or (doc is not None and doc == component)))
    return sorted(map(str, out))


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 0, 5) for r in rows], SCHEMA).repartition(3)


def groups(spark, rows, **kwargs):
    got = minhash.near_duplicate_groups(frame(spark, rows), words=2, **kwargs)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(map(str, map(tuple, got.collect())))


def prose(rng, n):
    return [rng.choice("the of river stone cloud paper window".split()) + str(rng.randrange(40)) for _ in range(n)]


def edited(rng, words, share):
    return [f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


def test_groups(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(30):
        base = prose(rng, rng.choice([1, 2, 3, 4, 6, 9, 30, 120, 400]))
        rows += [(rng.randrange(10**6), " ".join(edited(rng, base, share)))
                 for share in (0, 0, 0.02, 0.05, 0.08, 0.1, 0.2)]
    rows += [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One two"), rows[0], rows[0],
             (None, rows[0][1]), (None, "all alone here"), (None, "all alone here"), (None, None), (8, "a b " * 40_000)]
    assert groups(spark, rows) == expected(rows)
    assert minhash.near_duplicate_groups(frame(spark, rows).limit(0)).count() == 0


def test_five_words_by_default(spark):
    rng = random.Random(5)
    base = prose(rng, 100)
    rows = [(n, " ".join(edited(rng, base, share))) for n, share in enumerate([0, 0.01, 0.02, 0.03, 0.04])]
    got = minhash.near_duplicate_groups(frame(spark, rows)).collect()
    assert sorted(map(str, map(tuple, got))) == expected(rows, words=5)
    with pytest.raises(ValueError, match="80 percent"):
        minhash.near_duplicate_groups(frame(spark, rows), percent=50)


def test_chain_beyond_the_hub(spark):
    """Every node is near to the next only, so most links do not touch the first node of a bucket."""
    rng = random.Random(9)
    words = prose(rng, 200)
    rows = []
    for n in range(30):
        rows.append((n, " ".join(words)))
        for place in rng.sample(range(200), 9):
            words[place] = f"w{n}x{place}"
    assert groups(spark, rows) == expected(rows)


def crowd(rng, n, header, tail):
    shared = prose(rng, header)
    return [(k, " ".join(shared + [f"t{k}x{j}" for j in range(tail)])) for k in range(n)]


def test_crowd_below_the_threshold(spark, monkeypatch):
    """Texts that share a long header are in the same buckets and not near; the pairs that are left to
    compare must not grow with their square, and near ones among them must not be lost."""
    seen = []
    rest = minhash.rare_pairs
    monkeypatch.setattr(minhash, "rare_pairs", lambda *args: seen.append(rest(*args)) or seen[-1])
    sizes = []
    for n in (40, 80):
        rows = crowd(random.Random(1), n, 200, 30)
        rows += [(1000 + k, rows[k][1] + " tail") for k in (1, 2, 3)]
        assert groups(spark, rows) == expected(rows)
        sizes.append(seen[-1].count() if seen else 0)
    assert sizes[1] <= 2 * sizes[0] + 10 and seen


def test_signatures_agree_as_often_as_sets_do():
    rng = np.random.default_rng(2)
    for common, only in ((4, 1), (40, 10), (400, 100), (4000, 1000), (1, 0), (30, 70)):
        agreed = []
        for _ in range(60):
            h = rng.integers(0, 2**64, common + 2 * only, np.uint64, endpoint=False)
            x, y = np.unique(h[: common + only]), np.unique(np.concatenate([h[:common], h[common + only :]]))
            agreed.append((minhash.signature(x) == minhash.signature(y)).mean())
        similarity = common / (common + 2 * only)
        assert abs(np.mean(agreed) - similarity) < 0.03, (common, only)
