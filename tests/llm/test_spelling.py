"""Spelling forms against a brute-force version."""

import random
import re
import zlib
from collections import Counter

import pytest

from stipend.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:n] + b[n + 1 :] == a for n in range(len(b)))


def forms(counts, min_length, min_count):
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def vocabulary(letters, size, seed):
    rng = random.Random(seed)
    words = {}
    while len(words) < size:
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(2, 8)))
        words[word] = 2 ** rng.randrange(12) + rng.randrange(3)
    return words


@pytest.mark.parametrize(("letters", "symbols", "crowded"), [
    ("abcdeé", 8, 4096), ("abcdeé", 2, 4096), ("abiqyñ", 8, 1), ("abiqyñ", 2, 50), ("aZÀÿ÷", 3, 9)])
def test_forms(spark, letters, symbols, crowded):
    counts = vocabulary(letters, 400, symbols)
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)
    got = spelling.spelling_forms(df, 3, 2, symbols, crowded)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, forms(counts, 3, 2)))


def test_long_words_and_long_chains(spark):
    long = "ab" * 20_000
    counts = {long: 9, long[:-1]: 3, long[:100] + "z" + long[100:]: 4, long[:7] + "q" + long[8:]: 5}
    word = "chainword"
    for n in range(1, 25):
        word = word[: n % 9] + "abcdefgh"[n % 8] + word[n % 9 + 1 :] if n % 2 else word + "x"
        counts[word] = 3 * 2**n
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert set(map(tuple, spelling.spelling_forms(df).collect())) == forms(counts, 5, 3)
    assert spelling.spelling_forms(df.limit(0)).count() == 0


def test_word_counts(spark):
    rng = random.Random(3)
    words = ["Über", "naïve", "STRASSE", "straße", "Łódź", "don't", "x" * 9, "ÀÉ", "a"]
    rows = [(n, " ,\n"[n % 3].join(rng.choice(words) for _ in range(40))) for n in range(200)]
    rows += [(300, None), (301, ""), (302, "123 ..."), (None, "Über Über"), rows[0], rows[0], (303, "word" * 50_000)]
    want = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 7 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, n int, word string").repartition(3)
    assert dict(map(tuple, spelling.word_counts(df, 7).collect())) == {w: n for w, n in want.items() if w}
    plain = Counter(re.sub("[A-Z]", lambda m: m.group().lower(), r) for _, t in rows for r in RUN.findall(t or ""))
    assert dict(map(tuple, spelling.word_counts(df).collect())) == plain
    assert spelling.word_counts(df.limit(0), 7).count() == 0


def test_pieces_end_between_words(monkeypatch):
    monkeypatch.setattr(spelling, "_PIECE", 5)
    text = "one three, fifteen é naïveté  x" * 3 + "z" * 40
    assert spelling._runs(text) == Counter(RUN.findall(text))
