"""Periodic runs against their definition, tried for every period."""

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from landframe.llm import periodic_runs as pr


def brute(words, min_length=2, min_periods=2):
    """All maximal stretches by period; a stretch belongs to its smallest period."""
    n, spans = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i >= q:
                spans.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in spans.items() if b - a >= max(min_length, min_periods * q))


def pieces(ids, cuts):
    catcher, at = pr.SquareCatcher(), 0
    for end in [*cuts, len(ids)]:
        catcher.append(np.array(ids[at:end], np.int64))
        at = end
    return [tuple(r) for r in catcher.runs()]


WORDS = st.lists(st.integers(0, 2), max_size=60) | st.tuples(
    st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 9), st.lists(st.integers(0, 3), max_size=12)).map(lambda t: t[0] * t[1] + t[2] + t[0] * 2)


@settings(max_examples=500, deadline=None)
@given(WORDS, st.data())
def test_runs_as_brute_force_in_any_portions(ids, data):
    cuts = sorted(data.draw(st.lists(st.integers(0, len(ids)), max_size=4)))
    assert pieces(ids, cuts) == brute(ids)


@settings(max_examples=60, deadline=None)
@given(WORDS)
def test_word_by_word(ids):
    assert pieces(ids, list(range(len(ids)))) == brute(ids)


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("ids", [
    fibonacci(600), [0] * 500, [0, 1] * 250, ([0] * 7 + [1]) * 40, ([0] * 16 + [1]) * 8 + [0] * 16, [bin(i).count("1") % 2 for i in range(512)],
    list(range(300)) * 2, ([0, 1, 2] * 20 + [3]) * 5, [random.Random(1).randrange(3) for _ in range(700)]])
def test_structured_words(ids):
    assert [tuple(r) for r in pr.find_runs(np.array(ids, np.int64))] == brute(ids)
    assert pieces(ids, [len(ids) // 3, len(ids) // 2]) == brute(ids)


def test_long_texts_take_about_linear_time():
    """Same words, two alternating words, blocks of one word, random words: 300 000 each."""
    n = 300_000
    rng = np.random.default_rng(5)
    for ids in (np.zeros(n, np.int64), np.arange(n) % 2, (np.arange(n) % 1000 == 0).astype(np.int64), rng.integers(0, 50, n)):
        t0 = time.perf_counter()
        runs = pr.find_runs(ids, 6, 4)
        assert time.perf_counter() - t0 < 30
        for r in runs[:: max(1, len(runs) // 100)]:
            assert (ids[r.start:r.start + r.length - r.period] == ids[r.start + r.period:r.start + r.length]).all()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab\x0b\x1c\x85  \té\n", max_size=30))
def test_words_are_the_contract_words(text):
    words, ids = pr.word_ids(text)
    assert [words[i].decode() for i in ids] == re.findall(r"[^\x20\x09-\x0D]+", text)


def test_words_of_long_texts():
    text = "".join(f"w{i % 1000} " for i in range(400_000)) + "x" * 1_500_000
    words, ids = pr.word_ids(text)
    assert len(words) == 1001 and [words[i].decode() for i in ids[[0, 999, 1000, -1]]] == ["w0", "w999", "w0", "x" * 1_500_000]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words, 6, 4)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def test_query_as_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(60)))) for i in range(200)]
    rows += [(None, "a " * 10), (7, None), (7, None), (8, ""), (9, " \n\t"), (10, "é\tb\n" * 9 + "x"), (11, "one"), (11, "k l m " * 300)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in pr.op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted((expected(*r) for r in rows), key=repr)


def test_runs_of_a_table(spark):
    rows = [(1, "a b " * 5, 2), (2, None, 2), (2, None, 2), (3, "x x x x x x y", 2), (3, "x x x x x x y", 2)]
    df = spark.createDataFrame(rows, "id long, body string, start int").withColumnRenamed("start", "a.b")
    got = sorted(tuple(r) for r in pr.periodic_runs(df, id_col="id", text_col="body").collect())
    assert got == [(1, 0, 10, 2), (3, 0, 6, 1), (3, 0, 6, 1)]
    assert pr.periodic_runs(df.limit(0), id_col="id", text_col="body").collect() == []
