"""License scan, quality rules, decontamination and secret scan against brute force."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from landframe.llm import decontaminate, license_scan, quality_rules, secret_scan
from landframe.llm.common import words_of
from landframe.llm.fm_index import FmIndex
from landframe.llm.queries import ORACLE, QUERIES
from tests.oracle_compare import compare_one, duck

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SF = "/root/testdata/sf0.01"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_oracle(spark, name):
    con = duck(SF)
    con.execute(f"CREATE VIEW checked AS {ORACLE[name]}")  # as the driver does
    res = compare_one(spark, con, name, QUERIES[name], "SELECT * FROM checked", SF)
    assert res["status"] == "exact" and not res["type_diffs"], res


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_byte_words_are_the_contract_words(text):
    assert [w.decode() for w in words_of(text)] == WORD.findall(lowered(text))


def edge_rows(spark, texts):
    return spark.createDataFrame([(i % 3, t, "x", i, None) for i, t in enumerate(texts)],
                                 "doc_id long, text string, `words` string, `row` int, source string")


def test_licenses_on_edge_rows(spark):
    texts = [None, "", "MIT License, mit-license; the mit\nlicense", "x " * 30000 + "General Public License", "é" * 70000, "public license general", "MIT"]
    texts += [texts[2]] * 2
    out = license_scan.scan_licenses(edge_rows(spark, texts), license_scan.BASE_TEMPLATES).collect()
    got = Counter((r["n_words"], tuple((s["start"], s["label"]) for s in r["spans"])) for r in out)
    want = Counter()
    for t in texts:
        w = WORD.findall(lowered(t))
        spans = sorted((i, p.label) for p in license_scan.BASE_TEMPLATES for i in range(len(w)) if w[i:i + len(p.text.split())] == p.text.split())
        want[(len(w), tuple(spans))] += 1
    assert got == want
    assert license_scan.scan_licenses(edge_rows(spark, texts).limit(0), license_scan.BASE_TEMPLATES).count() == 0


def test_license_wording_with_changed_words_is_merged_and_verified(spark):
    text = ("Intro words. Redistribution and use in source and binary forms with or without small modification are permitted "
            "provided that following conditions are met")
    spans = license_scan.scan_licenses(edge_rows(spark, [text, "use in source and binary"]), license_scan.METHOD_TEMPLATES).collect()
    assert [[s["label"] for s in r["spans"]] for r in sorted(spans, key=lambda r: -r["n_words"])] == [["bsd"], []]


def brute_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(grams)
    repeated = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated), len(lines))


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="ab#é\x1c  \n\t", max_size=60)))
def test_measures_as_brute_force(text):
    assert quality_rules.measure(text) == brute_measures(text)


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_bad_host_rejects_only_its_failing_documents(spark, monkeypatch, broadcast):
    monkeypatch.setattr(quality_rules, "BROADCAST_HOSTS", broadcast)
    good = " ".join(f"w{i}" for i in range(80))
    symbols = " ".join(f"w{i}#" for i in range(80))
    rows = [(i, symbols if i % 4 else good, "bad") for i in range(400)] + [(i, good, None) for i in range(400)] + [(900, symbols, "good")]
    rows += [(i, good, "good") for i in range(500)] + [(1, None, None), (2, "", "bad"), (3, good, "bad")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumnRenamed("source", "host name")
    out = quality_rules.judge_documents(docs, host_col="host name").toPandas()
    assert len(out) == len(rows)
    assert (out[out.host_rejected].host == "bad").all() and out.host_rejected.sum() == 300
    assert out[(out.n_words == 80) & (out.failed_rules.str.len() == 0)].kept.all() and not out[out.n_words == 0].kept.any()
    kept = quality_rules.keep_good_documents(docs, host_col="host name")
    assert kept.columns == docs.columns and kept.count() == out.kept.sum()
    assert quality_rules.judge_documents(docs.limit(0), host_col="host name").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=120), st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=6), min_size=1, max_size=10), st.integers(2, 9))
def test_fm_index_finds_every_occurrence(symbols, patterns, sample):
    sym = np.array([*symbols, 0])
    index = FmIndex(sym, 4, sample)
    width = max(map(len, patterns))
    table = np.zeros((len(patterns), width), np.int64)
    for row, p in zip(table, patterns):
        row[width - len(p):] = p
    which, lo, hi = index.search(table, np.array([len(p) for p in patterns]))
    got = {int(w): sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which, lo, hi)}
    want = {i: [k for k in range(len(sym)) if list(sym[k:k + len(p)]) == p] for i, p in enumerate(patterns)}
    assert got == {i: v for i, v in want.items() if v}


def brute_overlap(text, items, n=10):
    words, hit, found = WORD.findall(lowered(text)), set(), set()
    for item, t in items:
        w = WORD.findall(lowered(t))
        for i in range(max(1, len(w) - n + 1) if w else 0):
            g = w[i:i + n]
            for k in range(len(words) - len(g) + 1):
                if words[k:k + len(g)] == g:
                    hit |= set(range(k, k + len(g)))
                    found.add("null" if item is None else str(item))
    return len(words), len(hit), sorted(found)


def test_decontamination_as_brute_force(spark, monkeypatch):
    random.seed(5)
    monkeypatch.setattr(decontaminate, "SHARD_SYMBOLS", 50)  # shards smaller than texts
    voc = [f"w{i}" for i in range(12)] + ["É", "ﬂ"]
    items = [(i, " ".join(random.choices(voc[:6], k=random.choice([3, 10, 14, 25])))) for i in range(30)] + [(None, "w0, W1 w2"), (7, None), (8, "..."), (5, "w5 w5")]
    texts = [None, "", "..", "W0 w1-w2"] + [" ".join(random.choices(voc, k=random.randint(1, 120)) + items[i % 30][1].split() + random.choices(voc, k=5)) for i in range(60)]
    texts += [texts[5]] * 3
    got = decontaminate.find_contamination(texts, [decontaminate.ItemWindows(items[:10]), decontaminate.ItemWindows(items[10:])])
    assert [(g[0], g[1], g[2]) for g in got] == [brute_overlap(t, items) for t in texts]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, spans int")
    out = decontaminate.find_benchmark_overlap(docs, bench).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in out} == {i: brute_overlap(t, items) for i, t in enumerate(texts)}
    clean = {r["doc_id"]: r["text"] for r in decontaminate.remove_benchmark_overlap(docs, bench).collect()}
    for i, t in enumerate(texts):
        n, hit, _ = brute_overlap(t, items)
        if hit == 0:
            assert clean[i] == t
        elif i in clean:
            assert brute_overlap(clean[i], items)[1] == 0
    assert decontaminate.find_benchmark_overlap(docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.remove_benchmark_overlap(docs.limit(0), bench).count() == 0


def test_secrets_of_letters_and_behind_words():
    path = public_tokenizers.path(secret_scan.QUERY_VOCABULARY)
    find = lambda t: [t[a:b] for a, b, _ in secret_scan.random_spans(t, path, secret_scan.MAX_CHARS_PER_TOKEN)]
    letters = "qXzvWkRtPlMnBvCxZaSdFgHjKwYb"
    assert find(f"a {letters} b") == [letters]
    random.seed(4)
    digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    secrets = ["".join(random.choices(digits, k=32)) for _ in range(100)]
    assert sum(any(s in x for x in find(f"see example/path/download/documents/{s} end")) for s in secrets) >= 98
    for plain in ("example/path/download/documents/and/the/other", "this_is_a_long_identifier_name_2024", "2024-01-02-03-04-05-06-07-08",
                  "example/path/download/documents/123e4567-e89b-12d3-a456-426614174000", "-" * 90):
        assert find(plain) == [], plain


def test_secrets_on_edge_rows(spark):
    path = public_tokenizers.path(secret_scan.QUERY_VOCABULARY)
    texts = [None, "", "Password = 'abcdefghijkl' api-key: x", "API_KEY:\"A1b2C3d4E5f6\" toKen=short", "AKIA" + "Z9" * 7 + " AKIAXX",
             "é deadbeefdeadbeef0 0123456789abcde", "key zX9qL2vT7mK4pW8rB3nY6cJ1 end", "d41d8cd98f00b204e9800998ecf8427e",
             "this_is_a_long_identifier_name_2024 123e4567-e89b-12d3-a456-426614174000", "a" * 200000]
    rows = edge_rows(spark, texts + [texts[2]])
    out = [sorted((s["start"], s["end"], s["kind"]) for s in r["spans"]) for r in secret_scan.scan_secrets(rows, path).collect()]
    assert out[0] == out[1] == [] and out[10] == out[2]
    assert out[2] == [(0, 24, "assign")] and out[3] == [(0, 21, "assign")] and out[4] == [(0, 18, "access")]
    assert out[5] == [(2, 19, "hex")]
    assert out[6] == [(4, 28, "random")]
    assert out[7] == [(0, 32, "hex")] and out[8] == [] and out[9] == [(0, 200000, "hex")]
    assert secret_scan.scan_secrets(rows.limit(0), path).count() == 0
