"""Base rules of the secret scan as character loops, surrogates by template, the label model by
enumeration, and very long texts."""

import math
import random
import re

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from landframe.llm import pii, quality_rules, secret_scan, toxicity

WORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]
VALUE = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def assign_at(text, i):
    """(end, length of the value) of the assignment that begins at ``i``, or None."""
    for w in WORDS:
        if ascii_lower(text[i:i + len(w)]) != w:
            continue
        j = i + len(w)
        for first in ([j + 1, j] if text[j:j + 1] in ("'", '"') and j < len(text) else [j]):
            k = first
            while text[k:k + 1] == " ":
                k += 1
            if text[k:k + 1] not in (":", "=") or k >= len(text):
                continue
            k += 1
            while text[k:k + 1] == " ":
                k += 1
            if k < len(text) and text[k] in "'\"":
                k += 1
            end = k
            while end < len(text) and text[end] in VALUE:
                end += 1
            if end > k:
                return end, end - k
    return None


def loop_spans(text):
    out, i = [], 0
    while i < len(text):
        hit = assign_at(text, i)
        if hit:
            if hit[1] >= 12:
                out.append((i, hit[0], "assign"))
            i = hit[0]
        else:
            i += 1
    for kind, start, chars, least in (("access", "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 18), ("hex", "", "0123456789abcdef", 16)):
        i = 0
        while i < len(text):
            end = i + len(start)
            while end < len(text) and text[end] in chars:
                end += 1
            if text.startswith(start, i) and end > i + len(start):
                if end - i >= least:
                    out.append((i, end, kind))
                i = end
            else:
                i += 1
    return sorted(out)


BITS = ["password", "PassWord", "secret", "Token", "api_key", "APIKEY", "passwd", "'", '"', " ", "  ", ":", "=", "==", "AKIA", "akia", "0123456789abcdef",
        "deadbeef", "ABCDEFGHIJKLMN", "a.b/c+d-e_f=", "K", "é", "\n", "x", "secre"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=14).map("".join))
def test_base_rules_as_character_loops(text):
    assert sorted(secret_scan.base_spans(text)) == loop_spans(text)


def test_surrogates_by_template(spark):
    """What stands in fixed places of a text changes alike in all texts, and nothing else does."""
    rng = random.Random(21)
    mails = [f"{a}.{b}@{c}.org" for a in ("jane", "omar", "li") for b in ("doe", "khan", "q7") for c in ("example", "mail-host")]
    phones = [f"+1 202 555 {rng.randrange(1000, 9999)}" for _ in range(12)]
    ips = [f"10.{rng.randrange(20, 99)}.{rng.randrange(100, 255)}.7" for _ in range(9)]
    rows = []
    for i in range(120):
        m, p, q = rng.choice(mails), rng.choice(phones), rng.choice(ips)
        rows.append((i, f"Write to <{m}> or dial [{p}] from host {{{q}}} soon.", m, p, q))
    out = pii.replace_pii(spark.createDataFrame(rows, "doc_id long, text string, m string, p string, q string"), b"secret key").collect()
    shape = re.compile(r"Write to <([^>]*)> or dial \[([^\]]*)\] from host \{([^}]*)\} soon\.")
    seen = {}
    for r in out:
        found = shape.fullmatch(r["text"])
        assert found, r["text"]
        for old, new in zip((r["m"], r["p"], r["q"]), found.groups()):
            assert seen.setdefault(old, new) == new and old != new
            assert [c if not c.isalnum() else "d" if c.isdigit() else "a" for c in old] == [c if not c.isalnum() else "d" if c.isdigit() else "a" for c in new]
    old, new = set(seen), set(seen.values())
    assert len(new) == len(old) and not old & new
    other = pii.replace_pii(spark.createDataFrame(rows, "doc_id long, text string, m string, p string, q string"), b"another key").collect()
    assert {r["text"] for r in other} != {r["text"] for r in out}


def test_label_model_by_enumeration():
    """Posteriors are Bayes' rule over the voters' tables, and EM finds accuracies that made the votes."""
    rng = np.random.default_rng(9)
    n, voters = 40_000, len(toxicity.VOTERS)
    truth = rng.random(n) < 0.2
    rate = np.linspace(0.5, 0.85, voters)
    votes = np.where(truth[:, None], rng.random((n, voters)) < rate, rng.random((n, voters)) < 0.05).astype(np.int64)
    codes, at, counts = np.unique((votes << 2 * np.arange(voters)).sum(1), return_inverse=True, return_counts=True)
    known = np.zeros((2, len(codes)))
    for i in range(200):  # a few labelled rows
        known[int(truth[i]), at[i]] += 1
    model = toxicity.LabelModel(codes, counts.astype(float), 0.2, known)
    got = model.posterior(codes)
    for k in rng.choice(len(codes), 50, replace=False):
        odds = math.log(0.2 / 0.8)
        for v in range(voters):
            seen = int(codes[k] >> 2 * v & 3)
            odds += model.weights[v] * math.log(model.table[1, v, seen] / model.table[0, v, seen])
        assert abs(got[k] - 1 / (1 + math.exp(-max(-30, min(30, odds))))) < 1e-9
    assert np.abs(model.table[1, :, 1] - rate).max() < 0.05 and np.abs(model.table[0, :, 1] - 0.05).max() < 0.02
    assert ((got[at] > 0.5) == truth).mean() > 0.99


def test_hash_threshold_is_exact_at_any_share(spark):
    key = "xxhash64(id)"
    from pyspark.sql import functions as F
    df = spark.range(100_000).withColumn("k", F.expr(key))
    for share in (1.0, 0.25, 0.001, 1e-12):
        n = df.filter(toxicity.hashed_low(F.col("k"), share)).count()
        assert abs(n - 100_000 * share) <= 5 * math.sqrt(100_000 * share) + 1e-9


def test_very_long_texts(spark):
    words = [f"w{i % 977}" for i in range(200_000)]
    text = " ".join(words) + " mail jane.doe@example.org secret = 0123456789abcdefghij"
    df = spark.createDataFrame([(1, text, "s"), (2, None, "s"), (3, "", None)], "doc_id long, text string, source string")
    assert "jane.doe" not in [r["text"] for r in pii.replace_pii(df, b"k").collect() if r["doc_id"] == 1][0]
    assert {r["doc_id"]: r["n_words"] for r in quality_rules.judge_documents(df).collect()} == {1: 200_005, 2: 0, 3: 0}
    spans = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in secret_scan.scan_secrets(df, public_tokenizers.path(secret_scan.QUERY_VOCABULARY)).collect()}
    assert "assign" in spans[1] and spans[2] == spans[3] == []
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int")
    scores = toxicity.score_toxicity(df.unionByName(df), labels).collect()  # repeated rows, each scored
    assert len(scores) == 6 and all(0 <= r["score"] <= 1 for r in scores)
