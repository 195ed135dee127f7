"""Clashing column names, repeated grams and very long texts."""

import re
import time

from pyspark.sql import functions as F

from landframe.llm import decontaminate, license_scan, pii

NAMES = ["a.b", "__row", "__entities", "__new", "rest", "row", "new", "entities", "c0", "kind"]


def clashing(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for i, n in enumerate(NAMES):
        df = df.withColumn(n, F.col("doc_id") * 100 + i)
    return df.select("doc_id", *[f"`{n}`" for n in NAMES[:5]], "text", *NAMES[5:])


def test_pii_keeps_columns_of_any_name(spark):
    rows = [(1, "Write to jane.doe@example.org now"), (2, "nothing here"), (3, None), (4, ""), (1, "Write to jane.doe@example.org now")]
    df = clashing(spark, rows)
    out = pii.replace_pii(df, b"k", count=True)
    assert out.columns == [*df.columns, "n_entities"]
    got = out.collect()
    assert len(got) == 5 and all(r[n] == r["doc_id"] * 100 + i for r in got for i, n in enumerate(NAMES))
    texts = {r["doc_id"]: r["text"] for r in got}
    assert "jane.doe" not in texts[1] and texts[1].startswith("Write to ") and (texts[2], texts[3], texts[4]) == ("nothing here", None, "")
    assert pii.replace_pii(df.limit(0), b"k").collect() == []
    only = pii.replace_pii(df.select("text"), b"k")
    assert only.columns == ["text"] and only.count() == 5


def test_decontamination_keeps_columns_of_any_name(spark):
    benchmark = spark.createDataFrame([("i", "one two three"), ("i", "one two three"), (None, "")], "item_id string, text string")
    rows = [(1, "a one two three b"), (2, "one, TWO three!"), (3, None), (4, ""), (5, "clean"), (5, "clean")]
    df = clashing(spark, rows)
    out = decontaminate.remove_benchmark_overlap(df, benchmark)
    assert out.columns == df.columns
    got = out.collect()
    assert sorted((r["doc_id"], r["text"]) for r in got if r["text"]) == [(1, "a  b"), (5, "clean"), (5, "clean")]
    assert {r["doc_id"] for r in got} == {1, 3, 4, 5} and all(r["a.b"] == r["doc_id"] * 100 for r in got)


def labels(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = license_scan.scan_licenses(df, [*license_scan.BASE_TEMPLATES, *license_scan.METHOD_TEMPLATES]).collect()
    return {r["doc_id"]: {s["label"] for s in r["spans"]} for r in found}


def test_repeated_grams_do_not_make_a_license(spark):
    wording = [t for t in license_scan.METHOD_TEMPLATES if t.label == "bsd"][0].text
    got = labels(spark, ["of the " * 12, "you may obtain " * 18, "the software " * 40, wording, wording.replace("in source and", "in source form and")])
    assert got == {0: set(), 1: set(), 2: set(), 3: {"bsd"}, 4: {"bsd"}}


def test_license_scan_is_linear_in_a_text(spark):
    """No array rides on the exploded rows, so one long text costs what many short ones do."""
    words = ("lorem ipsum of the software may be " * 60_000).split()[:300_000]
    one = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    plan = license_scan.scan_licenses(one, license_scan.METHOD_TEMPLATES)._jdf.queryExecution().executedPlan().toString()
    kept = re.search(r"Generate posexplode\([^)]*\), \[([^\]]*)\]", plan)[1]
    assert {c.split("#")[0].strip() for c in kept.split(",")} == {"row", "doc_id", "n_words"}
    t0 = time.time()
    assert license_scan.scan_licenses(one, license_scan.METHOD_TEMPLATES).first()["n_words"] == 300_000
    assert time.time() - t0 < 30
