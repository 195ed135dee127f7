"""Property checks against brute force on generated rows."""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from landframe.operators import window as W

ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.sampled_from("ab"))),
                min_size=1, max_size=40)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _frame(spark, rows):
    return spark.createDataFrame([(i, k1, k2) for i, (k1, k2) in enumerate(rows)], "id int, k1 int, k2 string")


@SETTINGS
@given(rows=ROWS)
def test_add_count_matches_brute_force(spark, rows):
    got = {r.id: r.n for r in W.add_count(_frame(spark, rows), ["k1", "k2"], "n").collect()}
    c = Counter(rows)
    assert got == {i: c[key] for i, key in enumerate(rows)}
    # counts summed over distinct keys give the row count
    assert sum(c.values()) == len(rows)


@SETTINGS
@given(rows=ROWS)
def test_first_and_repeats_partition_rows(spark, rows):
    df = _frame(spark, rows)
    first = {r.id for r in W.first_per_key(df, ["k1", "k2"], ["id"]).collect()}
    rep = {r.id for r in W.find_repeats(df, ["k1", "k2"], ["id"]).collect()}
    by_key = defaultdict(list)
    for i, key in enumerate(rows):
        by_key[key].append(i)
    assert first == {min(v) for v in by_key.values()}
    assert rep == set(range(len(rows))) - first


@SETTINGS
@given(n=st.integers(1, 300), size=st.integers(1, 50))
def test_row_ids_are_dense_and_ordered(spark, n, size):
    df = spark.range(n).selectExpr("id", "(id * 7) % 301 AS k")
    got = sorted((r.k, r.id, r.row_id) for r in W.add_row_id(df, ["k", "id"], num_partitions=3).collect())
    assert [t[2] for t in got] == list(range(1, n + 1))
    batches = Counter(r.group for r in W.add_batch(df, size, ["k", "id"]).collect())
    assert all(v == size for b, v in batches.items() if b < max(batches)) and sum(batches.values()) == n


def test_provenance_keeps_row_count(spark):
    import uuid

    from landframe.session import checkpoint_dir
    from landframe.sources.files import read_headerless
    path = f"{checkpoint_dir(spark).rstrip('/')}/test-prov-{uuid.uuid4().hex}"
    spark.range(1000).selectExpr("CAST(id AS STRING) AS a", "'x' AS b").repartition(3).write.csv(path)
    plain = read_headerless(spark, path, ["A", "B"])
    prov = read_headerless(spark, path, ["A", "B"], provenance=True)
    assert plain.count() == prov.count() == 1000
    assert prov.select("file").distinct().count() == 3


TEXTS = st.lists(st.text(alphabet=st.sampled_from(list("ab- \t\r\n")), max_size=12), min_size=1, max_size=8)


@SETTINGS
@given(texts=TEXTS)
def test_split_clean_matches_piecewise(spark, texts):
    import re

    from landframe.functions.text import split_clean

    def brute(t, pattern="[\r\n\t]"):
        return [p.replace(" ", "").replace("-", "_") for p in re.split(pattern, t) if p.strip(" ") != ""]

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = {r.id: r.parts for r in df.select("id", split_clean("t").alias("parts")).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    # a separator pattern that matches "-" takes the piece-wise path
    got2 = {r.id: r.parts for r in df.select("id", split_clean("t", "[-\t]").alias("parts")).collect()}
    exp2 = {i: [p.replace(" ", "") for p in re.split("[-\t]", t) if p.strip(" ") != ""] for i, t in enumerate(texts)}
    assert got2 == exp2


DATE_TEXT = st.one_of(
    st.builds(lambda y, m, d, sep, order: (f"{y}{sep}{m}{sep}{d}" if order else f"{d}{sep}{m}{sep}{y}"),
              st.integers(1990, 2030).map(str), st.integers(1, 12).map(lambda v: str(v).zfill(2) if v % 2 else str(v)),
              st.integers(1, 28).map(lambda v: str(v).zfill(2) if v % 3 else str(v)),
              st.sampled_from(["-", "/", ""]), st.booleans()),
    st.builds(lambda d, mon, y: f"{d} {mon} {y}", st.integers(1, 28), st.sampled_from(["April", "Apr", "May", "Sept"]),
              st.integers(1990, 2030)),
    st.builds(lambda s, t: s + t, st.sampled_from(["2017-04-03", "20170403", "2017-04-03T"]),
              st.sampled_from(["", " 12:05:01", "12:05:01", "120501", ".5"])),
    st.text(alphabet=st.sampled_from(list("0123456789-/ :TApril")), max_size=14),
)


@SETTINGS
@given(texts=st.lists(DATE_TEXT, min_size=1, max_size=30))
def test_shape_gate_never_changes_a_result(spark, texts):
    from pyspark.sql import functions as F

    from landframe.functions.dates import AUTO_DATE_FORMATS, normalise_date

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, d string")
    text = F.regexp_extract(F.trim(F.col("d")), "^[^.]*", 0)
    ungated = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in AUTO_DATE_FORMATS])
    plain = F.when(F.length(text) == 0, F.col("d")).otherwise(
        F.coalesce(F.date_format(ungated, "yyyyMMdd"), F.col("d")))
    got = df.select("id", normalise_date("d").alias("a"), plain.alias("b")).collect()
    assert [(r.id, r.a) for r in got] == [(r.id, r.b) for r in got]
