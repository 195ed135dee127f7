"""Document and host-level quality rules.

Each document is measured once.  Rule failures are counted per host; a host's failure rate
is shrunk towards all hosts' mean by a beta prior whose two parameters are fitted to the
hosts (moments), so that a host with three documents is not condemned for two of them.  A
host is bad in a rule if its posterior leaves hardly a doubt that its rate is above
``HOST_MULTIPLE`` times the prior's mean: the shrunk rate less ``HOST_DOUBT`` posterior
standard deviations.  Documents of a bad host that fail the rule are rejected; documents
that fail no rule are always kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from landframe.llm.common import column, documents, text_slices
from landframe.session import materialize

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
MIN_WORDS = 50
#: a bad host's rate lies above so many times the mean, but for a chance of one in twenty
HOST_MULTIPLE, HOST_DOUBT = 2.0, 1.645
#: bad hosts up to which they are broadcast; more are joined by a shuffle
BROADCAST_HOSTS = 100_000
#: parts over which a host's rows are dealt when verdicts are joined back by a shuffle
SALTS = 32

_SYMBOLS = re.compile(rb"[#*$%&|<>]")
_BLANKS = b" \t\n\r\x0b\x0c"


def measure(text: str | None) -> tuple[int, ...]:
    """The ``MEASURES`` of one text (null: all 0).  Words are runs without ASCII blanks."""
    if not text:
        return (0,) * len(MEASURES)
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip(_BLANKS)]
    chars = len(text) - sum(text.count(chr(b)) for b in _BLANKS)
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    repeated = 0
    if len(counts) < len(windows):
        covered = -1  # the last word already counted
        for i, w in enumerate(windows):
            if counts[w] > 1:
                repeated += i + 2 - max(covered, i - 1)
                covered = i + 2
    return len(words), chars, len(_SYMBOLS.findall(raw)), len(lines) - len(set(lines)), repeated, len(lines)


def with_measures(docs: DataFrame, text: Column, name: str = "measures") -> DataFrame:
    """``docs`` with one more struct column of ``MEASURES`` (no shuffle)."""
    import pyarrow as pa

    kind = StructType([StructField(m, LongType()) for m in MEASURES])
    given = docs.withColumn(name, text)
    at = len(given.columns) - 1
    schema = StructType([*docs.schema.fields, StructField(name, kind)])
    own = schema.names

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            renamed = batch.rename_columns([f"c{i}" for i in range(at)] + ["text"])
            for part in text_slices(renamed):
                found = list(zip(*map(measure, part.column("text").to_pylist()))) or [[]] * len(MEASURES)
                struct = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], names=MEASURES)
                yield pa.RecordBatch.from_arrays([*part.columns[:at], struct], names=own)

    return given.mapInArrow(run, schema)


def rule_failures(m: Column) -> dict[str, Column]:
    """The rules on a struct of measures: name -> failed."""
    return {
        "few_words": m["n_words"] < MIN_WORDS,
        "repeats": 100 * m["n_repeat_words"] > 50 * m["n_words"],
        "symbols": 10 * m["n_symbols"] > m["n_words"],
        "dup_lines": 100 * m["n_dup_lines"] > 30 * m["n_lines"],
        "word_length": (m["n_words"] > 0) & ((m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"])),
    }


def base_failed(m: Column) -> Column:
    rules = rule_failures(m)
    return rules["few_words"] | rules["repeats"]


def host_key(host: Column) -> Column:
    """Null hosts are one host of their own."""
    return F.coalesce(F.concat(F.lit("h"), host.cast("string")), F.lit("-"))


def host_rates(measured: DataFrame, host: Column, m: Column) -> DataFrame:
    """One row per host: ``host``, ``n`` documents, ``rates`` (per rule the ``mean`` and
    ``strength`` of the prior and the host's ``shrunk`` rate) and ``bad``, the rules it is bad in.

    ``measured`` is read twice, so it should be a written table.  One row (two prior
    parameters a rule) goes through the driver.
    """
    rules = rule_failures(m)
    hosts = measured.groupBy(host_key(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(failed.cast("long")).alias(r) for r, failed in rules.items()])
    # beta prior by moments: mean rate and the variance of the hosts' rates, weighted by size
    moments = hosts.select(F.sum("n").alias("n"), *[F.sum(r).alias(r) for r in rules],
                           *[F.sum(F.col(r) * F.col(r) / F.col("n")).alias(f"{r}_2") for r in rules]).first()
    rates, bad = [], []
    for r in rules:
        mean = (moments[r] or 0) / moments["n"] if moments["n"] else 0.0
        spread = max((moments[f"{r}_2"] or 0.0) / moments["n"] - mean * mean, 1e-9) if moments["n"] else 1e-9
        strength = min(max(mean * (1 - mean) / spread - 1, 2.0), 1000.0)
        shrunk = (F.col(r) + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
        doubt = F.sqrt(shrunk * (1 - shrunk) / (F.col("n") + F.lit(strength + 1)))
        rates.append(F.struct(F.lit(mean).alias("mean"), F.lit(strength).alias("strength"), shrunk.alias("shrunk")).alias(r))
        bad.append(F.when((F.col(r) > 0) & (shrunk - HOST_DOUBT * doubt > HOST_MULTIPLE * mean), F.lit(r)))
    return hosts.select("host", "n", F.struct(*rates).alias("rates"), F.array_compact(F.array(*bad)).alias("bad"))


def bad_hosts(measured: DataFrame, host: Column, m: Column) -> DataFrame:
    """``host, rates, bad`` of the hosts that are bad in some rule."""
    return host_rates(measured, host, m).filter(F.size("bad") > 0).select("host", "rates", "bad")


def with_verdicts(measured: DataFrame, host: Column, m: Column, bad: DataFrame) -> DataFrame:
    """``measured`` with ``rates`` (of the hosts given), ``failed_rules``, ``base_failed``,
    ``host_rejected`` and ``kept``.

    The hosts (``host, rates, bad``) are written and counted: up to ``BROADCAST_HOSTS`` they are broadcast, and
    no row is shuffled.  Beyond that they are repeated over ``SALTS`` parts, so that a host
    with a third of all rows is spread over as many tasks.
    """
    bad = materialize(bad.toDF("__host", "rates", "__bad"))
    rows = measured.withColumn("__host", host_key(host))
    if bad.count() <= BROADCAST_HOSTS:
        joined = rows.join(F.broadcast(bad), "__host", "left").withColumn("__salt", F.lit(0))
    else:
        salted = bad.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = rows.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        joined = dealt.join(salted, ["__host", "__salt"], "left")
    failed = F.array_compact(F.array(*[F.when(c, F.lit(r)) for r, c in rule_failures(m).items()]))
    return (
        joined.withColumn("failed_rules", failed)
        .withColumn("base_failed", base_failed(m))
        .withColumn("host_rejected", F.coalesce(F.arrays_overlap("failed_rules", "__bad"), F.lit(False)))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
        .drop("__host", "__salt", "__bad")
    )


def judge_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per document row: ``doc_id, host``, the measures, the host's ``rates`` and the verdicts.

    Null texts have no words and fail the base rule; null hosts form one host; an empty
    table gives no rows.
    """
    slim = docs.select(column(docs, id_col).alias("doc_id"), column(docs, host_col).alias("host"), column(docs, text_col).alias("text"))
    measured = materialize(with_measures(slim, slim["text"]).drop("text"))
    hosts = host_rates(measured, F.col("host"), F.col("measures")).select("host", "rates", "bad")
    return with_verdicts(measured, F.col("host"), F.col("measures"), hosts).select(
        "doc_id", "host", "measures.*", "rates", "failed_rules", "base_failed", "host_rejected", "kept")


def keep_good_documents(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns only.  Texts are measured
    twice, for the hosts' counts and for the verdicts, and never shuffled."""
    slim = docs.select(column(docs, host_col).alias("host"), column(docs, text_col).alias("text"))
    counted = materialize(with_measures(slim, slim["text"]).drop("text"))
    bad = bad_hosts(counted, F.col("host"), F.col("measures"))
    held = docs.select(F.struct(*[column(docs, c) for c in docs.columns]).alias("row"))
    measured = with_measures(held, column(held, "row")[text_col])
    kept = with_verdicts(measured, F.col("row")[host_col], F.col("measures"), bad).filter("kept")
    return kept.select("row.*")


RULES = ["few_words", "repeats", "symbols", "dup_lines", "word_length"]


def op3_quality_rules(spark, sf_dir) -> DataFrame:
    """Measures and verdicts of all documents, with ``source`` as the host; of each rule the
    prior's mean and strength and the host's shrunk rate (rounded)."""
    judged = judge_documents(documents(spark, sf_dir))
    rates = [F.round(F.col(f"rates.{r}.{part}"), 6).alias(f"{part}_{r}") for r in RULES for part in ("mean", "strength", "shrunk")]
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("failed_rules", ",").alias("failed_rules"), "host_rejected", *rates)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('h' || source, '-') AS host,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    len(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS n_symbols,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
t AS (SELECT r, unnest(range(0, len(w) - 2)) AS p,
    unnest(list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]])) AS g FROM d),
tw AS (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS c FROM t),
rep AS (SELECT r, count(DISTINCT p + k) AS n FROM tw, (VALUES (0), (1), (2)) x(k) WHERE c > 1 GROUP BY r),
m AS (SELECT doc_id, host, len(w) AS n_words, word_chars, n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words FROM d LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2, 10 * n_symbols > n_words AS f3,
    100 * n_dup_lines > 30 * n_lines AS f4, n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words) AS f5 FROM m),
long AS (SELECT host, rule, count(*) AS n, sum(failed::INT)::DOUBLE AS k
    FROM (SELECT host, unnest(['few_words', 'repeats', 'symbols', 'dup_lines', 'word_length']) AS rule, unnest([f1, f2, f3, f4, f5]) AS failed FROM f)
    GROUP BY host, rule),
mo AS (SELECT rule, sum(k) / sum(n) AS mean, sum(k * k / n) / sum(n) AS sq FROM long GROUP BY rule),
pr AS (SELECT rule, mean, least(greatest(mean * (1 - mean) / greatest(sq - mean * mean, 1e-9) - 1, 2.0), 1000.0) AS strength FROM mo),
hr AS (SELECT host, rule, k, n, mean, strength, (k + mean * strength) / (n + strength) AS shrunk FROM long JOIN pr USING (rule)),
bad AS (SELECT host, list(rule) AS bad FROM hr
    WHERE k > 0 AND shrunk - 1.645 * sqrt(shrunk * (1 - shrunk) / (n + strength + 1)) > 2.0 * mean GROUP BY host),
rates AS (SELECT host, __RATES__ FROM hr GROUP BY host),
v AS (SELECT f.*, list_filter([CASE WHEN f1 THEN 'few_words' END, CASE WHEN f2 THEN 'repeats' END, CASE WHEN f3 THEN 'symbols' END,
    CASE WHEN f4 THEN 'dup_lines' END, CASE WHEN f5 THEN 'word_length' END], lambda x: x IS NOT NULL) AS failed, bad FROM f LEFT JOIN bad USING (host))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, f1 OR f2 AS base_failed,
    NOT (f1 OR f2) AND NOT coalesce(list_has_any(failed, bad), FALSE) AS kept,
    array_to_string(failed, ',') AS failed_rules, coalesce(list_has_any(failed, bad), FALSE) AS host_rejected, rates.* EXCLUDE (host)
FROM v JOIN rates USING (host)""".replace("__RATES__", ", ".join(
    f"round(max({part}) FILTER (rule = '{r}'), 6) AS {part}_{r}" for r in RULES for part in ("mean", "strength", "shrunk")))
