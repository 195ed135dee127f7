"""Toxicity by weak supervision.

Many voters look at a text: lexicon voters (words and word beginnings that labelled training
rows show to be toxic, dealt over several voters, and a fixed list of insults) and pattern
voters.  A generative model estimates each voter's accuracy from how the votes of all
training documents agree, then how strongly voters repeat each other, and tempers repeated
evidence.  Its posteriors are the labels on which a linear classifier is trained, half of its
weight on a sample of the labelled training rows, half on one of all training documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landframe.llm.common import column, documents, text_slices, words_of
from landframe.session import materialize

#: bounds: labelled rows per class that lexicon and classifier are fitted on, and entries
SAMPLE_PER_CLASS = 8_000
LEXICON = 1_000
FEATURES = 6_000
#: least log odds of a lexicon entry (at a tenth of toxic texts, nine in ten that hold it are)
#: and of a classifier feature, in either direction
MIN_LOG_ODDS = 4.5
FEATURE_LOG_ODDS = 2.0
PREDICT_AT = 0.7

PREFIXES = (4, 5, 6, 8)
LEXICON_VOTERS = 8

# Common English insults
INSULTS = ["idiot", "moron", "stupid", "scum", "loser", "pathetic", "worthless", "trash", "disgusting", "clown",
           "imbecile", "vermin", "filth", "dumb", "jerk", "bastard"]
_INSULTS = {w.encode() for w in INSULTS}
_ATTACK = re.compile(r"\b(?:you(?:'re| are)|tu es|vous êtes|du bist|ihr seid|eres)\s+(?:an?|une?|so|such an?|ein(?:e)?)?\s*(?:\w+\s+)?(?:"
                     + "|".join(INSULTS) + r")\b", re.I)
_SHOUT = re.compile(r"[!?]{3,}")
VOTERS = [*[f"lexicon {i}" for i in range(LEXICON_VOTERS)], "insults", "two entries", "attack", "shouting"]


def held_out(doc_id: Column) -> Column:
    """Rows of which no label may be learnt."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def text_features(text: str | None) -> set[bytes]:
    """Words (``=word``), their beginnings (``^begin``) and the beginnings found three times or
    more (``3begin``), in UTF-8 bytes."""
    out, begins = set(), Counter()
    for w, n in Counter(words_of(text)).items():
        out.add(b"=" + w)
        for k in PREFIXES:
            if len(w) > k:
                begins[w[:k]] += n
    out.update([b"^" + x for x in begins])
    out.update([b"3" + x for x, n in begins.items() if n > 2])
    return out


def vote(text: str | None, features: set[bytes], lexicon: dict[bytes, int]) -> int:
    """The votes of ``VOTERS`` as one number, two bits each: 0 abstains, 1 toxic, 2 clean."""
    hits = [lexicon[f] for f in features if f in lexicon]
    votes = [int(i in hits) for i in range(LEXICON_VOTERS)]
    insults = len([w for w in _INSULTS if b"=" + w in features])
    votes.append(int(insults > 0))
    votes.append(2 if not hits and not insults else int(len(hits) + insults > 1))
    votes.append(int(bool(text and insults and _ATTACK.search(text))))
    votes.append(int(bool(text and _SHOUT.search(text))))
    return sum(v << 2 * i for i, v in enumerate(votes))


class LabelModel:
    """Naive-Bayes mixture over vote patterns, fitted by EM with the class balance given.

    ``known`` counts, per pattern, the labelled training rows of both classes; they anchor
    the accuracies that the other rows' agreement refines."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, balance: float, known: np.ndarray, rounds: int = 60):
        votes = np.stack([(codes >> 2 * i) & 3 for i in range(len(VOTERS))], 1)
        self.known = known
        self.balance, self.weights = min(max(balance, 1e-4), 1 - 1e-4), np.ones(len(VOTERS))
        start = 1 / (1 + np.exp(-2.0 * ((votes == 1).sum(1) - 2.0 * (votes == 2).sum(1))))
        post = self._fit(votes, counts, start, rounds)
        # correlation of two voters beyond what the class explains
        signed = np.where(votes == 2, -1.0, votes)
        residual = np.zeros((len(VOTERS), len(VOTERS)))
        for p in (post, 1 - post):
            w = counts * p
            centred = signed - (w @ signed) / max(w.sum(), 1e-9)
            residual += (centred * w[:, None]).T @ centred
        scale = np.sqrt(np.maximum(np.diag(residual), 1e-9))
        self.correlation = residual / scale[:, None] / scale[None, :]
        strong = np.clip(np.abs(self.correlation) - 0.1, 0, None) * (1 - np.eye(len(VOTERS)))
        self.weights = 1 / (1 + strong.sum(1))
        self._fit(votes, counts, post, rounds)

    def _fit(self, votes, counts, post, rounds):
        for _ in range(rounds):
            self.table = np.empty((2, len(VOTERS), 3))  # P(vote | class)
            for y, p in enumerate((1 - post, post)):
                w = counts * p + self.known[y]
                for v in range(3):
                    self.table[y, :, v] = (w @ (votes == v) + 0.5) / (w.sum() + 1.5)
            post = self.posterior_of(votes)
        return post

    def posterior_of(self, votes: np.ndarray) -> np.ndarray:
        ratio = np.log(self.table[1]) - np.log(self.table[0])
        odds = np.log(self.balance / (1 - self.balance)) + sum(
            self.weights[i] * ratio[i, votes[:, i]] for i in range(len(VOTERS)))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        return self.posterior_of(np.stack([(codes >> 2 * i) & 3 for i in range(len(VOTERS))], 1))


def fit_linear(rows: list[np.ndarray], target: np.ndarray, weight: np.ndarray, size: int,
               rounds: int = 600, rate: float = 0.1, ridge: float = 1e-5) -> np.ndarray:
    """Logistic regression on sets of feature numbers by Adam; the last weight is the bias."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feature = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    w, m, v, weight = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1), weight / weight.sum()
    w[-1] = -2.0
    for step in range(1, rounds + 1):
        odds = np.bincount(at, w[feature], len(rows)) + w[-1]
        error = weight * (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - target)
        grad = np.append(np.bincount(feature, error[at], size)[:size], error.sum())
        grad[:-1] += ridge * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w


def hashed_low(key: Column, share: float) -> Column:
    """Whether a 64-bit hash is among the lowest ``share`` of all hashes."""
    return key <= F.lit(min(int(share * 2**64), 2**64 - 1) - 2**63)


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    per_class: int) -> tuple[DataFrame, float]:
    """At most about ``per_class`` labelled training rows of each class (those whose ids hash
    lowest) as ``text, label, weight``, and the share of toxic rows among all of them."""
    given = labels.select(column(labels, "doc_id").alias("id"), column(labels, label_col).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("id").isNotNull()).groupBy("id").agg(F.max("label").alias("label"))
    given = given.filter(~held_out(F.col("id")))
    found = {r["label"]: r["n"] for r in given.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = []
    for y, n in found.items():
        share = min(1.0, per_class / n)
        parts.append(given.filter((F.col("label") == y) & hashed_low(F.xxhash64("id"), share)).withColumn("weight", F.lit(1.0 / share)))
    if not parts:
        empty = docs.select(column(docs, text_col).alias("text")).limit(0)
        return empty.withColumns({"label": F.lit(0), "weight": F.lit(1.0)}), 0.1
    chosen = F.broadcast(reduce(DataFrame.unionByName, parts))  # bounded by 2 * per_class ids
    texts = docs.select(column(docs, id_col).alias("id"), column(docs, text_col).alias("text")).join(chosen, "id")
    # one text of each id, should a document be repeated
    sample = texts.groupBy("id").agg(*[F.min(c).alias(c) for c in ("text", "label", "weight")]).drop("id")
    return materialize(sample), found.get(1, 0) / sum(found.values())


def mine_features(sample: DataFrame, size: int) -> list[tuple[bytes, float]]:
    """The ``size`` features of the sample that tell toxic from clean texts best, with their
    log odds; counted in Spark over whole texts, at most ``size`` rows reach the driver."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for part in text_slices(batch, 1_000_000):
                sets = [text_features(t) for t in part.column("text").to_pylist()]
                rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                yield pa.RecordBatch.from_arrays([pa.array([f for s in sets for f in s], pa.binary()), part.column("label").take(pa.array(rows, pa.int64()))],
                                                 names=["feature", "label"])

    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return []
    counts = sample.select("text", "label").mapInArrow(run, "feature binary, label int").groupBy("feature").agg(
        F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))
    odds = F.log((F.col("t") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("c") + 0.5) / F.lit(clean + 1.0))
    # rarer features are chance as often as not: at 5 rows, 17 of 728 held-out alarms were false, here none
    least = max(3, toxic // 50)
    ranked = counts.withColumn("odds", odds).filter((F.abs("odds") > FEATURE_LOG_ODDS) & (F.col("t") + F.col("c") >= least))
    top = ranked.orderBy((F.abs("odds") * F.log(1.0 + F.col("t") + F.col("c"))).desc(), "feature").limit(size)
    return [(bytes(r["feature"]), r["odds"]) for r in top.collect()]


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int):
    """Feature numbers and weights (bias last) of the classifier, and the label model."""
    import pyarrow as pa

    sample, balance = training_sample(docs, labels, id_col, text_col, label_col, per_class)
    mined = mine_features(sample, FEATURES)
    numbers = {f: i for i, (f, _) in enumerate(mined)}
    # entries with a common beginning go to the same voter, so that voters repeat less
    toxic = [f for f, odds in mined if odds >= MIN_LOG_ODDS][:LEXICON]
    lexicon = {f: sum(f[1:5]) % LEXICON_VOTERS for f in toxic}
    shared = docs.sparkSession.sparkContext.broadcast((numbers, lexicon))

    def votes(batches: Iterator) -> Iterator:
        for batch in batches:
            for part in text_slices(batch):
                codes = [vote(t, text_features(t), shared.value[1]) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64())], names=["code"])

    def known(batches: Iterator) -> Iterator:
        for batch in batches:
            for part in text_slices(batch):
                codes, rows = [], []
                for t in part.column("text").to_pylist():
                    features = text_features(t)
                    codes.append(vote(t, features, shared.value[1]))
                    rows.append(sorted(shared.value[0][f] for f in features if f in shared.value[0]))
                yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(rows, pa.list_(pa.int32())), part.column("weight"), part.column("label")],
                                                 names=["code", "features", "weight", "label"])

    # agreement of the voters over all training documents, labelled or not
    texts = docs.filter(~held_out(column(docs, id_col))).select(column(docs, text_col).alias("text"))
    patterns = texts.mapInArrow(votes, "code long").groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()
    if not patterns or not mined:
        return numbers, np.append(np.zeros(len(numbers)), -2.0), None
    total = sum(r["n"] for r in patterns)
    share = min(1.0, per_class / total)
    key = column(docs, id_col)
    any_rows = docs.filter(~held_out(key) & key.isNotNull() & hashed_low(F.xxhash64(key, column(docs, text_col)), share)).select(
        column(docs, text_col).alias("text"), F.lit(-1).alias("label"), F.lit(1.0 / share).alias("weight"))
    kind = "code long, features array<int>, weight double, label int"
    rows = sample.select("text", "label", "weight").mapInArrow(known, kind).collect()
    place = {r["code"]: i for i, r in enumerate(patterns)}
    anchors = np.zeros((2, len(patterns)))
    for r in rows:
        anchors[r["label"], place[r["code"]]] += r["weight"]
    model = LabelModel(np.array(list(place)), np.array([float(r["n"]) for r in patterns]), balance, anchors)
    both = [rows, any_rows.mapInArrow(known, kind).collect()]
    halves = [np.array([r["weight"] for r in part]) for part in both]
    weight = np.concatenate([w / max(w.sum(), 1e-9) for w in halves])
    both = [r for part in both for r in part]
    target = model.posterior(np.array([r["code"] for r in both], np.int64))
    weights = fit_linear([np.array(r["features"], np.int64) for r in both], target, weight, len(numbers))
    return numbers, weights, model


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """One row per document row: ``doc_id, held_out, score, predicted``.

    Null and empty texts get the bias alone; without labels every score is low.  Null ids
    are never held out and never learnt from; repeated rows are scored each.
    """
    import pyarrow as pa

    numbers, weights, _ = fit(docs, labels, id_col, text_col, label_col, per_class)
    model = docs.sparkSession.sparkContext.broadcast(({f: float(weights[i]) for f, i in numbers.items()}, float(weights[-1])))
    slim = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        known, bias = model.value
        for batch in batches:
            for part in text_slices(batch):
                odds = [bias + sum(sorted(known[f] for f in text_features(t) if f in known)) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(odds, -30, 30))), pa.float64())], names=["doc_id", "score"])

    scored = slim.mapInArrow(run, f"doc_id {id_type}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))


def op10_toxicity(spark, sf_dir) -> DataFrame:
    """Toxicity of all documents, learnt from ``labels.toxic``."""
    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
