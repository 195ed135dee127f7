"""Jaccard join, PII surrogates and toxicity against brute force and held-out accuracy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from landframe.llm import near_duplicates, pii, shingles, surrogates, toxicity
from landframe.llm.common import words_of


def near_copies(seed, groups, size, words=60):
    random.seed(seed)
    texts = []
    for g in range(groups):
        base = [f"g{g}x{i}" for i in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(random.randint(0, 2)):
                copy[random.randrange(words)] = f"r{random.random()}"
            texts.append(" ".join(copy))
    return texts


def brute_join(texts, t=0.8):
    sets = [frozenset(" ".join(map(bytes.decode, w[i:i + 5])) for i in range(max(1, len(w) - 4))) if (w := words_of(x)) else None for x in texts]
    link = [[j for j, b in enumerate(sets) if a and b and a != b and len(a & b) >= t * len(a | b) - 1e-9] for a in sets]
    same = [[j for j, b in enumerate(sets) if a and a == b] or [i] for i, a in enumerate(sets)]
    out = []
    for i in range(len(texts)):
        seen, todo = set(), [i]
        while todo:
            u = todo.pop()
            if u not in seen:
                seen.add(u)
                todo += link[u] + same[u]
        out.append((min(seen), len({sets[j] for j in link[i]}), min(same[i]), len(same[i])))
    return out


@pytest.mark.parametrize("bucket", [2048, 4])  # 4: buckets are split and groups cut into blocks
def test_jaccard_join_as_brute_force(spark, bucket):
    shared = " ".join(f"s{i}" for i in range(20))
    texts = near_copies(1, 6, 9) + [shared + " " + " ".join(f"u{j}_{i}" for i in range(40)) for j in range(25)]
    texts += [None, "", "...", "one two", "One, two", "one two three four five six", None] + [texts[0]] * 5
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, cls string, path int")
    out = near_duplicates.jaccard_join(docs, bucket=bucket).collect()
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["copy_of"], r["n_copies"]) for r in out}
    assert len(out) == len(texts) and got == dict(enumerate(brute_join(texts)))
    kept = near_duplicates.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c[0] for c in brute_join(texts)})


def test_repeated_rows_null_ids_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (1, text), (None, text), (2, "other words only here"), (2, None), (None, None), (1, "quite another text of this id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = near_duplicates.jaccard_join(docs)
    assert out.count() == len(rows) and {r["class_id"] for r in out.filter("n_copies = 3").collect()} == {1}
    assert near_duplicates.keep_one_of_each(docs).count() == 5  # the three copies are one row
    assert near_duplicates.jaccard_join(docs.limit(0)).count() == 0
    assert near_duplicates.keep_one_of_each(docs.limit(0)).count() == 0


def test_first_paths_meet_as_often_as_claimed():
    random.seed(2)
    runs, met = shingles.runs_for(0.99), 0
    for k in range(300):
        base = [f"{k}w{i}" for i in range(204)]
        copy = list(base)
        for i in random.sample(range(5, 195, 5), 4):
            copy[i] = "new"
        a, b = (shingles.shingle_set(" ".join(x)) for x in (base, copy))
        assert 0.8 <= len(np.intersect1d(a, b)) / len(np.union1d(a, b)) < 0.85
        met += bool(len(np.intersect1d(*[shingles.chosen_paths(x, 0.8, runs, 1)[0][0] for x in (a, b)])))
    assert met >= 294


def test_pairs_of_split_buckets_meet_at_full_depth():
    random.seed(3)
    depth = near_duplicates.DEPTH
    runs, met = shingles.runs_for(0.99, depth), 0
    for k in range(300):
        base = [f"{k}w{i}" for i in range(204)]
        copy = list(base)
        for i in random.sample(range(5, 195, 5), 4):
            copy[i] = "new"
        a, b = (shingles.shingle_set(" ".join(x)) for x in (base, copy))
        met += bool(len(np.intersect1d(*[shingles.chosen_paths(x, 0.8, runs, depth)[-1][0] for x in (a, b)])))
    assert met >= 294


def test_runs_and_sketches_together_miss_no_more_than_claimed(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(300)))], "doc_id long, text string")
    row = near_duplicates.describe_sets(docs, "doc_id", "text", near_duplicates.THRESHOLD, near_duplicates.RECALL, 3).first()
    runs = len(set(row["q1"]))  # runs that chose a token; each chooses 1.25 in the mean
    assert runs >= 13
    die = 0.0
    for _ in range(3):
        die = np.exp(die - 1)
    miss = 1 - near_duplicates.RECALL
    runs = shingles.runs_for(1 - near_duplicates.PATH_MISS * miss, 3)
    need = shingles.sketch_cutoff(near_duplicates.THRESHOLD, (1 - near_duplicates.PATH_MISS) * miss)
    t = near_duplicates.THRESHOLD
    below = sum(shingles.math.comb(shingles.SKETCH, k) * t ** k * (1 - t) ** (shingles.SKETCH - k) for k in range(need))
    assert die ** runs + below <= miss
    sketches = np.zeros((2, shingles.SKETCH), np.uint8)
    sketches[1, need:] = 1
    assert shingles.similar_forest(sketches, np.array([100, 100]), t, need) == [(0, 1)]


PII = ["Write to Ann.Lee7@mail3.example.com or ann.lee7@MAIL3.example.com, +1 (017) 555-7713 or +1 (017) 555 7713.",
       "Card 4716 9107 3314 3313 and 4716910733143313, account 1234567890123456, host 10.23.7.201, SSN 123-45-6789.",
       "Dr. Maria Schmidt met Hans Weber. SCHMIDT left; Иван Петров, Петров.", "IBAN DE89370400440532013000.",
       "Nothing here: version 2.0, 1999-2000, Maria walked, v1.2.3.4.5, 12345.", None, "", "ann.lee7@mail3.example.com again"]


def test_surrogates_are_consistent_distinct_and_of_the_same_type(spark):
    docs = spark.createDataFrame([(i % 5, t, 9) for i, t in enumerate(PII + [PII[0]])], "doc_id long, text string, kind int")
    out = pii.replace_pii(docs, b"key", count=True)
    assert out.columns == ["doc_id", "text", "kind", "n_entities"] and out.count() == len(PII) + 1
    texts = {r["text"] for r in out.collect()}
    assert {PII[4], None, ""} <= texts
    mapping = {}
    for t in PII:
        for a, b, kind, norm in surrogates.find_entities(t):
            mapping[kind, norm] = surrogates.surrogate(kind, norm, b"key", 0)
    assert {surrogates.replace_entities(t, mapping) if t else t for t in PII} == texts
    everything = "\n".join(t for t in texts if t)
    for old in ("lee7", "555-7713", "4716910733143313", "1234567890123456", "10.23.7.201", "123-45-6789", "Schmidt", "Петров", "DE8937"):
        assert old.lower() not in everything.lower()
    again = {(k, n): [x for _, _, x, _ in surrogates.find_entities(surrogates.render(n, k, new))] for (k, n), new in mapping.items() if k in ("ip", "card", "account", "iban", "email")}
    assert all(kinds == [k] for (k, _), kinds in again.items()), again
    assert mapping["given", "maria"] in {n.casefold() for n in surrogates.GIVEN_NAMES["latin", "f"]}
    assert pii.replace_pii(docs.limit(0), b"key").count() == 0


def test_collisions_are_drawn_again(spark):
    first = "11+5557713000"
    taken = surrogates.surrogate("phone", first, b"k", 0)  # is itself a number of the corpus
    small = [("ip", f"{i}.{j}.1.1") for i in range(10) for j in range(10)]  # a crowded space: 10^4 for one format
    entities = spark.createDataFrame([("phone", first), ("phone", taken), *small], "kind string, norm string")
    out = pii.assign_surrogates(entities, b"k").collect()
    new = [(r["kind"], r["new"]) for r in out]
    assert len(out) == 102 and len(set(new)) == 102 and not set(new) & {(r["kind"], r["norm"]) for r in out}


def test_more_entities_than_a_format_has_free_values(spark):
    rows = [("ip", f"{n // 1000}.{n // 100 % 10}.{n // 10 % 10}.{n % 10}") for n in range(5200)]
    out = pii.assign_surrogates(spark.createDataFrame(rows, "kind string, norm string"), b"k").collect()
    new = {r["new"] for r in out}
    assert len(out) == len(new) == 5200 and not new & {n for _, n in rows}
    assert {k for x in new for _, _, k, _ in surrogates.find_entities(x)} == {"ip"}


@pytest.mark.parametrize("kind, norm", [("ip", "1.2.3.4"), ("ssn", "123456789"), ("phone", "1+5557713000"), ("iban", "DE89370400440532013000"),
                                        ("card", "4716910733143313"), ("account", "1234567890123456"), ("email", "a@b.org"), ("surname", "li")])
def test_every_kind_grows(kind, norm):
    assert len(surrogates.surrogate(kind, norm, b"k", 99)) > len(norm)


def found(text):
    return [(text[a:b], kind) for a, b, kind, _ in surrogates.find_entities(text)]


@pytest.mark.parametrize("text, names", [
    ("Maria Anna Schmidt met William Robert Jones", "Maria Anna Schmidt William Robert Jones"),
    ("then Anna von Berg and Hans van der Meer left; Maria Garc\u00eda M\u00e1rquez", "Anna Berg Hans Meer Maria Garc\u00eda M\u00e1rquez"),
    ("(Maria\nSchmidt) saw Peter\u00a0 F. Lee\nThe end. The Lee's house", "Maria Schmidt Peter Lee Lee"),
    ("Mr Oliver Twist, Frau Dr. Huber, my name is Olivia Jones. Anna-Maria Weber", "Oliver Twist Huber Olivia Jones Anna-Maria Weber"),
    ("\u041c\u0430\u0440\u0438\u044f \u043f\u043e\u0448\u043b\u0430 \u043a \u0418\u0432\u0430\u043d\u0443. Maria\n\nSchmidt. Maria walked. Hans The", ""),
])
def test_names_of_several_words(text, names):
    assert [t for t, _ in found(text)] == names.split()


@pytest.mark.parametrize("text, kind", [("020 7946 0958", "phone"), ("01 42 34 56 78", "phone"), ("01.42.34.56.78", "phone"), ("(020) 7946 0958", "phone"),
                                        ("0171/1234567", "phone"), ("07700 900123", "phone"), ("2001:db8::8a2e:370:7334", "ip"), ("fe80::1", "ip"),
                                        ("2001:0db8:85a3:0000:0000:8a2e:0370:7334", "ip"), ("::ffff:10.2.3.4", "ip")])
def test_national_phones_and_ipv6(text, kind):
    assert found(f"see {text}, or") == [(text, kind)] and found(f"tel: 555 0187 x {text}.") == [("555 0187", "phone"), (text, kind)]
    (_, _, _, norm), = surrogates.find_entities(text)
    new = surrogates.render(text, kind, surrogates.surrogate(kind, norm, b"k", 0))
    assert new != text and found(new) == [(new, kind)]
    again, = surrogates.find_entities(new)
    assert again[3] == surrogates.surrogate(kind, norm, b"k", 0)


@pytest.mark.parametrize("text", ["12:30:45", "00:1A:2B:3C:4D:5E", "std::dec add::be ::1", "01-02-2003", "01.02.2003 12:30", "0.123456789", "0306406157", "1 000 000 000"])
def test_no_phones_and_addresses(text):
    assert found(text) == []


def test_given_names_map_one_to_one():
    for names in surrogates.GIVEN_NAMES.values():
        new = [surrogates.surrogate("given", n.casefold(), b"k", 0) for n in names]
        assert sorted(new) == sorted(n.casefold() for n in names) and all(a != b.casefold() for a, b in zip(new, names))


def toxic_corpus(spark, n=1500):
    random.seed(11)
    voc = [a + b + c for a in ("ka", "lo", "mi", "tu") for b in ("ren", "sal", "dor") for c in ("", "a", "en", "ist")]
    rows, labels = [], []
    for i in range(n):
        words, toxic = random.choices(voc, k=random.randint(20, 120)), int(i % 6 == 0)
        if toxic:
            bad = ["idiot", "scum", "moron"] if i % 4 else ["zefro" + x for x in ("na", "li", "po")]
            for w in random.choices(bad, k=4):
                words.insert(random.randrange(len(words)), w)
        rows.append((i, " ".join(words), "idiot"))
        labels.append((i, toxic))
    rows += [(None, None, ""), (n, "", "")]
    return spark.createDataFrame(rows, "doc_id long, text string, label string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_corpus(spark)
    out = toxicity.score_toxicity(docs, labels)
    assert out.count() == docs.count() and out.filter("score is null or score < 0 or score > 1").count() == 0
    held = out.join(labels, "doc_id").filter("held_out")
    assert held.count() > 300 and held.filter("predicted <> toxic").count() <= 0.02 * held.count()
    # held-out labels are never read
    other = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {r["doc_id"]: r["score"] for r in out.collect()}
    b = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, other).collect()}
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_toxicity_without_labels_or_documents(spark):
    docs, labels = toxic_corpus(spark, 60)
    assert toxicity.score_toxicity(docs, labels.limit(0)).filter("predicted = 1").count() == 0
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def test_query_on_held_out_rows_of_the_test_tables(spark):
    out = toxicity.op10_toxicity(spark, "/root/testdata/sf0.1").filter("held_out")
    held = out.join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    hits, toxic, wrong = held.selectExpr("sum(predicted * toxic)", "sum(toxic)", "sum(predicted * (1 - toxic))").first()
    assert hits >= 0.75 * toxic and wrong <= 0.05 * toxic
