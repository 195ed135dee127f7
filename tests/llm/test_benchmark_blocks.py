"""A benchmark of several blocks, searched one at a time, finds what one block finds."""

import random

from landframe.llm import decontaminate as dc


def tables(spark):
    rng = random.Random(12)
    voc = [f"w{i}" for i in range(40)]
    items = [(f"i{k % 25}", " ".join(rng.choices(voc, k=rng.randrange(0, 30)))) for k in range(40)] + [(None, "solo words here"), ("e", ""), ("e", None)]
    docs = []
    for i in range(200):
        text = " ".join(rng.choices(voc, k=rng.randrange(0, 60)))
        for _ in range(rng.randrange(3)):
            text += ". " + (rng.choice(items)[1] or "").upper()
        docs.append((i, text))
    docs += [(7, None), (7, None), (8, ""), (9, items[0][1] + " " + items[1][1]), (None, "Solo, words; here")]
    # the words around a cut form a window of another item
    docs.append((300, "w1 w2 w3 w4 w5 " + " ".join(f"z{i}" for i in range(12)) + " w6 w7 w8 w9 w10"))
    items += [("inner", " ".join(f"z{i}" for i in range(12))), ("outer", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10")]
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id string, text string"))


def both(spark, monkeypatch, run):
    docs, benchmark = tables(spark)
    out = []
    for size in (16_000_000, 300):
        monkeypatch.setattr(dc, "BLOCK_BYTES", size)
        assert (dc.benchmark_blocks(benchmark)[0] > 5) == (size == 300)
        out.append(sorted(map(repr, run(docs, benchmark).collect())))
    return out


def test_found_alike(spark, monkeypatch):
    one, many = both(spark, monkeypatch, lambda d, b: dc.find_benchmark_overlap(d, b).select("doc_id", "n_words", "n_hit", "items", "spans"))
    assert one == many and len(one) == 206 and sum("n_hit=0" not in r for r in one) > 50


def test_removed_alike(spark, monkeypatch):
    one, many = both(spark, monkeypatch, dc.remove_benchmark_overlap)
    assert one == many and 100 < len(one) < 206 and not any("doc_id=300" in r for r in one)


def test_tasks_hold_one_block(spark, monkeypatch):
    docs, benchmark = tables(spark)
    monkeypatch.setattr(dc, "BLOCK_BYTES", 300)
    alive, most = [], []
    real = dc.benchmark_blocks

    def counted(*args):
        n, block = real(*args)

        def one(b):
            tests = block(b)
            alive.append(b)
            most.append(len(alive))
            end = tests.destroy
            tests.destroy = lambda: (alive.remove(b), end())
            return tests
        return n, one

    monkeypatch.setattr(dc, "benchmark_blocks", counted)
    dc.find_benchmark_overlap(docs, benchmark).count()
    assert max(most) == 1 and not alive
