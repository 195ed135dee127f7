"""Merkle manifest against a tree built whole, level by level."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from landframe.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(leaves, arity=3):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i:i + arity])) for i in range(0, len(out[-1]), arity)])
    return out


def siblings(tree, i, arity=3):
    steps = []
    for level in tree[:-1]:
        a = i // arity * arity
        steps.append((level[a:i], level[i + 1:a + arity]))
        i //= arity
    return steps


def brute(rows, arity=3):
    """Sorted (doc_id, leaf, subroot, root, proof digest, folded root, verified)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    def none_first(v):
        return (v is not None, v.encode() if isinstance(v, str) else v or 0)
    names = sorted(groups, key=none_first)
    for n in names:
        groups[n].sort(key=lambda r: (none_first(r[0]), leaf_of(r)))
    trees = {n: levels([leaf_of(r) for r in groups[n]], arity) for n in names}
    top = levels([trees[n][-1][0] for n in names], arity)
    out = []
    for k, n in enumerate(names):
        for i, r in enumerate(groups[n]):
            proof = siblings(trees[n], i, arity) + siblings(top, k, arity)
            folded = leaf_of(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                folded = leaf_of((*r[:4], r[4].replace("\n", "")))
            for a, b in proof:
                folded = digest("".join(a) + folded + "".join(b))
            out.append((r[0], leaf_of(r), trees[n][-1][0], top[-1][0], digest("".join("".join(a) + "".join(b) for a, b in proof)), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def run_query(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    return merkle.op13_merkle_manifest(spark, str(tmp_path))


def test_query_as_brute_force(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "a", "a", "é", "Z", "b/*", "", None]), rng.choice(["en", None]), rng.choice([None, i]),
             rng.choice(["x\ny", "", None, "né\n" * 3, "same"])) for i in range(400)]
    rows += [(None, "a", None, None, None), (None, "a", None, None, "t\n"), (7, "lone", "en", 1, "q\n" * 50_000)]
    rows += [(5, "a", "en", 5, "tie")] * 7  # rows repeated altogether
    rng.shuffle(rows)
    got = sorted((tuple(r) for r in run_query(spark, tmp_path, rows).collect()), key=repr)
    assert got == brute(rows)
    assert not all(g[-1] for g in got) and any(g[-1] for g in got)


@pytest.mark.parametrize("rows", [[], [(1, "s", None, None, None)], [(1, None, None, None, "a\nb"), (1, None, None, None, "a\nb")]])
def test_empty_lone_and_repeated(spark, tmp_path, rows):
    got = sorted((tuple(r) for r in run_query(spark, tmp_path, rows).collect()), key=repr)
    assert got == brute(rows)


@pytest.mark.parametrize("arity,block_levels", [(2, 1), (2, 3), (3, 1), (3, 2), (5, 2)])
def test_any_block_size_gives_the_same_proofs(spark, arity, block_levels):
    """Many rounds of small blocks, one hot group, and kept columns with clashing names."""
    rows = [(i, "hot" if i % 3 else f"g{i % 11}") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, grp string").repartition(7)
    df = df.withColumn("a.b", F.col("id") * 2).withColumn("tree", F.lit(1))
    out = merkle.merkle_manifest(df, merkle.leaf_digest([F.col("id")]), F.col("grp"), F.col("id"),
                                 {"id": F.col("id"), "a.b": F.col("`a.b`"), "tree": F.col("tree"), "grp": F.col("grp")}, arity, block_levels)
    groups = defaultdict(list)
    for i, g in rows:
        groups[g].append(leaf_of((i,)))
    names = sorted(groups)
    trees = {g: levels(groups[g], arity) for g in names}
    top = levels([trees[g][-1][0] for g in names], arity)
    folded = out.withColumn("folded", merkle.fold_proof(F.col("leaf"), F.col("proof"))).collect()
    assert len(folded) == len(rows)
    for r in folded:
        steps = siblings(trees[r["grp"]], r["leaf_index"], arity) + siblings(top, names.index(r["grp"]), arity)
        assert r["proof"] == "/".join("".join(a) + "*" + "".join(b) for a, b in steps)
        assert (r["root"], r["subroot"], r["folded"], r["a.b"]) == (top[-1][0], trees[r["grp"]][-1][0], top[-1][0], 2 * r["id"])


def test_queue_stays_small(monkeypatch):
    """Labels in post-order: a sweep holds a few messages a level, not a block."""
    sizes = []
    push = merkle.heappush
    monkeypatch.setattr(merkle, "heappush", lambda q, x: (push(q, x), sizes.append(len(q))))
    nodes = merkle.climb([str(i) for i in range(3 ** 7 + 5)], 8, 3)
    merkle.descend(nodes, "", 3)
    assert max(sizes) <= 3 * 9
