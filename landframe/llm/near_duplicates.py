"""N-gram Jaccard join by chosen paths.

Texts become sets of five-word shingles; equal sets are one class.  In each of several
independent runs every set follows the tokens that a shared hash picks with probability
1 / (threshold * size), so similar sets meet on common paths and others part: sets on a
path form a bucket, a bucket above ``BUCKET`` is split again by the next token of the paths,
and small buckets are compared by brute force on min-wise sketches.  Buckets only give a
spanning forest of candidate links.  The candidates' connected groups are then compared
exactly, set against set, in blocks, which also finds links that no path showed; nothing
ever emits all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landframe.llm import shingles
from landframe.llm.common import column, documents, text_slices
from landframe.session import materialize

THRESHOLD = 0.8
RECALL = 0.99999
#: part of the missed pairs allowed that the paths may miss; the rest is the sketches'
PATH_MISS = 0.85
#: largest bucket or block that one task compares, in sets; larger ones are split or cut into blocks
BUCKET = 2048
#: shingles of a block of the exact comparison (two blocks meet in a task)
BLOCK_SHINGLES = 2_000_000
DEPTH = 3
#: longest list of 64-bit keys that is broadcast (16 MB); a longer one is joined by a shuffle
BROADCAST_KEYS = 2_000_000


def describe_sets(docs: DataFrame, id_col: str, text_col: str, threshold: float, recall: float, depth: int) -> DataFrame:
    """One row per document row: ``doc_id, text_key, cls`` (name of the shingle set, null
    without words), ``n``, ``sketch`` and the paths ``p1..`` with their parents ``q1..``."""
    import pyarrow as pa

    text = column(docs, text_col)
    slim = docs.select(column(docs, id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()
    # a hot bucket compares its pairs at the last level only: they must meet there
    runs = shingles.runs_for(1 - PATH_MISS * (1 - recall), depth)
    longs = pa.list_(pa.int64())

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for part in text_slices(batch):
                cls, n, sketch, paths = [], [], [], [[[] for _ in range(depth)] for _ in range(2)]
                for t in part.column("text").to_pylist():
                    tokens = shingles.shingle_set(t)
                    n.append(len(tokens))
                    cls.append(shingles.set_id(tokens) if len(tokens) else None)
                    sketch.append(shingles.sketch(tokens) if len(tokens) else None)
                    levels = shingles.chosen_paths(tokens, threshold, runs, depth) if len(tokens) else [((), ())] * depth
                    for i, level in enumerate(levels):
                        paths[0][i].append(level[0])
                        paths[1][i].append(level[1])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(cls, pa.binary()), pa.array(n, pa.int32()), pa.array(sketch, pa.binary()),
                     *[pa.array(x, longs) for x in [*paths[0], *paths[1]]]],
                    names=["doc_id", "text_key", "cls", "n", "sketch", *[f"p{i + 1}" for i in range(depth)], *[f"q{i + 1}" for i in range(depth)]])

    arrays = "".join(f", {c}{i + 1} array<long>" for c in "pq" for i in range(depth))
    return slim.mapInArrow(run, f"doc_id {id_type}, text_key long, cls binary, n int, sketch binary{arrays}")


def groups_of(batches: Iterator, keys: list[str]) -> Iterator:
    """Runs of rows with equal ``keys`` in sorted Arrow batches, as pandas frames."""
    import pandas as pd

    rest = None
    for batch in batches:
        rows = batch.to_pandas()
        rows = rows if rest is None else pd.concat([rest, rows], ignore_index=True)
        if rows.empty:
            continue
        change = np.zeros(len(rows), bool)
        for k in keys:
            values = rows[k].to_numpy()
            change[1:] |= values[1:] != values[:-1]
        starts = [0, *np.flatnonzero(change).tolist()]
        for a, b in zip(starts, starts[1:]):
            yield rows.iloc[a:b]
        rest = rows.iloc[starts[-1]:]
    if rest is not None:
        yield rest


def in_block_pairs(rows: DataFrame, key: str, blocks: Column) -> DataFrame:
    """Deal groups out for comparison: a group of one block is one unit; others are cut into
    ``blocks`` by hash, and every pair of blocks is a unit (``lo``, ``hi``; ``side`` tells which
    of the two blocks a row is of)."""
    n = blocks.cast("int")
    # the hash of another number than the one that dealt rows before, else blocks are uneven
    own = F.pmod(F.xxhash64("cls", F.lit(11)), F.col("__n")).cast("int")
    return (
        rows.withColumn("__n", n).withColumn("__own", own)
        .withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
        .withColumn("lo", F.least("__own", "__other")).withColumn("hi", F.greatest("__own", "__other"))
        .withColumn("side", (F.col("__own") == F.col("hi")).cast("int"))
        .drop("__n", "__own", "__other")
        .repartition(key, "lo", "hi").sortWithinPartitions(key, "lo", "hi", "side")
    )


def checked(keys: DataFrame) -> tuple[DataFrame, int]:
    """A written list of keys, marked for broadcast if it is short, and its length."""
    keys = materialize(keys)
    n = keys.count()
    return (F.broadcast(keys) if n <= BROADCAST_KEYS else keys), n


def bucket_rows(classes: DataFrame, depth: int, bucket: int) -> DataFrame:
    """``path, cls, size`` of the buckets to compare: those of two sets or more that are small
    or cannot be split further."""
    done, parents = None, None
    for level in range(1, depth + 1):
        rows = classes.select("cls", F.explode(F.arrays_zip(f"p{level}", f"q{level}")).alias("x"))
        rows = rows.select("cls", F.col(f"x.p{level}").alias("path"), F.col(f"x.q{level}").alias("parent"))
        if parents is not None:  # written: they are counted, then joined with the counts
            rows = materialize(rows.join(parents, "parent", "left_semi").drop("parent"))
        rows = rows.drop("parent")
        sizes = materialize(rows.groupBy("path").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"))
        small = sizes if level == depth else sizes.filter(F.col("size") <= bucket)
        # joined on a hash beside the path: the count's partitioning is not reused, so a hot
        # path can still be split
        hashed = small.select(F.xxhash64("path").alias("k"), F.col("path").alias("p"), "size")
        found = rows.join(hashed, (F.xxhash64("path") == F.col("k")) & (F.col("path") == F.col("p"))).select("path", "cls", "size")
        done = found if done is None else done.unionByName(found)
        if level == depth:
            break
        parents, n = checked(sizes.filter(F.col("size") > bucket).select(F.col("path").alias("parent")))
        if not n:
            break
    return done


def candidate_links(classes: DataFrame, threshold: float, recall: float, depth: int, bucket: int) -> DataFrame:
    """``a, b``: a spanning forest, per bucket, of the sets that their sketches let be similar."""
    import pyarrow as pa

    need = shingles.sketch_cutoff(threshold, (1 - PATH_MISS) * (1 - recall))
    rows = bucket_rows(classes, depth, bucket).join(classes.select("cls", "n", "sketch"), "cls")
    dealt = in_block_pairs(rows, "path", F.ceil(F.col("size") / bucket)).select("path", "lo", "hi", "cls", "n", "sketch")

    def run(batches: Iterator) -> Iterator:
        a, b = [], []
        for group in groups_of(batches, ["path", "lo", "hi"]):
            if len(group) < 2:
                continue
            cls = group["cls"].tolist()
            sketches = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(len(group), -1)
            for u, v in shingles.similar_forest(sketches, group["n"].to_numpy(), threshold, need):
                a.append(cls[u])
                b.append(cls[v])
            if len(a) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return dealt.mapInArrow(run, "a binary, b binary").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``cls, comp`` of every node of the links ``a, b``.

    In each round every node moves to its smallest neighbour (or stays), and links between
    the places moved to are the next round's.  Names are hashes, so a constant part of the
    nodes goes in each round; all tables are written, and only a count reaches the driver.
    """
    edges, moved = materialize(edges), None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("cls"), F.least("a", "m").alias("to")))
        if moved is None:
            moved = least
        else:
            moved = materialize(moved.join(least.select(F.col("cls").alias("at"), F.col("to").alias("next")), F.col("to") == F.col("at"), "left")
                                .select("cls", F.coalesce("next", "to").alias("to")))
        left = least.select(F.col("cls").alias("a"), F.col("to").alias("a2"))
        right = least.select(F.col("cls").alias("b"), F.col("to").alias("b2"))
        edges = materialize(edges.join(left, "a").join(right, "b").filter("a2 <> b2")
                            .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct())
    if moved is None:
        return edges.select(F.col("a").alias("cls"), F.col("b").alias("comp"))
    return moved.select("cls", F.col("to").alias("comp"))


def verified_links(docs: DataFrame, id_col: str, text_col: str, members: DataFrame, threshold: float) -> DataFrame:
    """Exact join inside candidate groups: ``cls, other, degree``; ``other`` a neighbour in a
    spanning forest (null at its root), degrees to be summed per class.

    ``members`` (cls, comp, blocks, doc, text_key) names one document of each class, whose text
    is read again; only texts in candidate groups reach the exact comparison, a group cut into
    ``blocks``.  Of rows that repeat a document, each task passes one on.
    """
    import pyarrow as pa

    text = column(docs, text_col)
    texts = docs.select(column(docs, id_col).alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))
    members = materialize(members)
    keys, n = checked(members.select(F.col("text_key").alias("key")).distinct())
    if n <= BROADCAST_KEYS:  # texts outside the groups are then left out before the shuffle
        texts = texts.join(keys, "key", "left_semi")
    given = texts.join(members, texts["key"].eqNullSafe(members["text_key"]) & texts["doc_id"].eqNullSafe(members["doc"])).select("cls", "comp", "blocks", "text")

    def sets(batches: Iterator) -> Iterator:
        seen = set()
        for batch in batches:
            for part in text_slices(batch):
                cls, keep, tokens = part.column("cls").to_pylist(), [], []
                for i, t in enumerate(part.column("text").to_pylist()):
                    if cls[i] in seen:
                        continue
                    s = shingles.shingle_set(t)
                    if len(s) and shingles.set_id(s) == cls[i]:
                        seen.add(cls[i])
                        keep.append(i)
                        tokens.append(s.tobytes())
                rest = part.take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays([rest.column("cls"), rest.column("comp"), rest.column("blocks"), pa.array(tokens, pa.binary())],
                                                 names=["cls", "comp", "blocks", "tokens"])

    dealt = in_block_pairs(given.mapInArrow(sets, "cls binary, comp binary, blocks long, tokens binary"), "comp", F.col("blocks"))

    def run(batches: Iterator) -> Iterator:
        for group in groups_of(batches, ["comp", "lo", "hi"]):
            group = group.drop_duplicates("cls")  # one row per class, should a document be repeated
            if len(group) < 2:
                continue
            across = group["lo"].iloc[0] != group["hi"].iloc[0]
            split = int((group["side"] == 0).sum()) if across else None
            if split in (0, len(group)):
                continue
            cls = group["cls"].tolist()
            degree, edges = shingles.similar_pairs([np.frombuffer(x, np.uint64) for x in group["tokens"]], threshold, split)
            parent = {v: u for u, v in edges}
            mine = np.flatnonzero(degree)
            yield pa.RecordBatch.from_arrays(
                [pa.array([cls[i] for i in mine], pa.binary()), pa.array([cls[parent[i]] if i in parent else None for i in mine], pa.binary()),
                 pa.array(degree[mine], pa.int64())], names=["cls", "other", "degree"])

    return dealt.select("comp", "lo", "hi", "side", "cls", "tokens").mapInArrow(run, "cls binary, other binary, degree long")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                 recall: float = RECALL, bucket: int = BUCKET, depth: int = DEPTH) -> DataFrame:
    """One row per document row: ``doc_id, text_key, cls, comp, class_id, copy_of, n_copies,
    n_links`` (``cls`` names the shingle set, ``comp`` the connected group).

    ``class_id`` is the smallest id of the documents connected by links, ``copy_of`` that of
    the documents with the same shingle set (``n_copies`` rows), ``n_links`` the number of
    other sets with a Jaccard similarity of ``threshold`` or more.  A document without words
    (null text too) is its own class without links.  Repeated rows are copies; null ids come
    after all others.  An empty table gives no rows.
    """
    described = materialize(describe_sets(docs, id_col, text_col, threshold, recall, depth))
    sets = described.filter("cls is not null")
    paths = [f"{c}{i + 1}" for i in range(depth) for c in "pq"]
    # nulls last; equal sets have equal sketches and paths
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key"))
    classes = materialize(
        sets.groupBy("cls").agg(first.alias("first"), F.count(F.lit(1)).alias("n_copies"), *[F.first(c).alias(c) for c in ["n", "sketch", *paths]])
        .withColumns({"doc": F.col("first.doc_id"), "text_key": F.col("first.text_key")}).drop("first"))

    groups = components(candidate_links(classes, threshold, recall, depth, bucket))
    found = groups.join(classes.select("cls", "doc", "text_key", "n"), "cls")
    # a block is bounded by its sets and by their shingles
    sizes = found.groupBy("comp").agg(F.greatest(F.ceil(F.count(F.lit(1)) / bucket), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    members = found.drop("n").join(sizes, "comp")
    links = materialize(verified_links(docs, id_col, text_col, members, threshold))

    linked = components(links.filter("other is not null").select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b")).distinct())
    degrees = links.groupBy("cls").agg(F.sum("degree").alias("n_links"))
    named = classes.select("cls", "doc", "n_copies").join(linked, "cls", "left").join(degrees, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    named = materialize(named)
    ids = named.groupBy("comp").agg(F.min("doc").alias("class_id"))
    table = named.join(ids, "comp").select(F.xxhash64("cls").alias("k"), F.col("cls").alias("c"), "comp", "class_id", F.col("doc").alias("copy_of"),
                                           "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    slim = described.select("doc_id", "text_key", "cls")
    # joined on a hash beside the name: both sides are exchanged anew, so a hot class is split
    known = slim.filter("cls is not null").join(table, (F.xxhash64("cls") == F.col("k")) & (F.col("cls") == F.col("c"))).drop("k", "c")
    alone = slim.filter("cls is null").withColumns({"comp": F.lit(None).cast("binary"), "class_id": F.col("doc_id"), "copy_of": F.col("doc_id"), "n_copies": F.lit(1).cast("long"), "n_links": F.lit(0).cast("long")})
    return known.unionByName(alone)


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class of near duplicates: the row of the smallest id (of
    rows with that id, one of the smallest text key).  All columns are kept.

    Rows of one id and text are made one before their texts are shuffled; the texts are
    shuffled once.
    """
    joined = jaccard_join(docs, id_col, text_col)
    alone = joined.filter("cls is null").select("doc_id", "text_key").distinct()
    first = joined.filter("cls is not null").groupBy("comp").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("row")).select("row.doc_id", "row.text_key")
    kept = first.unionByName(alone).toDF("__id", "__key")
    held = docs.select(F.struct(*[column(docs, c) for c in docs.columns]).alias("row"))
    rows = held.select("row", F.col("row")[id_col].alias("__id"), F.xxhash64(F.col("row")[text_col]).alias("__key"))
    once = rows.dropDuplicates(["__id", "__key"]).alias("r")
    kept = kept.alias("k")
    same = F.col("r.__id").eqNullSafe(F.col("k.__id")) & F.col("r.__key").eqNullSafe(F.col("k.__key"))
    return once.join(kept, same, "left_semi").select("row.*")


def op7_jaccard_join(spark, sf_dir) -> DataFrame:
    """Near duplicates among all documents."""
    return jaccard_join(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links", "copy_of", "n_copies")


ORACLE = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT r, doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
        lambda i: array_to_string(w[i:i + 4], ' ')))) AS tokens FROM d WHERE len(w) > 0),
c AS (SELECT row_number() OVER () AS id, tokens, len(tokens) AS n, min(doc_id) AS doc, count(*) AS n_copies FROM s GROUP BY tokens),
t AS (SELECT id, n, unnest(tokens) AS token FROM c),
links AS (SELECT x.id AS a, y.id AS b FROM t x JOIN t y ON x.token = y.token AND x.id <> y.id
    GROUP BY x.id, y.id, x.n, y.n HAVING 10 * count(*) >= 8 * (x.n + y.n - count(*))),
reach AS (SELECT id AS a, id AS b FROM c UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
cls AS (SELECT reach.a AS id, min(c.doc) AS class_id FROM reach JOIN c ON c.id = reach.b GROUP BY reach.a),
deg AS (SELECT a AS id, count(*) AS n_links FROM links GROUP BY a)
SELECT s.doc_id, cls.class_id, coalesce(n_links, 0)::BIGINT AS n_links, c.doc AS copy_of, c.n_copies
FROM s JOIN c USING (tokens) JOIN cls ON cls.id = c.id LEFT JOIN deg ON deg.id = c.id
UNION ALL SELECT doc_id, doc_id, 0, doc_id, 1 FROM d WHERE len(w) = 0"""
