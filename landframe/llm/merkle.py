"""Merkle manifest of a dataset: one digest a row, a tree a group, one root, a proof a row.

The trees are worked by time-forward processing.  Nodes are labelled by (last leaf below,
level), so that children come before their parent; a node's digest is a message to its parent,
kept in a priority queue ordered by label until the parent is due.  A sweep in the reversed
order then delivers to each node the part of the proof that lies above it.

The queue's external part is Spark's sort: a tree is cut into aligned blocks of
``arity ** block_levels`` leaves, whatever the size of its group, and messages between blocks
are rows sorted by (tree, block, position).  Inside a block the queue holds a few messages a
level.  Blocks' tops are the leaves of the next round, so rounds grow with the logarithm of
the largest group and no group is ever gathered in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from heapq import heappop, heappush

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landframe.llm.common import column, documents
from landframe.session import materialize

#: in a step of a proof: the place of the node itself among its siblings; between steps
SELF, STEP = "*", "/"
QUERY_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(cols: Sequence[Column]) -> Column:
    """Digest of a row: each value as ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*[part(c) for c in cols]), 256)


def levels_above(n: int, arity: int) -> int:
    """Levels above ``n`` leaves until one node remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


def climb(leaves: Sequence[str], top: int, arity: int) -> list[list[str]]:
    """Digests of all nodes, by level, of ``top`` levels above the leaves."""
    nodes: list[list[str]] = [list(leaves)] + [[] for _ in range(top)]
    last, queue = len(leaves) - 1, []

    def send(level: int, index: int, digest: str) -> None:
        if level < top:
            parent = index // arity
            heappush(queue, (min((parent + 1) * arity ** (level + 1) - 1, last), level + 1, parent, index, digest))

    for i, leaf in enumerate(leaves):
        send(0, i, leaf)
        while queue and queue[0][0] <= i:
            label, parts = queue[0][:3], []
            while queue and queue[0][:3] == label:
                parts.append(heappop(queue)[4])
            digest = sha256_hex("".join(parts))
            nodes[label[1]].append(digest)
            send(label[1], label[2], digest)
    return nodes


def descend(nodes: list[list[str]], suffix: str, arity: int) -> list[str]:
    """Proofs of the leaves, given the proof ``suffix`` of the topmost node: the reversed sweep."""
    top, last = len(nodes) - 1, len(nodes[0]) - 1
    proofs = [""] * len(nodes[0])
    queue = [(-last, -top, 0, suffix)]
    while queue:
        _, level, index, above = heappop(queue)
        if not level:
            proofs[index] = above
            continue
        below, first = -level - 1, index * arity
        run = nodes[below][first:first + arity]
        for j in range(len(run)):
            step = "".join(run[:j]) + SELF + "".join(run[j + 1:])
            end = min((first + j + 1) * arity ** below - 1, last)
            heappush(queue, (-end, -below, first + j, step + STEP + above if above else step))
    return proofs


def fold_proof(digest: Column, proof: Column) -> Column:
    """Root that a leaf's digest and its proof give (native functions only)."""
    steps = F.filter(F.split(proof, STEP), lambda s: s != "")
    return F.aggregate(steps, digest, lambda d, s: F.sha2(F.replace(s, F.lit(SELF), d), 256))


def _whole_blocks(batches: Iterator, pa) -> Iterator:
    """Tables that end where a (tree, block) ends; rows must be sorted by both."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        *_, (cut, _) = _ranges(held.column("tree").to_pylist(), held.column("block").to_pylist())
        if cut:
            yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None:
        yield held


def _ranges(trees: list, blocks: list) -> Iterator[tuple[int, int]]:
    start = 0
    for i in range(1, len(trees) + 1):
        if i == len(trees) or trees[i] != trees[start] or blocks[i] != blocks[start]:
            yield start, i
            start = i


def _sorted_blocks(nodes: DataFrame, size: int) -> DataFrame:
    blocked = nodes.withColumn("block", F.floor(F.col("idx") / F.lit(size)).cast("long"))
    return blocked.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")


def _top(n: int, block: int, arity: int, block_levels: int) -> int:
    """Levels to climb in a block of ``n`` leaves: a tree's only block ends at one node."""
    return levels_above(n, arity) if block == 0 else block_levels


def _block_tops(nodes: DataFrame, arity: int, block_levels: int) -> DataFrame:
    """(tree, idx, digest, done) of each block's top; ``done`` where it is the tree's root."""
    import pyarrow as pa

    size = arity ** block_levels

    def run(batches: Iterator) -> Iterator:
        for table in _whole_blocks(batches, pa):
            trees, blocks = table.column("tree").to_pylist(), table.column("block").to_pylist()
            digests, out = table.column("digest").to_pylist(), []
            for a, b in _ranges(trees, blocks):
                top = _top(b - a, blocks[a], arity, block_levels)
                out.append((trees[a], blocks[a], climb(digests[a:b], top, arity)[-1][0], blocks[a] == 0 and b - a < size))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.bool_()))],
                names=["tree", "idx", "digest", "done"])

    rows = _sorted_blocks(nodes.select("tree", "idx", "digest"), size)
    return rows.mapInArrow(run, "tree long, idx long, digest string, done boolean")


def _climb_rounds(nodes: DataFrame, arity: int, block_levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Tables of nodes by round, and (tree, digest, round) of all trees' roots."""
    rounds, finished = [nodes], []
    while True:
        tops = materialize(_block_tops(rounds[-1], arity, block_levels))
        finished.append(tops.filter("done").select("tree", "digest", F.lit(len(rounds) - 1).alias("round")))
        rest = tops.filter("not done").select("tree", "idx", "digest")
        if rest.isEmpty():
            return rounds, reduce(DataFrame.unionByName, finished)
        rounds.append(rest)


def _descend_blocks(nodes: DataFrame, messages: DataFrame, arity: int, block_levels: int) -> DataFrame:
    """``nodes`` with ``proof`` and ``subroot``; ``messages`` (tree, block, suffix, subroot) hold
    one row a block, which the sort puts before the block's nodes."""
    import pyarrow as pa

    size = arity ** block_levels
    rest = [c for c in nodes.columns if c not in ("tree", "idx", "digest")]
    types = {f.name: f.dataType for f in nodes.schema.fields}
    sent = messages.select(
        "tree", (F.col("block") * size - 1).alias("idx"), F.lit(None).cast("string").alias("digest"),
        *[F.lit(None).cast(types[c]).alias(c) for c in rest], "block", "suffix", "subroot")
    own = nodes.select("tree", "idx", "digest", *rest, F.floor(F.col("idx") / F.lit(size)).cast("long").alias("block"),
                       F.lit(None).cast("string").alias("suffix"), F.lit(None).cast("string").alias("subroot"))
    both = own.unionByName(sent).repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")
    names = ["tree", "idx", "digest", *rest]

    def run(batches: Iterator) -> Iterator:
        for table in _whole_blocks(batches, pa):
            trees, blocks = table.column("tree").to_pylist(), table.column("block").to_pylist()
            digests, suffixes = table.column("digest").to_pylist(), table.column("suffix").to_pylist()
            subroots = table.column("subroot").to_pylist()
            keep, proofs, roots = [], [], []
            for a, b in _ranges(trees, blocks):
                nodes_of = climb(digests[a + 1:b], _top(b - a - 1, blocks[a], arity, block_levels), arity)
                proofs += descend(nodes_of, suffixes[a], arity)
                roots += [subroots[a]] * (b - a - 1)
                keep += range(a + 1, b)
            out = table.select(names).take(pa.array(keep, pa.int64()))
            out = out.append_column("proof", pa.array(proofs, pa.string())).append_column("subroot", pa.array(roots, pa.string()))
            yield from out.to_batches(max_chunksize=2000)

    schema = nodes.select(*names).schema.add("proof", "string").add("subroot", "string")
    return both.mapInArrow(run, schema)


def _descend_rounds(rounds: list[DataFrame], messages: DataFrame, arity: int, block_levels: int) -> DataFrame:
    """Proofs of the first round's nodes; ``messages`` (tree, round, suffix, subroot) go to each
    tree's only block in the round in which the tree ended."""
    out = None
    for r in range(len(rounds) - 1, -1, -1):
        sent = messages.filter(F.col("round") == r).select("tree", F.lit(0).cast("long").alias("block"), "suffix", "subroot")
        if out is not None:
            sent = sent.unionByName(out.select("tree", F.col("idx").alias("block"), F.col("proof").alias("suffix"), "subroot"))
        out = _descend_blocks(rounds[r], sent, arity, block_levels)
    return out


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (grp, ord, digest, ...) with ``tree``, the group's number in order, and ``idx``,
    the row's number in its group.  Range partitions are written once; of each, the driver
    reads one row."""
    import pyarrow as pa

    order = [F.col("grp").asc_nulls_first(), F.col("ord").asc_nulls_first(), F.col("digest"), F.col("tie")]
    ranged = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = materialize(ranged.drop("ord", "tie")).withColumn("pid", F.spark_partition_id())
    counts = ranged.groupBy("pid", "grp").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("grp").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        counts.withColumn("seen", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .groupBy("pid").agg(F.max("seen").alias("seen"), F.count(F.lit(1)).alias("groups"))
    )
    starts, trees = {}, 0
    for r in sorted(parts.collect()):
        trees -= r["seen"] > 0  # the first group goes on from an earlier partition
        starts[r["pid"]] = (trees, r["seen"])
        trees += r["groups"]
    rest = [c for c in ranged.columns if c not in ("grp", "pid")]

    def run(batches: Iterator) -> Iterator:
        last, tree, idx = None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if tree is None:
                tree, idx = starts[batch.column("pid")[0].as_py()]
                last = batch.column("grp")[0].as_py()
            tree_out, idx_out = [], []
            for group in batch.column("grp").to_pylist():
                if group != last:
                    tree, idx, last = tree + 1, 0, group
                tree_out.append(tree)
                idx_out.append(idx)
                idx += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree_out, pa.int64()), pa.array(idx_out, pa.int64()), *[batch.column(c) for c in rest]],
                names=["tree", "idx", *rest])

    schema = "tree long, idx long"
    out_schema = ranged.sparkSession.createDataFrame([], schema).schema
    for c in rest:
        out_schema = out_schema.add(ranged.schema[c])
    return ranged.mapInArrow(run, out_schema)


def merkle_manifest(rows: DataFrame, leaf: Column, group: Column, order: Column, keep: Mapping[str, Column],
                    arity: int = 3, block_levels: int = 8) -> DataFrame:
    """``keep`` columns and, for every row, ``leaf``, ``leaf_index`` (in its group, from 0),
    ``subroot``, ``root`` and ``proof``: for each level the siblings' digests with ``*`` at the
    node's own place, levels joined by ``/`` (empty where the leaf is the root).

    Leaves of a group ascend by ``order``; runs of ``arity`` become their digest until one node
    remains; the groups' roots, in order of the group, likewise give the root.  Nulls come first
    in both orders and null is a group.  Rows with equal order ascend by digest; rows repeated
    altogether are leaves of their own, and take their places in any order.  An empty table
    gives no rows.  Kept columns may have any names: they travel in a struct.
    """
    kept = F.struct(*[c.alias(n) for n, c in keep.items()])
    slim = rows.select(group.alias("grp"), order.alias("ord"), leaf.alias("digest"), kept.alias("kept"))
    leaves = _numbered(slim)
    rounds, subroots = _climb_rounds(leaves, arity, block_levels)
    upper, roots = _climb_rounds(
        subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), "digest"), arity, block_levels)
    top = roots.withColumn("suffix", F.lit("")).withColumn("subroot", F.col("digest"))
    of_groups = _descend_rounds(upper, top, arity, block_levels)
    messages = of_groups.select(F.col("idx").alias("tree"), F.col("proof").alias("suffix"), F.col("subroot").alias("root")).join(
        subroots.withColumnRenamed("digest", "subroot"), "tree")
    found = roots.first()
    out = _descend_rounds(rounds, materialize(messages.select("tree", "round", "suffix", "subroot")), arity, block_levels)
    return out.select(
        *[F.col("kept").getField(n).alias(n) for n in keep], F.col("digest").alias("leaf"), F.col("idx").alias("leaf_index"),
        "subroot", F.lit(found["digest"] if found else None).cast("string").alias("root"), "proof")


def op13_merkle_manifest(spark, sf_dir) -> DataFrame:
    """Manifest of all documents by source; texts lose their line breaks where 2 divides the
    id's crc32, and the proofs must find out."""
    docs = documents(spark, sf_dir)
    fields = [column(docs, c) for c in QUERY_FIELDS]
    tampered = F.when(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 2 == 0, leaf_digest(
        [*fields[:-1], F.replace(fields[-1], F.lit("\n"), F.lit(""))]))
    leaf = leaf_digest(fields)
    out = merkle_manifest(docs, leaf, docs["source"], docs["doc_id"],
                          {"doc_id": docs["doc_id"], "claim": F.coalesce(tampered, leaf)})
    return out.withColumn("folded_root", fold_proof(F.col("claim"), F.col("proof"))).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.translate("proof", SELF + STEP, ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _leaf_sql(text: str) -> str:
    parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in (*QUERY_FIELDS[:-1], text)]
    return f"sha256({' || '.join(parts)})"


#: trees level by level as lists, each step of a proof as its siblings with ``*`` between
ORACLE = f"""
WITH RECURSIVE crc(n, k, v) AS (SELECT n, 0, n::UBIGINT FROM range(256) t(n)
  UNION ALL SELECT n, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM crc WHERE k < 8),
tab AS (SELECT list(v ORDER BY n) AS t FROM crc WHERE k = 8),
odd AS (SELECT doc_id, xor(list_reduce(list_transform(range(0, length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::UBIGINT),
  lambda s, x: xor(s >> 8, t[(xor(s, x) & 255)::BIGINT + 1]), 4294967295::UBIGINT), 4294967295::UBIGINT) & 1 AS odd
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), tab),
d AS (SELECT doc_id, source, {_leaf_sql('text')} AS leaf, {_leaf_sql("replace(text, chr(10), '')")} AS changed FROM documents),
e AS (SELECT d.*, CASE WHEN odd = 0 THEN changed ELSE leaf END AS claim, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d LEFT JOIN odd USING (doc_id)),
t(tree, lv, ls) AS (SELECT tree, 0, list(leaf ORDER BY i) FROM e GROUP BY tree
  UNION ALL SELECT tree, lv + 1, list_transform(range(0, (len(ls) + 2) // 3), lambda i: sha256(array_to_string(ls[3 * i + 1:3 * i + 3], ''))) FROM t WHERE len(ls) > 1),
u(lv, ls) AS (SELECT 0, list(ls[1] ORDER BY tree) FROM t WHERE len(ls) = 1
  UNION ALL SELECT lv + 1, list_transform(range(0, (len(ls) + 2) // 3), lambda i: sha256(array_to_string(ls[3 * i + 1:3 * i + 3], ''))) FROM u WHERE len(ls) > 1),
s AS (SELECT e.tree, i, lv, ls, i // (3 ** lv)::BIGINT AS pos FROM e JOIN t ON e.tree = t.tree AND len(ls) > 1
  UNION ALL SELECT e.tree, i, 1000 + lv, ls, (e.tree - 1) // (3 ** lv)::BIGINT FROM e, u WHERE len(ls) > 1),
p AS (SELECT tree, i, list(array_to_string(ls[pos // 3 * 3 + 1:pos], '') || '*' || array_to_string(ls[pos + 2:pos // 3 * 3 + 3], '') ORDER BY lv) AS steps
  FROM s GROUP BY tree, i),
f AS (SELECT doc_id, leaf, b.ls[1] AS subroot, (SELECT ls[1] FROM u WHERE len(ls) = 1) AS root,
  sha256(replace(coalesce(array_to_string(steps, ''), ''), '*', '')) AS proof_sha256,
  list_reduce(coalesce(steps, []), lambda h, x: sha256(replace(x, '*', h)), claim) AS folded_root
  FROM e LEFT JOIN p ON e.tree = p.tree AND e.i = p.i JOIN t b ON b.tree = e.tree AND len(b.ls) = 1)
SELECT *, folded_root = root AS verified FROM f"""
