"""Operators that keep group or order context on every row.

None of them uses a window without ``partitionBy`` over the data, and none relies on a
per-key window where a single key could hold a third of the rows:

* group counts/sums are computed by a partial (map-side combined) aggregate and joined
  back on the key and its hash, so that both sides of the join are exchanged for it and
  AQE can split a hot key of the rows (a join that reuses the aggregate's own
  partitioning is never split);
* first-per-key takes ``min(struct(order..., row))`` per key, again a partial aggregate;
* global row numbers come from a range-partitioned, reliably checkpointed copy, a
  per-partition count (one number per partition) and a broadcast of those offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landframe.session import materialize


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``__gk = struct(keys)``: one grouping/join key in which null fields compare
    equal, so null keys form one group (as R does) without rewriting the join keys."""
    return df.withColumn("__gk", F.struct(*[F.col(f"`{k}`") for k in keys]))


def _join_back(keyed: DataFrame, per_key: DataFrame) -> DataFrame:
    """Join per-key results back onto the rows.

    The key's hash is a second join key: the aggregate's partitioning does not satisfy the
    join, so its few rows are exchanged once more, and with a plain exchange on both sides
    AQE can split the rows of a hot key over many tasks."""
    rows = keyed.withColumn("__gh", F.xxhash64("__gk"))
    return rows.join(per_key.withColumn("__gh", F.xxhash64("__gk")), ["__gk", "__gh"]).drop("__gk", "__gh")


def add_count(df: DataFrame, keys: Sequence[str], out: str = "n", method: str = "join") -> DataFrame:
    """Number of rows sharing ``keys`` on every row (null keys form one group).

    ``method="join"`` (default) aggregates then joins back: skew-safe.
    ``method="window"`` is ``count(*) over (partition by keys)``: one shuffle, but a
    hot key is processed by one task.
    """
    keys = list(keys)
    if method == "window":
        return df.withColumn(out, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    keyed = _keyed(df, keys)
    counts = keyed.groupBy("__gk").agg(F.count(F.lit(1)).alias(out))
    return _join_back(keyed, counts)


def add_sum(df: DataFrame, keys: Sequence[str], col: str, out: str) -> DataFrame:
    """Group sum of ``col`` on every row (aggregate + join-back)."""
    keyed = _keyed(df, list(keys))
    sums = keyed.groupBy("__gk").agg(F.sum(F.col(f"`{col}`")).alias(out))
    return _join_back(keyed, sums)


def _order_struct(order_by: Sequence) -> Column:
    return F.struct(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(f"_o{i}") for i, c in enumerate(order_by)])


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                  descending: bool = False) -> DataFrame:
    """The first row of every key by ``order_by``, all columns kept.

    Order is ascending with nulls first (``descending=True``: the last row).  Rows with
    equal ``order_by`` values inside a key are told apart by their remaining columns,
    so the result is deterministic.  Implemented as ``min``/``max`` of a struct: a
    partial aggregate, no per-key window.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order_by) + [c for c in rest if c not in order_by]
    st = F.struct(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(order)])
    pick = (F.max if descending else F.min)(st).alias("__first")
    g = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(pick)
    cols = {c: F.col(f"__first._{order.index(c)}") for c in rest}
    return g.select(*[F.col(f"`{c}`") if c in keys else cols[c].alias(c) for c in df.columns])


def find_repeats(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Every row after the first of its key (the job's duplicate report).

    Rows that tie on ``order_by`` are told apart by their other columns; of wholly equal
    first rows one is the first and the others are repeats.  Equal rows are counted before
    the join, the first row per key is a partial aggregate, joined back.
    """
    rest = [c for c in df.columns if c not in order_by]
    order = _order_struct([*order_by, *rest])
    counted = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    keyed = _keyed(counted, list(keys))
    firsts = keyed.groupBy("__gk").agg(F.min(order).alias("__first"))
    joined = _join_back(keyed, firsts)
    more = F.col("__n") - F.when(order == F.col("__first"), F.lit(1)).otherwise(F.lit(0))
    # equal rows come back one by one
    out = joined.withColumn("__copy", F.explode(F.sequence(F.lit(0), more))).filter("__copy > 0")
    return out.select(*[F.col(f"`{c}`") for c in df.columns])


def add_row_id(df: DataFrame, order_by: Sequence[str], out: str = "row_id", prefix: str | None = None,
               num_partitions: int | None = None) -> DataFrame:
    """Global 1-based sequence number in ``order_by`` order (optionally ``prefix`` + n).

    ``order_by`` must be unique (end it with a key); then range partitioning can split
    any hot value across partitions.  Steps: range-partition and sort within
    partitions; number rows inside each partition; checkpoint (range bounds are sampled,
    a recomputation could move rows); count rows per partition (one row each); running
    offsets over those counts; broadcast the offsets (size = number of partitions).
    """
    # without an explicit count there are spark.sql.shuffle.partitions ranges, of which AQE
    # only merges small neighbours (partition ids stay in order); give num_partitions, or
    # raise that setting, so that a range of the data fits a task
    ranged = df.repartitionByRange(num_partitions, *order_by) if num_partitions else df.repartitionByRange(*order_by)
    ranged = (ranged.sortWithinPartitions(*order_by)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__local", F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    ranged = materialize(ranged)
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    rid = (F.col("__off") + F.col("__local") + 1).cast("long")
    if prefix is not None:
        rid = F.concat(F.lit(prefix), rid.cast("string"))
    res = ranged.join(F.broadcast(offsets), "__pid").withColumn(out, rid)
    return res.drop("__pid", "__local", "__off")


def add_batch(df: DataFrame, size: int, order_by: Sequence[str], out: str = "group",
              row_id: str | None = None) -> DataFrame:
    """Fixed-size batch number ``ceil(row / size)`` (every batch full but the last)."""
    rid = row_id or "__rid"
    numbered = add_row_id(df, order_by, out=rid)
    numbered = numbered.withColumn(out, F.ceil(F.col(rid) / F.lit(size)).cast("long"))
    return numbered if row_id else numbered.drop(rid)
