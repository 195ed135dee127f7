"""Reshaping (R1-R5): long <-> wide, split cells to rows/columns, tag matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landframe.functions._util import qcol
from landframe.operators.setops import stack_fill
from landframe.operators.window import first_per_key


def melt_except(df: DataFrame, ids: Sequence[str], key: str = "key", value: str = "value",
                value_type: str | None = None) -> DataFrame:
    """Wide -> long over every column not in ``ids``; null values are kept."""
    ids = list(ids)
    vals = [c for c in df.columns if c not in ids]
    src = df
    if value_type:
        src = df.select(*ids, *[F.col(f"`{c}`").cast(value_type).alias(c) for c in vals])
    return src.unpivot([qcol(c) for c in ids], [qcol(c) for c in vals], key, value)


def pivot_vocabulary(df: DataFrame, key: str, max_values: int | None = None) -> list:
    """Distinct non-null keys, byte-sorted: the future column names of ``widen``.

    Output columns depend on the data, so this is one small job whose result is bounded
    by ``spark.sql.pivotMaxValues``; more keys than that is an error, not a silent cut.
    """
    spark = df.sparkSession
    cap = max_values or int(spark.conf.get("spark.sql.pivotMaxValues", "10000"))
    rows = (df.select(qcol(key).cast("string").alias("k")).filter(F.col("k").isNotNull())
            .distinct().orderBy("k").limit(cap + 1).collect())
    if len(rows) > cap:
        raise ValueError(f"more than {cap} distinct values in {key}; pass vocab explicitly")
    return [r[0] for r in rows]


#: columns that one aggregation makes; a longer vocabulary is dealt into blocks
PIVOT_BLOCK = 2000


def widen(df: DataFrame, ids: Sequence[str], key: str, value: str,
          vocab: Sequence | None = None, agg: str = "max", block: int = PIVOT_BLOCK) -> DataFrame:
    """R2: long -> wide; one column per key value (byte-sorted), null where absent.

    Rows with a null key are dropped (a pivot would name a column ``null``; re-append
    them with U3 as the tag-matrix job does).  ``(ids, key)`` should be unique
    (tidyr refuses duplicates); ``agg`` (``max`` by default, deterministic) decides
    otherwise.  Passing ``vocab`` avoids the extra distinct job.  A vocabulary of more than
    ``block`` keys is dealt into blocks (``_widen_blocks``), so that
    ``spark.sql.pivotMaxValues`` limits only how many keys are looked up unasked.
    """
    src = df.filter(qcol(key).isNotNull())
    if vocab is None:
        vocab = pivot_vocabulary(src, key)
    fn = {"max": F.max, "min": F.min, "first": F.first, "sum": F.sum, "count": F.count}[agg]
    if len(vocab) > block:
        return _widen_blocks(src, list(ids), key, value, list(vocab), fn, block)
    return src.groupBy(*[qcol(c) for c in ids]).pivot(f"`{key}`", list(vocab)).agg(fn(qcol(value)))


def _widen_blocks(src: DataFrame, ids: list[str], key: str, value: str, vocab: list, fn, block: int) -> DataFrame:
    """R2 for long vocabularies: keys become ordinals, one aggregation pivots the places inside
    a block into an array, a second one the blocks; the columns are read off the arrays.  So no
    aggregate has more than ``block`` buffers, however many columns there are."""
    spark = src.sparkSession
    n_blocks = -(-len(vocab) // block)
    ordinals = spark.createDataFrame([(str(k), i) for i, k in enumerate(vocab)], "__key string, __i int")
    own = [qcol(c).alias(f"__id{i}") for i, c in enumerate(ids)]
    keyed = src.select(*own, qcol(key).cast("string").alias("__key"), qcol(value).alias("__v")).join(F.broadcast(ordinals), "__key", "left")
    names = [f"__id{i}" for i in range(len(ids))]
    keyed = keyed.withColumns({"__b": F.floor(F.col("__i") / block).cast("int"), "__p": F.col("__i") % block})
    places = keyed.groupBy(*names, "__b").pivot("__p", list(range(block))).agg(fn("__v"))
    arrays = places.select(*names, "__b", F.expr("array(" + ", ".join(f"`{p}`" for p in range(block)) + ")").alias("__a"))
    blocks = arrays.groupBy(*names).pivot("__b", list(range(n_blocks))).agg(F.first("__a"))
    quoted = ["`" + str(k).replace("`", "``") + "`" for k in vocab]
    return blocks.selectExpr(*[f"__id{i} AS `{c}`" for i, c in enumerate(ids)],
                             *[f"get(`{i // block}`, {i % block}) AS {q}" for i, q in enumerate(quoted)])


def split_rows(df: DataFrame, col: str, sep: str = " ", keep_null: bool = True) -> DataFrame:
    """One row per piece of a delimited cell (``sep`` is a regex); null cells kept."""
    ex = F.explode_outer if keep_null else F.explode
    others = [F.col(f"`{c}`") for c in df.columns if c != col]
    pos = df.columns.index(col)
    out = df.select(*others, ex(F.split(qcol(col), sep)).alias(col))
    order = df.columns[:pos] + [col] + df.columns[pos + 1:]
    return out.select(*[F.col(f"`{c}`") for c in order])


def split_columns(df: DataFrame, col: str, sep: str, names: Sequence[str]) -> DataFrame:
    """Split a cell into fixed columns; missing pieces are null, extra pieces dropped."""
    parts = F.split(qcol(col), sep)
    return df.select("*", *[F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names)])


def tag_matrix(df: DataFrame, name_col: str, tag_col: str, order_by: Sequence[str],
               sep: str = " ", mark: int = 1, vocab: Sequence[str] | None = None, max_tags: int | None = None) -> DataFrame:
    """Turn a space-separated tag cell into one indicator column per tag.

    Steps: split the tags to rows, drop empty pieces, keep the first row per
    (name, tag) by ``order_by``, widen with ``mark`` where present (every tag that
    occurs becomes a column, one-character tags included), then stack back the rows
    whose tag cell was null, with every tag column null.  Without ``vocab`` the tags are
    read from the cells, which fails above ``max_tags`` of them (by default
    ``spark.sql.pivotMaxValues``).
    """
    ids = [c for c in df.columns if c != tag_col]
    blanks = df.filter(qcol(tag_col).isNull()).drop(tag_col)
    long = split_rows(df.filter(qcol(tag_col).isNotNull()), tag_col, sep, keep_null=False)
    long = long.filter(qcol(tag_col) != "")
    vocab = pivot_vocabulary(long, tag_col, max_tags) if vocab is None else vocab
    long = first_per_key(long, [name_col, tag_col], order_by)
    long = long.withColumn("__has", F.lit(mark))
    wide = widen(long, ids, tag_col, "__has", vocab)
    return stack_fill([wide, blanks])
