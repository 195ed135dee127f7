"""Joins and record matching.

Conventions
-----------
* ``null_keys="match"`` (default) reproduces R's ``merge`` / ``%in%``: a missing key
  matches a missing key.  It is planned as an ordinary equi-join (Spark rewrites
  ``<=>`` keys to ``coalesce`` + ``isnull`` pairs; where a per-key aggregate feeds the
  join, both sides use one struct key whose null fields compare equal, plus its hash,
  because a join that reuses an aggregate's partitioning is never split), so sort-merge /
  hash strategies and AQE skew splitting apply.  ``null_keys="drop"`` gives SQL semantics.
* No operator forces a broadcast: the small side of a lookup usually *is* small, and
  AQE turns the shuffle join into a broadcast at run time from measured sizes.  A hot
  key on the large side is split by AQE's skew-join handling.
* First-wins lookups (J11) pick the first match with a partial aggregate
  (``min(struct(order..., payload))``), which combines map-side, so a key holding a
  third of all rows never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_L, _R = "__l", "__r"


def _pairs(left_on, right_on=None) -> list[tuple[str, str]]:
    left_on = [left_on] if isinstance(left_on, str) else list(left_on)
    right_on = left_on if right_on is None else ([right_on] if isinstance(right_on, str) else list(right_on))
    if len(left_on) != len(right_on):
        raise ValueError("left and right key lists differ in length")
    return list(zip(left_on, right_on))


def _cond(pairs, null_keys: str) -> Column:
    cond = None
    for lk, rk in pairs:
        a, b = F.col(f"{_L}.`{lk}`"), F.col(f"{_R}.`{rk}`")
        t = a.eqNullSafe(b) if null_keys == "match" else (a == b)
        cond = t if cond is None else cond & t
    return cond


def merge_on(a: DataFrame, b: DataFrame, left_on, right_on=None, how: str = "inner",
             suffixes: tuple[str, str] = (".x", ".y"), null_keys: str = "match") -> DataFrame:
    """Join on (possibly differently named) keys, R ``merge`` column layout.

    Output columns: the keys under their left names, then the other left columns, then
    the other right columns; a name present on both sides gets ``suffixes``.  Row order
    is not promised.
    """
    pairs = _pairs(left_on, right_on)
    lkeys = [lk for lk, _ in pairs]
    rkeys = {rk for _, rk in pairs}
    lrest = [c for c in a.columns if c not in lkeys]
    rrest = [c for c in b.columns if c not in rkeys]
    clash = set(lrest) & set(rrest)
    joined = a.alias(_L).join(b.alias(_R), _cond(pairs, null_keys), how)
    out = []
    for lk, rk in pairs:
        lcol = F.col(f"{_L}.`{lk}`")
        key = lcol if how in ("inner", "left", "left_outer") else F.coalesce(lcol, F.col(f"{_R}.`{rk}`"))
        out.append(key.alias(lk))
    out += [F.col(f"{_L}.`{c}`").alias(c + suffixes[0] if c in clash else c) for c in lrest]
    out += [F.col(f"{_R}.`{c}`").alias(c + suffixes[1] if c in clash else c) for c in rrest]
    return joined.select(*out)


def merge_natural(a: DataFrame, b: DataFrame, null_keys: str = "match") -> DataFrame:
    """Inner merge on every shared column name."""
    shared = [c for c in a.columns if c in b.columns]
    if not shared:
        raise ValueError("no shared columns to merge on")
    return merge_on(a, b, shared, shared, "inner", null_keys=null_keys)


def left_lookup(a: DataFrame, b: DataFrame, left_on, right_on=None,
                null_keys: str = "match") -> DataFrame:
    """Keep every left row, right attributes where a key matches."""
    return merge_on(a, b, left_on, right_on, "left", null_keys=null_keys)


def match_only(a: DataFrame, b: DataFrame, left_on, right_on, require: str,
               null_keys: str = "match") -> DataFrame:
    """Left join, then drop rows whose right-side ``require`` column is null.

    Written the way the job wrote it; Catalyst's outer-join elimination plans it as an
    inner join because the filter rejects null-extended rows.
    """
    return left_lookup(a, b, left_on, right_on, null_keys).filter(F.col(require).isNotNull())


def keep_in(a: DataFrame, b: DataFrame, left_on, right_on=None, null_keys: str = "match") -> DataFrame:
    """Rows of ``a`` whose key occurs in ``b`` (semi join; ``a``'s columns only)."""
    pairs = _pairs(left_on, right_on)
    return a.alias(_L).join(b.alias(_R), _cond(pairs, null_keys), "left_semi")


def keep_not_in(a: DataFrame, b: DataFrame, left_on, right_on=None, null_keys: str = "match") -> DataFrame:
    """Rows of ``a`` whose key does *not* occur in ``b`` (anti join).

    With ``null_keys="match"`` a null key is "in" ``b`` when ``b`` has a null key, as
    with R's ``!(x %in% y)``; ``keep_in`` and ``keep_not_in`` always partition ``a``.
    """
    pairs = _pairs(left_on, right_on)
    return a.alias(_L).join(b.alias(_R), _cond(pairs, null_keys), "left_anti")


KeyPair = tuple[Sequence, Sequence]


def _key_exprs(keys) -> list[Column]:
    keys = [keys] if isinstance(keys, (str, Column)) else list(keys)
    return [F.col(f"`{k}`") if isinstance(k, str) else k for k in keys]


def _struct_key(exprs: Sequence[Column]) -> Column:
    return F.struct(*[e.alias(f"_{j}") for j, e in enumerate(exprs)])


def _key_type(df: DataFrame, col: str):
    """The struct key type of ``df[col]`` with every field nullable: the cast target for
    the other side's key (field types aligned, nullability never narrowed)."""
    from pyspark.sql import types as T
    st = df.schema[col].dataType
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in st.fields])


def flag_any_match(a: DataFrame, b: DataFrame, key_pairs: Sequence[KeyPair], out: str,
                   null_keys: str = "match", ignore_blank: bool = False) -> DataFrame:
    """``out`` = 1 when *any* of the K keys of a row occurs in ``b``, else 0.

    Each key pair is ``(left key exprs, right key exprs)``: a name, a Column or a list of
    them (composite key).  Each key is checked by its own equi left-join against the
    *distinct* right keys, so the plan has K hash/sort-merge joins and never the
    nested-loop join an OR-ed join condition would need.  Keys are compared as one
    struct per side (null fields equal, as R's ``%in%``) together with its hash, so that
    both sides are exchanged for the join and AQE can split a hot key of ``a``.  ``null_keys="drop"`` lets no key with a null
    part match; ``ignore_blank`` stops empty text keys from matching each other (the job
    let them match).
    """
    cur = a
    markers = []
    for i, (lk, rk) in enumerate(key_pairs):
        lx, rx = _key_exprs(lk), _key_exprs(rk)
        lname, marker = f"__k{i}", f"__hit{i}"
        cur = cur.withColumn(lname, _struct_key(lx))
        right = b
        if null_keys != "match":
            right = right.filter(F.greatest(*[F.lit(False)] + [e.isNull() for e in rx]) == F.lit(False))
        if ignore_blank:
            for e in rx:
                right = right.filter(e.isNull() | (e.cast("string") != ""))
        right = right.select(_struct_key(rx).cast(_key_type(cur, lname)).alias(lname)).distinct()
        hashed = f"__h{i}"
        right = right.withColumns({hashed: F.xxhash64(lname), marker: F.lit(1)})
        cur = cur.withColumn(hashed, F.xxhash64(lname)).join(right, [lname, hashed], "left").drop(lname, hashed)
        markers.append(marker)
    hit = F.coalesce(*[F.col(m) for m in markers])
    return cur.withColumn(out, F.when(hit.isNotNull(), F.lit(1)).otherwise(F.lit(0))).drop(*markers)


def first_match_table(b: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                      count_col: str | None = "match_count") -> DataFrame:
    """One row per key of ``b``: the first row by ``order_by`` (+ how many rows share the key).

    ``min(struct(order..., payload))`` is an ordinary aggregate with a map-side partial
    step, so a hot key is reduced in every map task before the shuffle.
    """
    payload = [c for c in b.columns if c not in keys]
    ordered = [F.col(f"`{c}`") for c in order_by] + [F.col(f"`{c}`") for c in payload if c not in order_by]
    names = list(order_by) + [c for c in payload if c not in order_by]
    st = F.struct(*[x.alias(f"_{i}") for i, x in enumerate(ordered)])
    aggs = [F.min(st).alias("__first")]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    g = b.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*aggs)
    cols = [F.col(f"`{k}`") for k in keys] + [F.col(f"__first._{i}").alias(n) for i, n in enumerate(names)]
    if count_col:
        cols.append(F.col(count_col))
    return g.select(*cols)


def lookup_first(a: DataFrame, b: DataFrame, left_on, right_on, order_by: Sequence[str],
                 count_col: str = "match_count", null_keys: str = "match") -> DataFrame:
    """One output per input row that has a match; attributes of the first match by
    ``order_by`` and the number of matching records; unmatched inputs dropped.

    Clashing attribute names keep the input's value (the right value is not copied).
    The per-key table is joined on its struct key and the key's hash, so that both sides
    are exchanged for the join and AQE can split a hot key of ``a``.
    """
    pairs = _pairs(left_on, right_on)
    lkeys, rkeys = [lk for lk, _ in pairs], [rk for _, rk in pairs]
    left = a.withColumn("__fk", _struct_key([F.col(f"`{k}`") for k in lkeys]))
    right = b
    if null_keys != "match":
        left = left.dropna(subset=lkeys)
        right = right.dropna(subset=rkeys)
    right = right.withColumn("__fk", _struct_key([F.col(f"`{k}`") for k in rkeys])
                             .cast(_key_type(left, "__fk"))).drop(*rkeys)
    first = first_match_table(right, ["__fk"], order_by, count_col)
    keep = [c for c in first.columns if c != "__fk" and c not in a.columns]
    hashed = F.xxhash64("__fk").alias("__fh")
    joined = left.select("*", hashed).join(first.select("__fk", hashed, *keep), ["__fk", "__fh"], "inner")
    return joined.select(*[F.col(f"`{c}`") for c in a.columns], *[F.col(f"`{c}`") for c in keep])


def merge_duplicating(a: DataFrame, b: DataFrame, left_on, right_on=None,
                      null_keys: str = "match") -> DataFrame:
    """One-to-many attribute merge: each left row repeated per match, unmatched dropped."""
    return merge_on(a, b, left_on, right_on, "inner", suffixes=("", "_1"), null_keys=null_keys)
