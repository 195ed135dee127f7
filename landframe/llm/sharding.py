"""Weighted rendezvous sharding of stable record keys (native DataFrame functions only).

Every (key, shard) pair gets a pseudo-random number ``u`` in (0, 1) from an MD5 digest;
the record goes to the shard with the smallest ``-ln(u) / weight``.  The winner among the
old shards does not depend on shards added later, so one more shard takes records only
into itself, and a shard's expected share is its part of the total weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landframe.llm.common import column, documents, utf8_bytes
from landframe.session import materialize

QUERY_SHARDS = 40


def record_key(cols: Sequence[Column]) -> Column:
    """One string for a stable key of several columns; nulls equal nulls, and no two
    different tuples give the same string (each part is preceded by its length)."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.concat(*[part(c) for c in cols])


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """Shard (int, from 0) of a key string under the given shard weights.

    One MD5 digest serves four shards: eight hex digits each.  A weight of 0 takes
    nothing; equal scores go to the lower shard.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must be non-negative with at least one above 0")
    blocks = F.sequence(F.lit(0), F.lit((len(weights) - 1) // 4))
    digests = F.transform(blocks, lambda b: F.md5(F.concat(key, F.lit("#"), b.cast("string"))))
    digits = F.flatten(F.transform(digests, lambda h: F.array(*[F.substring(h, 8 * j + 1, 8) for j in range(4)])))

    def score(eight: Column, w: Column) -> Column:
        u = (F.conv(eight, 16, 10).cast("double") + 0.5) / F.lit(2.0 ** 32)
        return F.when(w > 0, -F.log(u) / w)

    scores = F.zip_with(digits, F.array(*[F.lit(float(w)) for w in weights]), score)
    ranked = F.transform(scores, lambda s, i: F.when(s.isNotNull(), F.struct(s.alias("score"), i.alias("shard"))))
    return F.array_min(ranked)["shard"].cast("int")


def shard_records(records: DataFrame, key_cols: Sequence[str], weights: Sequence[float],
                  keep: dict[str, Column], grown_weights: Sequence[float] | None = None) -> DataFrame:
    """Assign records to shards: the ``keep`` columns, ``shard``, ``grown_shard`` (under
    ``grown_weights``, else null) and ``slot``, a number from 0 without gaps per shard.

    Records with equal keys share a shard, repeated rows included (each row has its own
    slot); null keys form one key.  An empty table gives no rows.  Slots follow the scan
    order: rows are numbered inside (shard, scan partition), which no hot key can make
    larger than a scan partition, and shifted by the counts of earlier partitions.
    """
    key = record_key([column(records, c) for c in key_cols])
    grown = rendezvous_shard(F.col("__key"), grown_weights) if grown_weights else F.lit(None).cast("int")
    rows = (
        records.select(*[c.alias(n) for n, c in keep.items()], key.alias("__key"))
        .withColumn("shard", rendezvous_shard(F.col("__key"), weights))
        .withColumn("grown_shard", grown)
        .withColumn("__row", F.monotonically_increasing_id())
        .drop("__key")
    )
    # written once: the row ids are fixed from here on, and the texts are read only once
    rows = materialize(rows).withColumn("__part", F.shiftright("__row", 33))
    counts = rows.groupBy("shard", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("shard", "__part").orderBy("__row")
    numbered = rows.withColumn("__in", F.row_number().over(inside) - 1)
    return (
        numbered.join(offsets, ["shard", "__part"])
        .withColumn("slot", (F.col("__before") + F.col("__in")).cast("long"))
        .select(*keep, "shard", "slot", "grown_shard")
    )


def op8_sharding(spark, sf_dir) -> DataFrame:
    """All documents over 40 equal shards by ``doc_id`` (law ``key``)."""
    docs = documents(spark, sf_dir)
    text = docs["text"]
    keep = {
        "doc_id": docs["doc_id"],
        "size": utf8_bytes(text) + 16,
        "text_crc32": F.crc32(F.coalesce(text, F.lit("")).cast("binary")),
    }
    out = shard_records(docs, ["doc_id"], [1.0] * QUERY_SHARDS, keep, [1.0] * (QUERY_SHARDS + 1))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


#: CRC-32 by its table, byte for byte; slots follow the file's row order
ORACLE = r"""
WITH RECURSIVE crc(n, k, v) AS (SELECT n, 0, n::UBIGINT FROM range(256) t(n)
  UNION ALL SELECT n, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM crc WHERE k < 8),
tab AS (SELECT list(v ORDER BY n) AS t FROM crc WHERE k = 8),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(length(doc_id::VARCHAR) || ':' || doc_id, '-') AS key FROM documents),
b AS (SELECT r, doc_id, key, hex(encode(text)) AS h FROM d),
c AS (SELECT r, doc_id, key, length(h) // 2 AS n, xor(list_reduce(list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::UBIGINT),
        lambda s, x: xor(s >> 8, t[(xor(s, x) & 255)::BIGINT + 1]), 4294967295::UBIGINT), 4294967295::UBIGINT) AS crc FROM b, tab),
s AS (SELECT *, list_transform(range(0, 41), lambda s: {'score': -ln((('0x' || substr(md5(key || '#' || (s // 4)), 8 * (s % 4) + 1, 8))::UBIGINT + 0.5) / 4294967296.0), 'shard': s}) AS scores FROM c),
p AS (SELECT r, doc_id, n, crc, list_min(scores[1:40]).shard AS shard, list_min(scores).shard AS grown FROM s)
SELECT doc_id, (n + 16)::BIGINT AS size, crc::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY r) - 1 AS slot, grown::INTEGER AS grown_shard FROM p"""
