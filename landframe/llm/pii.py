"""PII surrogates: detected entities get keyed replacements, consistent over the corpus.

An entity's surrogate depends on a secret key and the entity's normal form alone, so all its
mentions get the same one (coreference).  Surrogates are checked against all entities of the
corpus and against each other; the losers of a collision draw again until every surrogate is
new and different (distinctness).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from landframe.llm import surrogates
from landframe.llm.common import documents, hold, release, text_slices
from landframe.session import materialize

#: of the registered query; a real run passes its own secret
QUERY_KEY = b"landframe demonstration key"

_ENTITY = StructType([StructField("kind", StringType()), StructField("norm", StringType())])


def detect(held: DataFrame, hits: bool) -> DataFrame:
    """The rows (``rest, text``) that hold personal data, with their distinct ``entities``, or
    (``hits`` false) the rows that hold none, unchanged."""
    import pyarrow as pa

    schema = StructType([*held.schema.fields, *([StructField("entities", ArrayType(_ENTITY))] if hits else [])])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("norm", pa.string())]))

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for part in text_slices(batch):
                found = [sorted({(k, n) for _, _, k, n in surrogates.find_entities(t)}) for t in part.column("text").to_pylist()]
                rows = pa.array([i for i, f in enumerate(found) if bool(f) == hits], pa.int64())
                columns = [c.take(rows) for c in part.columns]
                if hits:
                    columns.append(pa.array([[{"kind": k, "norm": n} for k, n in f] for f in found if f], kind))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return held.mapInArrow(run, schema)


def assign_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind, norm, new`` for distinct ``kind, norm``: no ``new`` is an entity of that kind, no
    two are equal.  (Given names are mapped one to one within a fixed list instead.)"""
    import pyarrow as pa

    def draw(attempt: int):
        def run(batches: Iterator) -> Iterator:
            for b in batches:
                new = [surrogates.surrogate(k, n, key, attempt) for k, n in zip(b.column("kind").to_pylist(), b.column("norm").to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column("kind"), b.column("norm"), pa.array(new, pa.string())], names=["kind", "norm", "new"])
        return run

    taken = entities.filter("kind <> 'given'").select("kind", F.col("norm").alias("new"))
    done, pending, attempt = None, entities, 0
    while True:
        drawn = materialize(pending.mapInArrow(draw(attempt), "kind string, norm string, new string"))
        free = drawn.join(taken, ["kind", "new"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "new"), ["kind", "new"], "left_anti")
        won = materialize(free.groupBy("kind", "new").agg(F.min("norm").alias("norm")).select("kind", "norm", "new"))
        done = won if done is None else materialize(done.unionByName(won))
        pending = materialize(drawn.join(won, ["kind", "norm"], "left_anti").select("kind", "norm"))
        if pending.isEmpty():
            return done
        attempt += 1


def replace_pii(docs: DataFrame, key: bytes, text_col: str = "text", count: bool = False) -> DataFrame:
    """``docs`` with every detected entity replaced; all columns (whatever their names) and rows
    are kept, rows without personal data (null and empty texts too) unchanged.  Repeated rows
    get the same surrogates; an empty table stays empty.  ``count`` adds ``n_entities``, the
    distinct ones.

    Only rows with personal data are written and shuffled, each once; their entities meet the
    surrogates in a join that Spark can split at an entity found in very many rows.
    """
    import pyarrow as pa

    held = hold(docs, text_col)
    hit = materialize(detect(held, True).withColumn("row", F.monotonically_increasing_id()))
    mentions = hit.select("row", F.explode("entities").alias("e")).select("row", "e.kind", "e.norm")
    chosen = assign_surrogates(materialize(mentions.select("kind", "norm").distinct()), key)
    # joined on a hash beside the keys: both sides are exchanged anew, so hot entities split
    table = chosen.select(F.xxhash64("kind", "norm").alias("k"), F.col("kind").alias("k1"), F.col("norm").alias("k2"), "new")
    same = (F.xxhash64("kind", "norm") == F.col("k")) & (F.col("kind") == F.col("k1")) & (F.col("norm") == F.col("k2"))
    per_row = mentions.join(table, same).groupBy("row").agg(F.collect_list(F.struct("kind", "norm", "new")).alias("new"))
    joined = hit.join(per_row, "row").select("rest", "text", "new")

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for part in text_slices(batch):
                texts = [surrogates.replace_entities(t, {(e["kind"], e["norm"]): e["new"] for e in new})
                         for t, new in zip(part.column("text").to_pylist(), part.column("new").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("rest"), pa.array(texts, part.schema.field("text").type), part.column("new")], names=["rest", "text", "new"])

    replaced = joined.mapInArrow(run, joined.schema).withColumn("n_entities", F.size("new").cast("long"))
    clean = detect(held, False).withColumn("n_entities", F.lit(0).cast("long"))
    more = ["n_entities"] if count else []
    return release(replaced, docs, text_col, *more).unionAll(release(clean, docs, text_col, *more))


def op2_pii_surrogates(spark, sf_dir) -> DataFrame:
    """All documents with surrogates in place of personal data."""
    return replace_pii(documents(spark, sf_dir).select("doc_id", "text"), QUERY_KEY, count=True)
