"""File and table sources and sinks.

Reads are plain Spark readers over whole folders (one task per file split, no per-file
loop on the driver); writes are partitioned Spark writes.  Provenance comes from the
reader's hidden ``_metadata`` column.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landframe.operators.quality import duplicate_keys
from landframe.session import materialize


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_headerless(spark: SparkSession, paths, names: Sequence[str], sep: str = ",",
                    provenance: bool = False, empty_as_null: bool = False) -> DataFrame:
    """Every delimited file under ``paths`` read as text, stacked, columns named from
    ``names`` (a declared all-string schema: no inference pass, no type guessing).

    An empty field stays an empty string, as in an all-character table load (the CSV
    reader reports it as null; with every column text, null can only mean empty), so
    e.g. an empty parent id pads to twelve zeros.  ``empty_as_null=True`` keeps nulls."""
    df = (spark.read.schema(text_schema(names)).option("header", False).option("sep", sep)
          .option("mode", "PERMISSIVE").csv(paths))
    if not empty_as_null:
        df = df.select(*[F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names])
    return with_provenance(df) if provenance else df


#: the reader's column for records that have not one field for every name
_RECORD = "__record"
#: files with line breaks inside quotes up to which only they are read whole
_WHOLE_FILES = 1000


def _count_fields(record, sep: str) -> Column:
    """Fields of a delimited record: separators outside quotes, and one."""
    bare = F.regexp_replace(record, '(?s)"(?:[^"]|"")*+"', "")
    return (F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1).cast("int")


def files_with_quoted_breaks(spark: SparkSession, paths) -> list[str]:
    """Files in which some line has an odd number of quotes, so that a record may go on in the
    next line (one scan; the list is bounded by the number of files)."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"))
    odd = lines.filter((F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1)
    return sorted(r["file"] for r in odd.select("file").distinct().collect())


def read_headerless_checked(spark: SparkSession, paths, names: Sequence[str], sep: str = ",", quoted_breaks: bool | None = None,
                            empty_as_null: bool = False) -> tuple[DataFrame, DataFrame]:
    """As ``read_headerless``, but no record is cut, padded or broken: returns ``(rows,
    rejects)``, and every record of the files is in exactly one of them.

    ``rows`` holds the records with one field for every name, and their ``file``.  ``rejects``
    holds the others: ``file``, ``record`` (as written), ``n_fields`` and ``reason``
    (``"too many fields"`` or ``"too few fields"``).  Line breaks and separators inside quotes
    belong to the field, a doubled quote is a quote; blank lines are no records.  A quote never
    closed takes what follows into its field, so the record ends up in ``rejects`` as a whole.

    Files with line breaks inside quotes are read whole, one task a file; all others are split.
    ``quoted_breaks`` None finds them by a scan, True reads all files so, False none.
    """
    schema = text_schema([*names, _RECORD])

    def read(where, whole: bool) -> DataFrame:
        df = (spark.read.schema(schema).option("header", False).option("sep", sep).option("escape", '"').option("mode", "PERMISSIVE")
              .option("multiLine", whole).option("columnNameOfCorruptRecord", _RECORD)
              .option("columnPruning", False).csv(where))  # a record is judged by all of its fields
        return df.select("*", F.col("_metadata.file_path").alias("file"))

    broken = files_with_quoted_breaks(spark, paths) if quoted_breaks is None else []
    if quoted_breaks or len(broken) > _WHOLE_FILES:
        df = read(paths, True)
    elif broken:
        df = read(paths, False).filter(~F.col("file").isin(broken)).unionByName(read([unquote(f) for f in broken], True))
    else:
        df = read(paths, False)
    good = df.filter(F.col(_RECORD).isNull())
    rows = good.select(*[F.col(f"`{n}`") if empty_as_null else F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names], "file")
    # a field is read with the record: the reader refuses queries for the record alone
    read_too = F.coalesce(F.length(f"`{names[0]}`"), F.lit(0)) >= 0
    bad = df.filter(F.col(_RECORD).isNotNull() & read_too).select("file", F.col(_RECORD).alias("record"), _count_fields(F.col(_RECORD), sep).alias("n_fields"))
    return rows, bad.withColumn("reason", F.when(F.col("n_fields") > len(names), "too many fields").otherwise("too few fields"))


def load_headerless(spark: SparkSession, paths, names: Sequence[str], out: str, rejects: str, **options) -> DataFrame:
    """Write the good records and the rejected ones (Parquet); one row of counts
    (``loaded``, ``rejected``)."""
    good, bad = read_headerless_checked(spark, paths, names, **options)
    good.write.mode("overwrite").parquet(out)
    bad.write.mode("overwrite").parquet(rejects)
    marks = spark.read.schema(good.schema).parquet(out).select(F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        spark.read.schema(bad.schema).parquet(rejects).select(F.lit(0).alias("l"), F.lit(1).alias("r")))
    return marks.agg(F.coalesce(F.sum("l"), F.lit(0)).alias("loaded"), F.coalesce(F.sum("r"), F.lit(0)).alias("rejected"))


def read_csv(spark: SparkSession, paths, null_value: str | None = None,
             schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header; a declared schema is preferred (inference costs a full extra
    pass over the data); ``null_value`` is the text read as null (e.g. two spaces)."""
    r = spark.read.option("header", True)
    if null_value is not None:
        r = r.option("nullValue", null_value)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(paths)


def read_features(spark: SparkSession, paths, row_tag: str, schema: T.StructType | str | None = None,
                  provenance: bool = True) -> DataFrame:
    """S3: one feature layer (elements named ``row_tag``) out of every XML/GML
    file under ``paths``, stacked; with provenance columns by default (S4).  Elements
    are matched without their namespace prefix, XML attributes as ``_name``."""
    r = spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", True)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(paths)
    return with_provenance(df) if provenance else df


def read_map_layer(spark: SparkSession, paths, layer: str) -> DataFrame:
    """One of the declared map layers (``layouts.MAP_LAYERS``) in its table form.

    The feature's id is an XML attribute and element names start in lower case; of repeated
    children (theme, group, term, change history) the first is the value and their number
    the ``...Count`` attribute.  Elements a feature lacks are null (counts 0)."""
    from landframe.sources.layouts import MAP_LAYERS

    declared = T._parse_datatype_string(MAP_LAYERS[layer])
    repeated = {"Theme", "DescriptiveGroup", "DescriptiveTerm"}
    names = [f for f in declared.fields if f.name != "TOID" and not f.name.endswith("Count") and f.name not in ("ChangeDate", "ReasonForChange")]
    low = lambda name: name[0].lower() + name[1:]
    raw = T.StructType([T.StructField("_fid", T.StringType())])
    for f in names:
        raw.add(low(f.name), T.ArrayType(T.StringType()) if f.name in repeated else f.dataType)
    if "ChangeDate" in declared.names:
        raw.add("changeHistory", T.ArrayType(T.StructType([T.StructField("changeDate", T.StringType()), T.StructField("reasonForChange", T.StringType())])))
    df = read_features(spark, paths, layer, raw)
    size = lambda c: F.coalesce(F.size(F.col(c)), F.lit(0)).cast("smallint")
    out = []
    for f in declared.fields:
        if f.name == "TOID":
            c = F.col("_fid")
        elif f.name == "ChangeHistoryCount":
            c = size("changeHistory")
        elif f.name in ("ChangeDate", "ReasonForChange"):
            c = F.get("changeHistory", F.lit(0))[low(f.name)]
        elif f.name.endswith("Count"):
            c = size(low(f.name[:-5]))
        else:
            c = F.get(low(f.name), F.lit(0)) if f.name in repeated else F.col(low(f.name))
        out.append(c.alias(f.name))
    return df.select(*out, "tile", "file")


def with_provenance(df: DataFrame, tile_col: str = "tile", file_col: str = "file") -> DataFrame:
    """``file`` = source path, ``tile`` = source base name without extension."""
    return df.select("*", F.regexp_extract(F.col("_metadata.file_name"), "^([^.]*)", 1).alias(tile_col),
                     F.col("_metadata.file_path").alias(file_col))


def _sql_literal(v, dtype: T.DataType) -> str:
    """A Python value as a typed Spark SQL literal (arrays and structs nested)."""
    if v is None:
        return f"CAST(NULL AS {dtype.simpleString()})"
    if isinstance(dtype, T.ArrayType):
        if not v:
            return f"CAST(array() AS {dtype.simpleString()})"
        return "array(" + ", ".join(_sql_literal(x, dtype.elementType) for x in v) + ")"
    if isinstance(dtype, T.StructType):
        return "named_struct(" + ", ".join(f"'{f.name}', {_sql_literal(x, f.dataType)}"
                                           for x, f in zip(v, dtype.fields)) + ")"
    if isinstance(dtype, T.StringType):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(dtype, T.BooleanType):
        return "TRUE" if v else "FALSE"
    return f"CAST('{v!r}' AS {dtype.simpleString()})" if isinstance(v, float) else \
        f"CAST('{v}' AS {dtype.simpleString()})"


def lookup(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A literal lookup table (small and fixed by construction).

    Rendered as one SQL ``VALUES`` clause: a local relation planned in the JVM (no
    Python worker reads it, and it joins as a broadcast), built with a single call."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    if not rows:
        return spark.createDataFrame([], schema)
    body = ", ".join("(" + ", ".join(_sql_literal(x, f.dataType) for x, f in zip(r, schema.fields)) + ")"
                     for r in rows)
    cols = ", ".join(f"`{f.name}`" for f in schema.fields)
    df = spark.sql(f"SELECT * FROM VALUES {body} AS t({cols})")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in schema.fields])


def write_release(df: DataFrame, root: str, release_col: str = "release", fmt: str = "parquet",
                  replaces: Sequence[str] = ()) -> None:
    """Write partitioned by release; only the releases present in ``df`` are replaced
    (dynamic partition overwrite), earlier releases stay.  Releases named in ``replaces``
    are replaced even when ``df`` has no row of them, and no other is written."""
    for release in replaces:
        part = df.filter(F.col(f"`{release_col}`") == release).drop(release_col)
        part.write.mode("overwrite").format(fmt).save(f"{root}/{release_col}={release}")
    if replaces:
        return
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(release_col).format(fmt).save(root))


def replace_table(df: DataFrame, url: str, table: str, key: str | None = None, batch: int = 100_000,
                  properties: Mapping[str, str] | None = None) -> None:
    """Replace a database table with ``df`` (drop + create + batched inserts).

    The key is checked for uniqueness first (Q1); a duplicate aborts the load before the
    table is touched, as the primary-key step would have.
    """
    if key is not None and duplicate_keys(df, [key]).limit(1).count():
        raise ValueError(f"duplicate values in key column {key}; table {table} not replaced")
    w = df.write.mode("overwrite").option("batchsize", batch)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.jdbc(url, table)


def fan_out(df: DataFrame, sinks: Mapping[str, tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], None]]]) -> None:
    """Send the same rows to several sinks, each with its own transform.

    The input is written once to the shared checkpoint folder and every sink reads it from
    there, so it is computed once, whatever executors are lost, and fills no executor's disk.
    """
    df = materialize(df)
    for transform, writer in sinks.values():
        writer(transform(df))


def append_period_column(history: DataFrame, update: DataFrame, history_key: str, update_key: str,
                         value_col: str, period_name: str, drop: Sequence[str] = ()) -> DataFrame:
    """Add this period's column to a running history table (inner merge on the key,
    drop unwanted update columns, name the new column after the period).  Write the
    result to a new version folder: Spark cannot overwrite a path it is reading."""
    from landframe.operators.joins import merge_on
    upd = update.drop(*drop).withColumnRenamed(value_col, period_name)
    return merge_on(history, upd, history_key, update_key)
