"""License scan by diagonal voting (native DataFrame functions only).

All rolling word k-grams of a text are joined by hash to the positions of the same k-gram
in the license templates.  A k-gram at word ``p`` of the text and ``q`` of a template votes
for the diagonal ``p - q``, the place where the template would begin.  Votes are counted per
diagonal, neighbouring diagonals (words inserted or left out) are merged, and a span is
verified by the part of the template's k-grams it holds and by its length.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landframe.llm.common import LOWER, UPPER, WORD_PATTERN, column, documents, words_of

GRAM = 2
#: templates larger than this are joined by a shuffle instead of a broadcast
BROADCAST_GRAMS = 100_000


@dataclass(frozen=True)
class Template:
    """``min_cover``: part of the k-grams a span must hold; ``slack``: how many words the
    diagonals of one span may lie apart (0: the words must stand consecutively)."""

    label: str
    text: str
    base: bool = False
    min_cover: float = 0.7
    slack: int = 4

    @property
    def grams(self) -> list[str]:
        words = [w.decode() for w in words_of(self.text)]
        return [" ".join(words[i:i + GRAM]) for i in range(len(words) - GRAM + 1)]


# The phrases and labels of the contract
BASE_TEMPLATES = [
    Template("mit", "mit license", True, 1.0, 0),
    Template("apache", "apache license", True, 1.0, 0),
    Template("gpl", "general public license", True, 1.0, 0),
]

# Wordings in which public licenses are granted or referred to
METHOD_TEMPLATES = [
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
             "and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    Template("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
             "except in compliance with the License. You may obtain a copy of the License at"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
             "GNU General Public License as published by the Free Software Foundation"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
             "fee is hereby granted"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by", "licensed under CC BY 4.0", False, 1.0, 0),
    Template("cc-by-nc", "licensed under CC BY-NC 4.0", False, 1.0, 0),
    Template("cc-by-sa", "licensed under CC BY-SA 4.0", False, 1.0, 0),
    Template("mit", "released under the MIT License", False, 1.0, 0),
    Template("apache", "licensed under the Apache License Version 2.0", False, 0.8, 2),
    Template("gpl", "licensed under the GNU General Public License", False, 0.8, 2),
]


def template_grams(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """One row per template position: hash and text of the k-gram, and the template's rules."""
    rows = [(i, t.label, t.base, t.min_cover, t.slack, len(t.grams), q, gram)
            for i, t in enumerate(templates) for q, gram in enumerate(t.grams)]
    grams = spark.createDataFrame(rows, "t int, label string, base boolean, min_cover double, slack int, "
                                        "t_grams int, q int, t_gram string")
    grams = grams.withColumn("t_hash", F.xxhash64("t_gram"))
    return F.broadcast(grams) if len(rows) <= BROADCAST_GRAMS else grams


def scan_licenses(docs: DataFrame, templates: Sequence[Template], id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document row: ``doc_id, n_words, spans``, an array of verified spans
    ``(start, end, label, base, cover)`` in words from 0, end exclusive, sorted.

    Null and empty texts have no words and no spans; repeated ids are separate rows; an
    empty table gives no rows.  Only matched k-grams (and one row per document) are
    shuffled, once, by row: everything after the join keeps that partitioning.
    """
    grams = template_grams(docs.sparkSession, templates)
    words = F.regexp_extract_all(F.translate(F.coalesce(column(docs, text_col), F.lit("")), UPPER, LOWER),
                                 F.lit(WORD_PATTERN), F.lit(0))
    w = F.col("words")
    rolling = F.when(F.size(w) >= GRAM, F.transform(
        F.sequence(F.lit(0), F.size(w) - GRAM), lambda i: F.concat_ws(" ", *[F.get(w, i + j) for j in range(GRAM)])))
    voted = (
        # row ids only have to tell rows apart inside the task that made them
        docs.select(column(docs, id_col).alias("doc_id"), words.alias("words"),
                    F.monotonically_increasing_id().alias("row"))
        # the words end here: no array may ride on the rows of its own elements
        .select("row", "doc_id", F.size("words").cast("long").alias("n_words"), rolling.alias("grams"))
        .select("row", "doc_id", "n_words", F.posexplode_outer("grams").alias("p", "gram"))
        .join(grams, (F.xxhash64("gram") == F.col("t_hash")) & (F.col("gram") == F.col("t_gram")), "left")
        .filter(F.col("t").isNotNull() | (F.coalesce(F.col("p"), F.lit(0)) == 0))
        .withColumn("diagonal", F.col("p") - F.col("q"))
        .drop("gram", "t_gram", "t_hash")
        .repartition("row")
    )
    rules = ["t", "label", "base", "min_cover", "slack", "t_grams"]
    diagonals = voted.groupBy("row", "doc_id", "n_words", *rules, "diagonal").agg(
        F.collect_set("q").alias("places"), F.min("p").alias("first"), F.max("p").alias("last"))
    along = Window.partitionBy("row", "t").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > F.col("slack")
    merged = (
        diagonals.withColumn("cut", F.coalesce(apart, F.lit(False)).cast("int"))
        .withColumn("span", F.sum("cut").over(along))
        .groupBy("row", "doc_id", "n_words", *rules, "span")
        # a template position counts once, however often its gram is repeated; at most t_grams of them
        .agg(F.size(F.array_distinct(F.flatten(F.collect_set("places")))).alias("held"),
             F.min("first").alias("start"), (F.max("last") + GRAM).alias("end"))
        .withColumn("cover", F.col("held") / F.col("t_grams"))
    )
    verified = (F.col("cover") >= F.col("min_cover")) & (
        F.col("end") - F.col("start") <= 1.5 * (F.col("t_grams") + GRAM - 1) + 2 * F.col("slack"))
    span = F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "label", "base", "cover")
    return merged.groupBy("row", "doc_id", "n_words").agg(
        F.array_sort(F.collect_list(F.when(verified, span))).alias("spans")).drop("row")


def op1_license_scan(spark, sf_dir) -> DataFrame:
    """License phrases and wordings in all documents."""
    found = scan_licenses(documents(spark, sf_dir), [*BASE_TEMPLATES, *METHOD_TEMPLATES])
    base = F.filter("spans", lambda s: s["base"])

    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda s: s["start"])).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["cover"])), F.lit(0.0)).alias("score"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"),
    )


def oracle() -> str:
    values = ", ".join(
        f"({i}, '{t.label}', {t.base}, {t.min_cover}::DOUBLE, {t.slack}, {len(t.grams)}, {q}, '{gram}')"
        for i, t in enumerate([*BASE_TEMPLATES, *METHOD_TEMPLATES]) for q, gram in enumerate(t.grams))
    return f"""
WITH tg(t, label, base, min_cover, slack, t_grams, q, gram) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD_PATTERN}') AS w FROM documents),
g AS (SELECT r, unnest(range(0, len(w) - 1)) AS p,
        unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM d),
dg AS (SELECT r, t, label, base, min_cover, slack, t_grams, p - q AS diagonal, q, min(p) AS f, max(p) AS l
       FROM g JOIN tg USING (gram) GROUP BY r, t, label, base, min_cover, slack, t_grams, p - q, q),
nb AS (SELECT r, t, diagonal, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, t ORDER BY diagonal) > any_value(slack) THEN 1 ELSE 0 END AS c
       FROM dg GROUP BY r, t, diagonal),
isl AS (SELECT dg.*, span FROM dg JOIN (SELECT *, sum(c) OVER (PARTITION BY r, t ORDER BY diagonal) AS span FROM nb) USING (r, t, diagonal)),
sp AS (SELECT r, t, label, base, min_cover, slack, t_grams, span, min(f) AS s, max(l) + {GRAM} AS e,
              count(DISTINCT q)::DOUBLE / t_grams AS cover FROM isl
       GROUP BY r, t, label, base, min_cover, slack, t_grams, span),
ok AS (SELECT * FROM sp WHERE cover >= min_cover AND e - s <= 1.5 * (t_grams + {GRAM - 1}) + 2 * slack),
by_doc AS (SELECT r, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
       string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
       string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score,
       string_agg(label || ':' || s || ':' || e, ',' ORDER BY s, e, label, base, cover) AS spans FROM ok GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score, coalesce(spans, '') AS spans
FROM d LEFT JOIN by_doc USING (r)"""
