"""Registered page/text extraction queries (H*) over ``pages``, ``documents`` and
``conversations``."""

from __future__ import annotations

from pyspark.sql import functions as F

from landframe.sources import pages as H
from landframe.plans.registry import register
from landframe.plans.tables import table


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_CLEAN = f"regexp_replace(html, {_q(H.NOISE_PATTERN)}, '', 'g')"


def _decode_sql(expr: str) -> str:
    for ent, ch in H.ENTITIES:
        expr = f"replace({expr}, {_q(ent)}, {_q(ch)})"
    return expr


def _text_sql(frag: str) -> str:
    return "trim(" + _decode_sql(f"regexp_replace({frag}, {_q(H.TAG_PATTERN)}, '', 'g')") + ")"


def _positions(list_expr: str) -> str:
    return f"unnest(generate_series(0, len({list_expr}) - 1))"


# every link of a page in order: a value in double quotes, single quotes or none
_LINKS = r"""list_transform(regexp_extract_all(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'g'),
    '(?is)<a\b[^>]*?\bhref\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1),
    lambda h: replace(CASE WHEN h[1] IN ('"', chr(39)) THEN h[2:-2] ELSE h END, '&amp;', '&'))"""


@register("h1_links", sql=f"""
SELECT page_id, CAST(pos AS INTEGER) AS pos, href FROM (
  SELECT page_id, unnest(l) AS href, {_positions('l')} AS pos FROM (SELECT page_id, {_LINKS} AS l FROM pages))
""")
def h1_links(spark, sf_dir):
    """H1: every link of every page, in order."""
    return H.extract_links(table(spark, sf_dir, "pages"), "page_id", "html")


@register("h2_filter_links", sql=f"""
SELECT page_id, CAST(pos AS INTEGER) AS pos, href FROM (
  SELECT page_id, unnest(l) AS href, {_positions('l')} AS pos
  FROM (SELECT page_id, list_filter({_LINKS}, lambda h: length(h) > 5) AS l FROM pages))
""")
def h2_filter_links(spark, sf_dir):
    """H2: links longer than 5 characters, numbered anew."""
    return H.filter_links(table(spark, sf_dir, "pages"), "page_id", "html", 5)


@register("h5_filtered_pairs", sql=f"""
WITH k AS (SELECT page_id, unnest(l) AS href, {_positions('l')} AS pos
           FROM (SELECT page_id, list_filter({_LINKS}, lambda h: length(h) > 5) AS l FROM pages)),
n AS (SELECT page_id, unnest(l) AS text, {_positions('l')} AS pos
      FROM (SELECT page_id, list_transform(regexp_extract_all({_CLEAN}, {_q(H.element_pattern('li'))}, 1), lambda f: {_text_sql('f')}) AS l FROM pages))
SELECT page_id, CAST(pos AS INTEGER) AS pos, text, href FROM n JOIN k USING (page_id, pos)
""")
def h5_filtered_pairs(spark, sf_dir):
    """H1 -> H2 -> H5: the i-th list item with the i-th link that is long enough."""
    pages = table(spark, sf_dir, "pages")
    return H.zip_pairs(H.extract_text(pages, "page_id", "html", "li"), H.filter_links(pages, "page_id", "html", 5), "page_id")


@register("h3_text", sql=f"""
SELECT page_id, CAST(pos AS INTEGER) AS pos, {_text_sql('frag')} AS text FROM (
  SELECT page_id, unnest(l) AS frag, {_positions('l')} AS pos
  FROM (SELECT page_id, regexp_extract_all({_CLEAN}, {_q(H.element_pattern('li'))}, 1) AS l FROM pages))
""")
def h3_text(spark, sf_dir):
    """H3: text of every ``<li>`` element (tags stripped, entities decoded)."""
    return H.extract_text(table(spark, sf_dir, "pages"), "page_id", "html", "li")


@register("h3_title", sql=f"""
SELECT page_id, CAST(pos AS INTEGER) AS pos, {_text_sql('frag')} AS text FROM (
  SELECT page_id, unnest(l) AS frag, {_positions('l')} AS pos
  FROM (SELECT page_id, regexp_extract_all({_CLEAN}, {_q(H.element_pattern('title'))}, 1) AS l FROM pages))
""")
def h3_title(spark, sf_dir):
    """H3: page titles (entities such as ``&amp;`` decoded)."""
    return H.extract_text(table(spark, sf_dir, "pages"), "page_id", "html", "title")


@register("h4_split_names", sql="""
SELECT doc_id, CAST(pos AS INTEGER) AS pos, name FROM (
  SELECT doc_id, unnest(l) AS name, unnest(generate_series(0, len(l) - 1)) AS pos FROM (
    SELECT doc_id,
           list_transform(list_filter(list_transform(string_split_regex(text, '[\\r\\n\\t]'), lambda x: replace(x, ' ', '')),
                                      lambda x: x <> ''), lambda x: replace(x, '-', '_')) AS l
    FROM documents))
""")
def h4_split_names(spark, sf_dir):
    """H4: whole document texts split into clean line items (CR/LF/TAB separated)."""
    return H.split_names(table(spark, sf_dir, "documents"), "doc_id", "text")


@register("h5_zip_pairs", sql=f"""
SELECT page_id, CAST(pos AS INTEGER) AS pos, n[pos + 1] AS name, k[pos + 1] AS href FROM (
  SELECT page_id, n, k, unnest(generate_series(0, greatest(len(n), len(k)) - 1)) AS pos FROM (
    SELECT page_id,
      list_transform(regexp_extract_all({_CLEAN}, {_q(H.element_pattern('li'))}, 1), lambda f: {_text_sql('f')}) AS n,
      {_LINKS} AS k
    FROM pages))
""")
def h5_zip_pairs(spark, sf_dir):
    """H5: the i-th list item paired with the i-th link of the same page."""
    p = table(spark, sf_dir, "pages")
    z = p.select("page_id", F.posexplode(H.zip_arrays(H.texts("html", "li"), H.links("html"), "name", "href"))
                 .alias("pos", "z"))
    return z.select("page_id", "pos", "z.name", "z.href")


@register("h3_paragraphs", sql="""
WITH c AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<(script|style)\b.*?</(script|style)>', '', 'g'), '(?s)<!--.*?-->', '', 'g') AS html FROM pages),
p AS (SELECT page_id, unnest(string_split(html, '<p>')[2:]) AS tail, unnest(range(0, len(string_split(html, '<p>')) - 1)) AS pos FROM c)
SELECT page_id, CAST(pos AS INTEGER) AS pos,
       trim(replace(replace(replace(replace(regexp_replace(regexp_replace(tail, '(?s)(</p>|</?article|</?div|<footer|</?ul|</body|<h1|</h1).*', ''), '<[^>]*>', '', 'g'),
            '&quot;', '"'), '&copy;', chr(169)), '&middot;', chr(183)), '&amp;', '&')) AS text
FROM p
""")
def h3_paragraphs(spark, sf_dir):
    """H3: the text of every paragraph, most of them closed only by the next one."""
    return H.extract_text(table(spark, sf_dir, "pages"), "page_id", "html", "p")


def _order_pages(spark, sf_dir):
    """A page a customer: a table with a row an order, its cells not closed, the first cell
    holding a table of the order's priority and status; text after it belongs to the cell."""
    o = table(spark, sf_dir, "orders")
    row = F.concat(F.lit("<tr><td title='>'>"), F.col("o_orderkey").cast("string"), F.lit("<TABLE><tr><th>"), F.col("o_orderpriority"),
                   F.lit("<td>"), F.col("o_orderstatus"), F.lit("</table>&eacute;&#33;<td>"), F.col("o_custkey").cast("string"))
    grouped = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", row.alias("html")))).alias("rows"))
    return grouped.select(F.col("o_custkey").alias("page_id"), F.concat(
        F.lit("<p>orders<table class=orders>"), F.array_join(F.transform("rows", lambda r: r["html"]), "\n"), F.lit("</table><td>none")).alias("html"))


@register("h6_nested_tables", sql="""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders)
SELECT o_custkey AS page_id, CAST(0 AS INTEGER) AS tbl, CAST(i AS INTEGER) AS "row", 0 AS col, o_orderkey || o_orderpriority || o_orderstatus || 'é!' AS text FROM o
UNION ALL SELECT o_custkey, 0, CAST(i AS INTEGER), 1, CAST(o_custkey AS VARCHAR) FROM o
UNION ALL SELECT o_custkey, CAST(i + 1 AS INTEGER), 0, 0, o_orderpriority FROM o
UNION ALL SELECT o_custkey, CAST(i + 1 AS INTEGER), 0, 1, o_orderstatus FROM o
""")
def h6_nested_tables(spark, sf_dir):
    """H6: cells of nested tables whose cells and rows are not closed."""
    cells = H.extract_table(_order_pages(spark, sf_dir), "page_id", "html")
    return cells.withColumn("text", F.regexp_replace("text", "\\s+$", ""))


@register("h7_kv_records", sql="""
WITH f AS (SELECT conv_id, role, arg_min(text, (turn, text)) AS text FROM conversations GROUP BY conv_id, role)
SELECT conv_id, max(CASE WHEN role = 'assistant' THEN text END) AS assistant,
       max(CASE WHEN role = 'system' THEN text END) AS system, max(CASE WHEN role = 'user' THEN text END) AS "user"
FROM f GROUP BY conv_id
""")
def h7_kv_records(spark, sf_dir):
    """H7: (conversation, role, text) rows -> one record per conversation with the first
    text of each role as a column."""
    c = table(spark, sf_dir, "conversations")
    return H.kv_to_records(c, "conv_id", "role", "text", ["turn"])
