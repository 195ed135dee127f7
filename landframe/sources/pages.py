"""Text extraction over a table of pages (H1-H7), re-aimed from one-off scraping.

Everything is a native expression evaluated per row, so a table of millions of pages is
processed in parallel without a parser library.  Script, style and comment blocks are removed
first, because they may contain tag-like text (``var t="</p>"``).  A page is then cut at the
tags that matter for the element sought, and a fold over that short tag stream keeps a stack:
nested elements of the same name, cells of nested tables, and elements closed only by what
follows them (``<td>a<td>b``, ``<li>``, ``<p>``) come out as a browser would nest them.
Entities (named ones of HTML 4, decimal and hexadecimal) are decoded.
"""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landframe.functions._util import as_col
from landframe.functions.text import split_clean
from landframe.operators.reshape import pivot_vocabulary, widen
from landframe.operators.setops import distinct_rows
from landframe.operators.window import first_per_key

# Blocks removed before any extraction, and the entities decoded in text.
NOISE_PATTERN = "(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->"
HREF_PATTERN = "(?is)<a\\b[^>]*?\\shref\\s*=\\s*(\"[^\"]*\"|'[^']*'|[^\\s>\"']+)"
TAG_PATTERN = "<[^>]*>"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def strip_noise(html) -> Column:
    """Remove script/style blocks and comments."""
    return F.regexp_replace(as_col(html), NOISE_PATTERN, "")


#: the named entities of HTML 4 as one constant map (none of the characters needs quoting)
_NAMED = "map(" + ", ".join(f"'{name}', '{chr(code)}'" for name, code in sorted(name2codepoint.items())) + ")"


def _character(code) -> Column:
    """The character of a code point; of numbers that are none, the replacement character."""
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")


def decode_entities(c) -> Column:
    """Entities as characters, in one pass; what is no entity stays as written."""
    text = as_col(c)
    named = F.expr(_NAMED)
    pieces = F.regexp_extract_all(text, F.lit("(?s)&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&[A-Za-z][A-Za-z0-9]{1,30};|[^&]+|&"), F.lit(0))

    def one(p):
        number = F.coalesce(F.conv(F.nullif(F.regexp_extract(p, "^&#[xX]([0-9a-fA-F]+);$", 1), F.lit("")), 16, 10),
                            F.nullif(F.regexp_extract(p, "^&#([0-9]+);$", 1), F.lit(""))).try_cast("bigint")
        name = F.try_element_at(named, F.regexp_extract(p, "^&([A-Za-z][A-Za-z0-9]*);$", 1))
        return F.when(~F.startswith(p, F.lit("&")), p).when(number.isNotNull(), _character(number)).otherwise(F.coalesce(name, p))

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, one), "")).otherwise(text)


def node_text(fragment) -> Column:
    """Text content of an HTML fragment: tags removed, entities decoded, trimmed."""
    return F.trim(decode_entities(F.regexp_replace(as_col(fragment), TAG_PATTERN, "")))


def element_pattern(tag: str, id_: str | None = None, class_: str | None = None) -> str:
    attrs = ""
    if id_ is not None:
        attrs += f"(?=[^>]*\\bid\\s*=\\s*[\"']{id_}[\"'])"
    if class_ is not None:
        attrs += f"(?=[^>]*\\bclass\\s*=\\s*[\"'][^\"']*\\b{class_}\\b[^\"']*[\"'])"
    return f"(?is)<{tag}\\b{attrs}[^>]*>(.*?)</{tag}\\s*>"


def links(html) -> Column:
    """H1 as an expression: all ``<a href>`` values of a page, in document order.  A quoted
    value ends at its own quote sign; unquoted values count too; entities are decoded.  Other
    attributes that end in ``href`` (``data-href``) are none."""
    written = F.regexp_extract_all(strip_noise(html), F.lit(HREF_PATTERN), 1)
    return F.transform(written, lambda h: decode_entities(
        F.when(F.substring(h, 1, 1).isin('"', "'"), F.substring(h, F.lit(2), F.length(h) - 2)).otherwise(h)))


# For elements that need no closing tag, the tags whose opening closes them, and
# the tags that open a context of their own; a paragraph ends at any opening or closing block.
IMPLIED_END = {
    "li": (("li",), ("ul", "ol", "menu")),
    "td": (("td", "th", "tr", "tbody", "thead", "tfoot"), ("table",)),
    "th": (("td", "th", "tr", "tbody", "thead", "tfoot"), ("table",)),
    "tr": (("tr", "tbody", "thead", "tfoot"), ("table",)),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option", "optgroup"), ("select", "datalist")),
}
BLOCKS = ("address article aside blockquote body center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
          "header hr html li main menu nav ol p pre section table tbody td tfoot th thead tr ul").split()
_TAG_REST = "(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, not wherever it is written."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _pieces(html, names: Sequence[str], with_attrs: bool) -> Column:
    """The page cut before each opening or closing tag of ``names``: structs of ``tag`` (name in
    small letters, ``/`` before that of a closing one), ``attrs`` (empty unless asked for) and the
    ``text`` up to the next."""
    any_of = "|".join(names)
    marked = F.regexp_replace(F.translate(strip_noise(html), "\x01", ""), f"(?i)(?=</?(?:{any_of})(?![\\w-]))", "\x01")

    def cut(p):
        tag = F.lower(F.regexp_extract(p, f"(?i)^<(/?(?:{any_of}))(?![\\w-])", 1))
        attrs = F.regexp_extract(p, f"(?is)^<\\w+({_TAG_REST})", 1) if with_attrs else F.lit("")
        return F.struct(tag.alias("tag"), attrs.alias("attrs"), F.regexp_replace(p, f"(?s)^</?\\w+(?:{_TAG_REST}|[^>]*+(?:>|$))", "").alias("text"))

    return F.transform(F.split(marked, "\x01"), cut)


def _matches(attrs, id_: str | None, class_: str | None):
    ok = F.lit(True)
    if id_ is not None:
        ok = ok & F.regexp_like(attrs, F.lit(f"(?is)\\sid\\s*=\\s*(?:[\"']{id_}[\"']|{id_}[\\s>])"))
    if class_ is not None:
        ok = ok & F.regexp_like(attrs, F.lit(f"(?is)\\sclass\\s*=\\s*(?:[\"'](?:[^\"']*\\s)?{class_}(?:\\s[^\"']*)?[\"']|{class_}[\\s>])"))
    return ok


def _elements(pieces, tag: str, id_: str | None, class_: str | None) -> Column:
    """``(start, end)`` of every element ``tag`` in pieces, in document order, by a fold over the
    tags with a stack of open elements (their start) and contexts (-1)."""
    closers, scopes = IMPLIED_END.get(tag, ((), ()))
    ends = [b for b in BLOCKS if b != "p"] if tag == "p" else []
    nests = tag not in IMPLIED_END and tag != "p"
    start = F.struct(F.array().cast("array<int>").alias("stack"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def popped(stack):
        return F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0)))

    def step(s, i):
        stack, name = s["stack"], F.get(pieces, i)["tag"]
        top = F.coalesce(F.try_element_at(stack, F.lit(-1)), F.lit(-1))
        opens, closes = name == tag, name == f"/{tag}"
        shuts = closes
        for t in closers:
            shuts = shuts | (name == t)
        for t in scopes:
            shuts = shuts | (name == f"/{t}")
        if tag == "p":
            shuts = shuts | opens | name.isin(*ends, *[f"/{e}" for e in ends])
        shut = shuts & (top >= 0) & (F.lit(True) if not nests else closes)
        out = F.when(shut, F.concat(s["out"], F.array(F.struct(top.alias("start"), i.alias("end"))))).otherwise(s["out"])
        rest = F.when(shut, popped(stack)).otherwise(stack)
        if scopes:  # the context goes with its closing tag
            rest = F.when(name.isin(*[f"/{t}" for t in scopes]), popped(rest)).when(
                name.isin(*scopes), F.concat(rest, F.array(F.lit(-1)))).otherwise(rest)
        return F.struct(F.when(opens, F.concat(rest, F.array(i))).otherwise(rest).alias("stack"), out.alias("out"))

    last = F.size(pieces)

    def finish(s):  # elements still open end with the page
        left = F.transform(F.filter(s["stack"], lambda a: a >= 0), lambda a: F.struct(a.alias("start"), last.alias("end")))
        return F.filter(F.array_sort(F.concat(s["out"], left)), lambda e: _matches(F.get(pieces, e["start"])["attrs"], id_, class_))

    return F.aggregate(F.sequence(F.lit(0), last - 1), start, step, finish)


def _inner(pieces, element) -> Column:
    """Text of the pieces of an element (nested tags of the stream are cut off already)."""
    return node_text(F.array_join(F.transform(F.slice(pieces, element["start"] + 1, element["end"] - element["start"]), lambda p: p["text"]), ""))


def texts(html, tag: str, id_: str | None = None, class_: str | None = None) -> Column:
    """H3 as an expression: the text of every matching element, in document order; of nested
    ones the outer text holds the inner."""
    closers, scopes = IMPLIED_END.get(tag, ((), ()))
    names = dict.fromkeys([tag, *closers, *scopes, *(BLOCKS if tag == "p" else ())])
    return _let(_pieces(html, list(names), id_ is not None or class_ is not None), lambda p: F.transform(_elements(p, tag, id_, class_), lambda e: _inner(p, e)))


def extract_links(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """H1: ``(id, pos, href)`` for every link of every page (pos is 0-based)."""
    return pages.select(id_col, F.posexplode(links(html_col)).alias("pos", "href"))


def filter_links(pages: DataFrame, id_col: str, html_col: str, min_len: int) -> DataFrame:
    """H2: ``(id, pos, href)`` of the links longer than ``min_len`` characters; positions are
    counted over the links kept, as the job indexes its filtered list."""
    kept = F.filter(links(html_col), lambda h: F.length(h) > min_len)
    return pages.select(id_col, F.posexplode(kept).alias("pos", "href"))


def extract_text(pages: DataFrame, id_col: str, html_col: str, tag: str,
                 id_: str | None = None, class_: str | None = None) -> DataFrame:
    """H3: ``(id, pos, text)`` for every element ``tag`` (optionally by id / class); see
    ``texts``."""
    return pages.select(id_col, F.posexplode(texts(html_col, tag, id_, class_)).alias("pos", "text"))


def split_names(df: DataFrame, id_col: str, text_col: str, dash_to: str | None = "_") -> DataFrame:
    """H4: free-text list -> ``(id, pos, name)``: split on CR/LF/TAB, remove all spaces, drop
    empty pieces, map ``-`` to ``dash_to``."""
    return df.select(id_col, F.posexplode(split_clean(text_col, "[\\r\\n\\t]", dash_to)).alias("pos", "name"))


def zip_pairs(names: DataFrame, link_rows: DataFrame, id_col: str) -> DataFrame:
    """H5: pair the i-th name with the i-th (filtered) link of the same page (join on id, pos)."""
    return names.join(link_rows, [id_col, "pos"], "inner")


def zip_arrays(a, b, out_a: str, out_b: str) -> Column:
    """H5 within one row: ``arrays_zip`` of two arrays, shorter one padded with null."""
    return F.arrays_zip(as_col(a).alias(out_a), as_col(b).alias(out_b))


def table_cells(html) -> Column:
    """H6 as an expression: ``(tbl, row, col, text)`` of every cell, by a fold over the tags
    with a stack of open tables."""
    cell = "struct<tbl:int,row:int,col:int,start:int,end:int>"
    start = F.struct(F.lit(0).alias("tables"), F.array().cast("array<struct<tbl:int,row:int,col:int,at:int,in_row:boolean>>").alias("stack"),
                     F.array().cast(f"array<{cell}>").alias("out"))

    def level(tbl, row, col, at, in_row):
        return F.struct(tbl.alias("tbl"), row.alias("row"), col.alias("col"), at.alias("at"), in_row.alias("in_row"))

    def closed(t, end):
        return F.struct(t["tbl"].alias("tbl"), t["row"].alias("row"), t["col"].alias("col"), t["at"].alias("start"), end.alias("end"))

    none, yes, no = F.lit(-1), F.lit(True), F.lit(False)

    def cells(pieces):
        def step(s, i):
            return _let(F.struct(s.alias("s"), F.get(pieces, i)["tag"].alias("tag"), F.try_element_at(s["stack"], F.lit(-1)).alias("top")), lambda x: moved(x, i))

        def moved(x, i):
            s, tag, top = x["s"], x["tag"], x["top"]
            stack, inside = s["stack"], x["top"].isNotNull()
            rest = F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0)))
            ends = inside & (top["at"] >= 0) & (tag != "table") & (tag != "")
            out = F.when(ends, F.concat(s["out"], F.array(closed(top, i)))).otherwise(s["out"])
            row = F.when(top["in_row"], top["row"]).otherwise(top["row"] + 1)
            col = F.when(top["in_row"], top["col"] + 1).otherwise(F.lit(0))
            now = (F.when(tag == "tr", level(top["tbl"], top["row"] + 1, none, none, yes))
                   .when(tag.isin("td", "th"), level(top["tbl"], row, col, i, yes))
                   .when(tag.isin("/td", "/th"), level(top["tbl"], top["row"], top["col"], none, top["in_row"]))
                   .otherwise(level(top["tbl"], top["row"], top["col"], none, no)))
            new = (F.when(tag == "table", F.concat(stack, F.array(level(s["tables"], none, none, none, no))))
                   .when(~inside | (tag == ""), stack).when(tag == "/table", rest).otherwise(F.concat(rest, F.array(now))))
            return F.struct((s["tables"] + (tag == "table").cast("int")).alias("tables"), new.alias("stack"), out.alias("out"))

        last = F.size(pieces)
        found = F.aggregate(F.sequence(F.lit(0), last - 1), start, step, lambda s: F.concat(
            s["out"], F.transform(F.filter(s["stack"], lambda t: t["at"] >= 0), lambda t: closed(t, last))))
        return F.transform(F.array_sort(found), lambda c: F.struct(
            c["tbl"].alias("tbl"), c["row"].alias("row"), c["col"].alias("col"), _inner(pieces, c).alias("text")))

    return _let(_pieces(html, ["table", "tr", "td", "th", "thead", "tbody", "tfoot"], False), cells)


def extract_table(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """H6: every cell of every ``<table>`` as ``(id, tbl, row, col, text)`` (0-based).

    Header (``th``) and data (``td``) cells both count, closed or not.  Tables are numbered in
    document order; a table inside a cell has its own cells, and its text is part of the outer
    cell's text too.  A cell without a row opens one; cells outside a table are none."""
    some = pages.filter(F.contains(F.lower(html_col), F.lit("<table")))
    return some.select(id_col, F.explode(table_cells(html_col)).alias("c")).select(id_col, "c.tbl", "c.row", "c.col", "c.text")


def kv_to_records(kv: DataFrame, id_col: str, key_col: str, value_col: str,
                  order_by: Sequence[str], vocab: Sequence[str] | None = None) -> DataFrame:
    """H7: key/value rows (possibly from several pages per record) -> one wide record per
    id.  Exact duplicate rows are dropped, the first value per (id, key) by ``order_by``
    is kept, and keys become columns (byte-sorted, null where absent).  Without ``vocab`` the
    keys are read from the rows, which fails above ``spark.sql.pivotMaxValues`` keys."""
    vocab = pivot_vocabulary(kv, key_col) if vocab is None else vocab
    kv = distinct_rows(kv.select(id_col, key_col, value_col, *order_by))
    kv = first_per_key(kv, [id_col, key_col], list(order_by))
    return widen(kv.select(id_col, key_col, value_col), [id_col], key_col, value_col, vocab)
