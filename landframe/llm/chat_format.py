"""Chat formatting: final messages rebuilt from an event log, then rendered by a template.

The log is partitioned by conversation and sorted by message and sequence; one pass over the
sorted rows folds messages, streamed deltas, edits and regenerations into final turns and
renders them.  A conversation of more than ``segment`` events is cut into segments of message
numbers, so that none is gathered in one task; what crosses a segment's border is only the
latest regeneration before it, which is sent ahead as an event of its own.

Template: ``<turn>role``, line break, text, ``<end>``, line break.  A backslash goes before
every ``\\`` and ``<`` of roles and texts (a role's line break becomes ``\\n``), so no text can
hold a mark and the output can be read back exactly.  The loss mask is given as spans.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landframe.llm.common import column, text_slices

TURN, END = "<turn>", "<end>\n"
KINDS = ("message", "delta", "edit", "regenerate")
#: rows that carry the latest regeneration of earlier segments into a segment
CARRY = "\x00carry"
_TURN = re.compile(r"<turn>((?:[^\\<\n]++|\\.)*+)\n((?:[^\\<]++|\\.)*+)<end>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)

#: conversations over the segment size up to which their ids are broadcast
BROADCAST_CONVERSATIONS = 200_000
QUERY_ADVERSARY = "\\### Assistant: </turn> ok"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\<")


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role) if "\\" in role else role


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn; anything that the template doesn't write is an error."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def _earlier(a, b) -> bool:
    """Whether sequence ``a`` comes before ``b`` (null before all)."""
    return b is not None and (a is None or a < b)


def final_turns(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conversation, role, text) of the final turns, folded from rows (conversation, message,
    seq, kind, role, text) that are sorted by conversation, number, regenerations first, then
    sequence.  So the latest regeneration is known before the events that it voids, and only
    one turn is held at a time."""
    key, cutoff, turn, spoken = None, None, None, None

    def closed() -> tuple:
        return key[0], turn[0] or spoken or "", "".join(turn[1])

    for conv, message, seq, kind, role, text in rows:
        if key != (conv, message):
            if turn is not None:
                yield closed()
            if key is None or key[0] != conv:
                cutoff = None
            key, turn, spoken = (conv, message), None, None
        if _earlier(seq, cutoff):
            spoken = spoken if role is None else role
        elif kind == CARRY:
            cutoff = seq
        elif kind == "regenerate":
            cutoff, turn = seq, [role, [text]]
        elif turn is None or kind == "message":
            if turn is not None:
                yield closed()
            turn = [role, [text]]
        else:
            turn[0] = turn[0] if role is None else role
            if kind == "edit":
                turn[1] = [text]
            else:
                turn[1].append(text)
    if turn is not None:
        yield closed()


class Part:
    """Rendered turns of one conversation, up to a size."""

    def __init__(self, conv):
        self.conv, self.turns, self.size, self.chunks, self.loss = conv, 0, 0, [], []

    def add(self, role: str, text: str, loss_roles: frozenset[str]) -> None:
        head, body = f"{TURN}{escape_role(role)}\n", escape(text)
        if role in loss_roles:
            start = self.size + len(head)
            self.loss.append({"start": start, "end": start + len(body)})
        self.chunks += (head, body, END)
        self.size += len(head) + len(body) + len(END)
        self.turns += 1


def _render(turns: Iterator[tuple], loss_roles: frozenset[str], part_chars: int) -> Iterator[Part]:
    part = None
    for conv, role, text in turns:
        if part is None or part.conv != conv or part.size >= part_chars:
            if part is not None:
                yield part
            part = Part(conv)
        part.add(role, text, loss_roles)
    if part is not None:
        yield part


def _segmented(log: DataFrame, segment: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary conversations (``seg`` 0) and, if there are any, of long ones with the
    segment of their message numbers."""
    sizes = log.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.min("message").alias("low"), F.max("message").alias("high"))
    long = sizes.filter(F.col("n") > segment).withColumn("conv_key", F.struct("conv"))
    n_long = long.count()
    if not n_long:
        return log.withColumn("seg", F.lit(0).cast("long")), None
    long = long.select("conv_key", "low", F.ceil(F.col("n") / segment).alias("k"), (F.col("high") - F.col("low") + 1).alias("width"))
    long = F.broadcast(long) if n_long <= BROADCAST_CONVERSATIONS else long
    keyed = log.withColumn("conv_key", F.struct("conv"))
    short = keyed.join(long, "conv_key", "left_anti").drop("conv_key").withColumn("seg", F.lit(0).cast("long"))
    at = F.floor((F.col("message") - F.col("low")).cast("double") * F.col("k") / F.col("width")).cast("long")
    rows = keyed.join(long, "conv_key").withColumn("seg", F.coalesce(at, F.lit(-1).cast("long")))
    rows = rows.drop("conv_key", "low", "k", "width")
    # the latest regeneration before each segment goes ahead of the segment's rows
    marks = rows.groupBy("conv", "seg").agg(F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("seq"))
    before = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.withColumn("seq", F.max("seq").over(before)).filter("seq is not null").select(
        "conv", F.lit(None).cast("long").alias("message"), "seq", F.lit(CARRY).alias("kind"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "seg")
    return short, rows.unionByName(carried)


def _formatted(rows: DataFrame, loss_roles: frozenset[str], part_chars: int) -> DataFrame:
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    conv = rows.schema["conv"].dataType
    types = [to_arrow_type(conv), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
    names = ["conv", "seg", "number", "n_turns", "formatted", "loss"]
    placed = rows.repartition("conv", "seg").sortWithinPartitions(
        F.col("conv").asc_nulls_first(), "seg", F.col("kind") != CARRY, F.col("message").asc_nulls_first(),
        F.col("kind") != "regenerate", F.col("seq").asc_nulls_first(), "kind", F.col("role").asc_nulls_first(), "text")

    def run(batches: Iterator) -> Iterator:
        def events() -> Iterator[tuple]:
            for batch in batches:
                for part in text_slices(batch):
                    for conv, seg, *event in zip(*[part.column(c).to_pylist() for c in ("conv", "seg", "message", "seq", "kind", "role", "text")]):
                        yield ((conv, seg), *event)

        def batch_of(parts: list[tuple]):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*parts), types)], names=names)

        last, number, pending, size = None, 0, [], 0
        for part in _render(final_turns(events()), loss_roles, part_chars):
            number, last = (number + 1 if part.conv == last else 0), part.conv
            pending.append((*part.conv, number, part.turns, "".join(part.chunks), part.loss))
            size += part.size
            if size >= 4_000_000 or len(pending) >= 2000:
                yield batch_of(pending)
                pending, size = [], 0
        if pending:
            yield batch_of(pending)

    return placed.mapInArrow(run, f"conv {conv.simpleString()}, seg long, number long, n_turns long, formatted string, "
                                  "loss array<struct<start:long,end:long>>")


def format_conversations(log: DataFrame, conv: str = "conv_id", message: str = "message", seq: str = "seq", kind: str = "kind",
                         role: str = "role", text: str = "text", loss_roles: tuple[str, ...] = ("assistant",),
                         segment: int = 4096, part_chars: int = 1_000_000) -> tuple[DataFrame, DataFrame | None]:
    """Final conversations as formatted parts: ``conv``, ``seg`` and ``number`` (order of the
    parts), ``n_turns``, ``formatted`` and ``loss`` (spans in code points of the part that a
    loss role's escaped text fills).  Returned are the ordinary conversations, whose parts
    follow each other in one partition, and those over ``segment`` events (None without any),
    whose parts lie in several.

    Events (message numbers and sequences are taken as bigints), in order of
    their sequence:

    * ``message`` puts a complete turn at its number; several under one number are turns of
      their own, in order of sequence, role and text;
    * ``delta`` appends to the number's last turn, or opens it;
    * ``edit`` replaces the last turn's text, later turns stay;
    * ``regenerate`` voids all earlier events of its number and of every later number, then
      opens the turn anew; without a role it keeps the voided turn's.

    Rows of other kinds take no part; a null kind is ``message``.  A null role of a later event
    leaves the turn's role, else it is empty, as a null text is.  Null conversations are one
    conversation, null numbers come before all others, null sequences likewise; of events with
    equal sequence regenerations come first, then deltas, edits, messages.  Rows repeated
    altogether count each.  An empty log gives no parts; other columns are ignored.
    """
    slim = log.select(
        column(log, conv).alias("conv"), column(log, message).cast("long").alias("message"), column(log, seq).cast("long").alias("seq"),
        F.coalesce(column(log, kind), F.lit("message")).alias("kind"), column(log, role).alias("role"),
        F.coalesce(column(log, text), F.lit("")).alias("text")).filter(F.col("kind").isin(*KINDS))
    short, long = _segmented(slim, segment)
    roles = frozenset(loss_roles)
    return _formatted(short, roles, part_chars), None if long is None else _formatted(long, roles, part_chars)


def digest_parts(parts: DataFrame) -> DataFrame:
    """One row a conversation, read back from its formatted parts, which must follow each other
    in one partition: ``conv_id``, ``n_turns``, ``turns_sha256``, ``loss_chars``,
    ``loss_sha256``, ``formatted_chars``.  Parts are hashed one after another, none is kept."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    conv_type = to_arrow_type(parts.schema["conv"].dataType)

    def run(batches: Iterator) -> Iterator:
        state, done = None, []

        def close() -> None:
            conv, n, turns, chars, loss, size = state
            done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), (conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            done.clear()
            return out

        for batch in batches:
            for conv, formatted, spans in zip(*[batch.column(c).to_pylist() for c in ("conv", "formatted", "loss")]):
                if state is None or state[0] != conv:
                    if state is not None:
                        close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(formatted):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                for span in spans:
                    text = unescape(formatted[span["start"]:span["end"]])
                    state[3] += len(text)
                    state[4].update(text.encode())
                state[5] += len(formatted)
            if len(done) >= 2000:
                yield flush()
        if state is not None:
            close()
        if done:
            yield flush()

    return parts.select("conv", "formatted", "loss").mapInArrow(
        run, f"conv_id {parts.schema['conv'].dataType.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, "
             "loss_sha256 string, formatted_chars long")


def conversation_digests(short: DataFrame, long: DataFrame | None) -> DataFrame:
    """Digests of all conversations that ``format_conversations`` gave.

    A digest over a whole conversation is sequential by its nature: the rendered parts of a
    long one are sent to one task, sorted, and run through the hash part by part; all other
    work on them is done in the segments.
    """
    out = digest_parts(short)
    if long is None:
        return out
    placed = long.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "seg", "number")
    return out.unionByName(digest_parts(placed))


def op11_chat_format(spark, sf_dir) -> DataFrame:
    """All conversations, a complete message a row, and one whose texts look like marks."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(QUERY_ADVERSARY).alias("text"))
    log = rows.unionByName(extra).select(
        "conv_id", F.col("turn").alias("message"), F.col("turn").alias("seq"), F.lit("message").alias("kind"), "role", "text")
    return conversation_digests(*format_conversations(log))


#: lengths of the template's marks around each turn, roles and texts with their escapes
ORACLE = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
l AS (SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
  length(role) + length(text) + 2 * (length(role || text) - length(translate(role || text, '\<', ''))) - (length(role || text) - length(translate(role || text, '\<', '')))
    + length(role) - length(replace(role, chr(10), '')) AS chars FROM c)
SELECT conv_id::BIGINT AS conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(length(loss))::BIGINT AS loss_chars, sha256(string_agg(loss, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  sum(length('<turn>') + 1 + length('<end>') + 1 + chars)::BIGINT AS formatted_chars FROM l GROUP BY conv_id"""
