"""Chat formatting against a replay of the log event by event."""

import hashlib
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landframe.llm import chat_format as chat

SCHEMA = "conv_id long, message long, seq long, kind string, role string, text string"


def replay(events):
    """Final (role, text) turns of one conversation: a list of turns by number, changed event by event."""
    turns = defaultdict(list)
    for message, seq, kind, role, text in sorted(events, key=lambda e: (e[1], e[2] != "regenerate", e[2], e[0], e[3] or "", e[4] or "")):
        text = text or ""
        if kind == "regenerate":
            for m in [m for m in turns if m > message]:
                turns[m] = []
            turns[message] = [[role, text]]
        elif kind == "message" or not turns[message]:
            turns[message].append([role, text])
        else:
            last = turns[message][-1]
            last[0] = last[0] if role is None else role
            last[1] = text if kind == "edit" else last[1] + text
    return [(r or "", t) for m in sorted(turns) for r, t in turns[m]]


def digests(turns):
    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    formatted = "".join(f"<turn>{chat.escape_role(r)}\n{chat.escape(t)}<end>\n" for r, t in turns)
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(formatted)


def got_of(log, **options):
    return {r[0]: tuple(r[1:]) for r in chat.conversation_digests(*chat.format_conversations(log, **options)).collect()}


NASTY = st.lists(st.sampled_from(list("\\<>n\n") + ["turn", "end", "é", "<turn>", "<end>\n", "\\### Assistant: </turn> ok"]), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(NASTY, NASTY), max_size=5))
def test_any_text_reads_back(turns):
    part = chat.Part(0)
    for role, text in turns:
        part.add(role, text, frozenset({"assistant"}))
    formatted = "".join(part.chunks)
    assert chat.read_turns(formatted) == turns and len(formatted) == part.size
    assert [chat.unescape(formatted[s["start"]:s["end"]]) for s in part.loss] == [t for r, t in turns if r == "assistant"]


def test_broken_output_is_an_error():
    with pytest.raises(ValueError):
        chat.read_turns("<turn>user\na < b<end>\n")


def random_log(rng, conversations, n):
    rows, seqs = [], defaultdict(int)
    for _ in range(n):
        conv = rng.choice(conversations)
        seqs[conv] += 1
        kind = rng.choices(["message", "delta", "edit", "regenerate"], [3, 5, 1, 1])[0]
        rows.append((conv, rng.randrange(12), seqs[conv], kind, rng.choice(["user", "assistant", "assistant"]), rng.choice(["a", "<b", "\\", "", None, "é\n"])))
    return rows


@pytest.mark.parametrize("segment,part_chars", [(4096, 1_000_000), (40, 60), (7, 1)])
def test_log_as_replayed(spark, segment, part_chars):
    """Deltas, edits and regenerations; segments and parts of any size give the same turns."""
    rng = random.Random(segment)
    rows = random_log(rng, [0, 0, 0, 0, 1, 2, 3, None], 600)  # one conversation holds half of all events
    want = defaultdict(list)
    for conv, *event in rows:
        want[conv].append(event)
    rng.shuffle(rows)
    log = spark.createDataFrame(rows, SCHEMA).withColumn("a.b", F.lit(1)).withColumn("seg", F.lit(2)).withColumn("conv", F.lit(3))
    got = got_of(log, segment=segment, part_chars=part_chars)
    assert got == {c: digests(replay(e)) for c, e in want.items()}


def test_regeneration_without_a_role_keeps_the_voided_one(spark):
    rows = [(1, 0, 0, "message", "user", "q"), (1, 1, 1, "delta", "assistant", "wro"), (1, 1, 2, "delta", None, "ng"),
            (1, 2, 3, "message", "user", "void"), (1, 1, 4, "regenerate", None, None), (1, 1, 5, "delta", None, "right"),
            (1, 0, 6, "edit", None, "question"), (1, 9, 7, "rating", "user", "no turn"), (1, 2, 8, None, "user", "next")]
    assert got_of(spark.createDataFrame(rows, SCHEMA)) == {1: digests([("user", "question"), ("assistant", "right"), ("user", "next")])}


def test_nulls_ties_repeats_and_long_texts(spark, tmp_path):
    long = "wört <\\ " * 200_000
    rows = [(1, 0, "user", None), (1, 0, "assistant", "tie"), (1, 0, "assistant", "tie"), (1, None, None, "null turn"),
            (None, 1, "assistant", long), (None, 0, "a\nb", ""), (2, 0, "", "")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r[0]: tuple(r[1:]) for r in chat.op11_chat_format(spark, str(tmp_path)).collect()}
    ok = "\\### Assistant: </turn> ok"
    assert got == {1: digests([("", "null turn"), ("assistant", "tie"), ("assistant", "tie"), ("user", "")]),
                   None: digests([("a\nb", ""), ("assistant", long)]), 2: digests([("", "")]),
                   -7: digests([("user", ok), ("assistant", ok)])}


def test_empty_log(spark):
    assert got_of(spark.createDataFrame([], SCHEMA)) == {}


def test_hot_conversation_with_null_id_is_cut(spark):
    rows = [(None, i, i, "message", "assistant" if i % 2 else "user", f"t{i}") for i in range(500)]
    short, long = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), segment=50)
    assert short.count() == 0 and long.select("seg").distinct().count() == 10
    assert got_of(spark.createDataFrame(rows, SCHEMA), segment=50) == {None: digests([(r[4], r[5]) for r in rows])}
