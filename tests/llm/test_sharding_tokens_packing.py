"""Rendezvous sharding, token counts and packing against brute force and exact round trips."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landframe.llm import packing, sharding, token_counts

WORD = public_tokenizers.path(token_counts.QUERY_VOCABULARY)
BYTE = public_tokenizers.path(packing.QUERY_VOCABULARY)
TEXTS = ["", None, "a b  c", "Hello,   World!\n\nIt's 2024 — naïve café", "x" * 5000, "word " * 4000, "<|endoftext|> a<|startoftext|>", "a b  c", " ", "́ x ́"]


def table(spark, texts=TEXTS, ids=None):
    rows = [(None if i == 7 else i, t, i, "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, `row` int, `doc.id` string")


def brute_shard(key, weights):
    key = "-" if key is None else f"{len(str(key))}:{key}"
    best = None
    for s, w in enumerate(weights):
        digest = hashlib.md5(f"{key}#{s // 4}".encode()).hexdigest()
        u = (int(digest[8 * (s % 4):8 * (s % 4) + 8], 16) + 0.5) / 2 ** 32
        if w > 0:
            best = min(best or (math.inf, 0), (-math.log(u) / w, s))
    return best[1]


@pytest.mark.parametrize("weights", [[1.0] * 40, [1.0, 0.0, 3.0, 2.5, 0.1], [1.0]])
def test_shards_as_brute_force(spark, weights):
    df = spark.range(300).withColumn("k", F.when(F.col("id") > 4, F.col("id")))
    got = {(r["k"], r["shard"]) for r in df.select("k", sharding.rendezvous_shard(sharding.record_key([F.col("k")]), weights).alias("shard")).collect()}
    assert got == {(k, brute_shard(k, weights)) for k, _ in got}


def test_shards_follow_weights_and_grow_only_into_the_new_one(spark):
    df = spark.range(20000).select(F.col("id").alias("doc_id"))
    out = sharding.shard_records(df, ["doc_id"], [1.0, 2.0, 1.0], {"doc_id": F.col("doc_id")}, [1.0, 2.0, 1.0, 1.0]).toPandas()
    share = out.groupby("shard").size() / len(out)
    assert abs(share[1] - 0.5) < 0.02
    moved = out[out["shard"] != out["grown_shard"]]
    assert (moved["grown_shard"] == 3).all() and abs(len(moved) / len(out) - 0.2) < 0.02


def test_slots_are_gapless_with_repeated_null_and_hot_keys(spark):
    df = spark.range(0, 5000, 1, 7).select(F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 7 > 0, F.col("id")).alias("doc_id"), F.lit(1).alias("slot"))
    out = sharding.shard_records(df, ["doc_id"], [1.0] * 8, {"doc_id": F.col("doc_id")}).toPandas()
    assert len(out) == 5000 and out["grown_shard"].isna().all()
    assert out.groupby(out["doc_id"].fillna(-1))["shard"].nunique().max() == 1
    for _, slots in out.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))
    assert sharding.shard_records(df.limit(0), ["doc_id"], [1.0], {"doc_id": F.col("doc_id")}).count() == 0


def test_query_columns(spark):
    out = sharding.op8_sharding(spark, "/root/testdata/sf0.001").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").toPandas().set_index("doc_id")["text"]
    for r in out.itertuples():
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert r.shard == brute_shard(r.doc_id, [1.0] * 40) and r.grown_shard in (r.shard, 40)


def test_token_counts_as_whole_texts(spark):
    tok = token_counts.load_tokenizer(WORD)
    got = token_counts.count_tokens(table(spark), WORD, limit=100, piece=64, batch_bytes=200).toPandas()
    want = [len(tok.encode(t or "", add_special_tokens=False).ids) for t in TEXTS]
    assert got["n_tokens"].tolist() == want and got["over_limit"].tolist() == [n > 100 for n in want]
    assert got["n_bytes"].tolist() == [len((t or "").encode()) for t in TEXTS]
    assert token_counts.count_tokens(table(spark).limit(0), WORD).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list(" \n\t.'s<|>aé́ 한")), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_splitting_at_blanks_keeps_the_count(text):
    tok = token_counts.load_tokenizer(WORD)
    assert token_counts.token_lengths([text], WORD, 4, 50) == [len(tok.encode(text, add_special_tokens=False).ids)]
    assert "".join(token_counts.split_at_blanks(text, 4)) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([" ", "  ", "\n", "a", "'s", "It's", "9", "<|endoftext|>", "\x1c", "\x85", "\xa0", "é", "́"]), st.characters(exclude_categories=["Cs"])), max_size=20))
def test_ids_as_the_tokenizers_library_gives_them(parts):
    text = "".join(parts)
    assert packing.id_encoder(BYTE)(text) == token_counts.load_tokenizer(BYTE).encode(text, add_special_tokens=False).ids
    assert packing.id_encoder(WORD)(text) == token_counts.load_tokenizer(WORD).encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60), st.integers(20, 33))
def test_best_fit_as_brute_force(lengths, window):
    lengths = sorted(lengths, reverse=True)
    where, offset = packing.best_fit_decreasing(lengths, window)
    room = []
    for n, w, o in zip(lengths, where, offset):
        fit = [r for r in room if r >= n]
        if fit:  # the tightest open window, whichever of equals
            assert room[w] == min(fit)
        else:
            assert w == len(room)
            room.append(window)
        assert o == window - room[w]
        room[w] -= n


def test_packing_round_trip(spark):
    random.seed(3)
    texts = TEXTS + [" ".join(random.choices(["alpha", "beta", "gam ma", "é"], k=random.randint(1, 400))) for _ in range(200)]
    out = packing.pack_documents(table(spark, texts), BYTE, window=128, pieces_per_task=60).toPandas()
    tok = token_counts.load_tokenizer(BYTE)
    want = set()
    for i, t in enumerate(texts):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for s in range(0, len(ids), 128):
            want.add((None if i == 7 else i, s, len(ids[s:s + 128]), zlib.crc32(ids[s:s + 128].tobytes()), len(ids)))
    got = [(None if np.isnan(r.doc_id) else int(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out.itertuples()]
    assert len(got) == len(want) and set(got) == want
    for _, seq in out.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert seq["offset"].tolist() == [0, *seq["length"].cumsum().tolist()[:-1]] and seq["length"].sum() <= 128
    assert out["sequence_id"].nunique() <= 1.1 * out["length"].sum() / 128
    assert packing.pack_documents(table(spark).limit(0), BYTE).count() == 0
