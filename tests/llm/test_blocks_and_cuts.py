"""Blocks bounded by shingles, white-space cuts, and hosts judged against the prior."""

import random

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from landframe.llm import near_duplicates, packing, quality_rules, shingles, token_counts

WORD = public_tokenizers.path(token_counts.QUERY_VOCABULARY)
BYTE = public_tokenizers.path(packing.QUERY_VOCABULARY)


def test_white_space_rule_is_tried_on_the_file():
    assert token_counts.blanks_split(WORD) and not token_counts.blanks_split(BYTE)


def test_lines_of_one_word_are_cut():
    text = "word\n" * 200_000
    parts = token_counts.split_at_blanks(text, 16_384)
    assert "".join(parts) == text and max(map(len, parts)) < 17_000
    assert token_counts.token_lengths([text], WORD, 16_384, 500_000) == [200_000]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "Zoë", "e", "́", "7", "'s", "<|endoftext|>", "!", " ", "\n", "\t", "\r\n", "\x0b", "漢", " ", "ς", "Σ"]), max_size=60), st.integers(1, 8))
def test_cut_texts_count_as_whole_ones(parts, piece):
    text = "".join(parts)
    tok = token_counts.load_tokenizer(WORD)
    assert token_counts.token_lengths([text], WORD, piece, 50) == [len(tok.encode(text, add_special_tokens=False))]
    assert token_counts.token_lengths([text], BYTE, piece, 50) == [len(token_counts.load_tokenizer(BYTE).encode(text, add_special_tokens=False))]


def brute_links(texts):
    sets = [set(shingles.shingle_set(t).tolist()) for t in texts]
    return {(i, j) for i in range(len(sets)) for j in range(len(sets)) if i != j and sets[i] != sets[j] and sets[i] and
            len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}


def test_blocks_of_long_texts(spark, monkeypatch):
    """Groups cut by their shingles, with repeated rows of a long text, lose no link."""
    rng = random.Random(7)
    base = [f"w{rng.randrange(5000)}" for _ in range(20_000)]
    texts = [" ".join(base)]
    for i in range(11):
        words = list(base)
        for _ in range(60 + 30 * i):
            words[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
        texts.append(" ".join(words))
    texts += ["other words " * 50, "short"]
    want = brute_links(texts)
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])] * 20 + [(50, texts[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for limit in (10_000, 2_000_000):
        monkeypatch.setattr(near_duplicates, "BLOCK_SHINGLES", limit)
        got = near_duplicates.jaccard_join(df).collect()
        assert len(got) == len(rows)
        assert {r["doc_id"]: r["n_links"] for r in got if r["doc_id"] < 14} == {i: sum(a == i for a, _ in want) for i in range(14)}
        assert len({r["class_id"] for r in got}) == 3 and {r["copy_of"] for r in got if r["doc_id"] in (4, 50)} == {4}


def test_small_hosts_are_not_condemned(spark):
    """The verdict is the posterior's: two of three failures are no proof, 120 of 300 are."""
    good, symbols = " ".join(f"w{i}" for i in range(80)), " ".join(f"w{i}#" for i in range(80))
    rows = [(f"host{h}", symbols if i < 3 else good) for h in range(20) for i in range(100)]
    rows += [("tiny", symbols)] * 2 + [("tiny", good)] + [("junk", symbols)] * 120 + [("junk", good)] * 180
    docs = spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string")
    out = quality_rules.judge_documents(docs).toPandas()
    assert set(out[out.host_rejected].host) == {"junk"} and out.host_rejected.sum() == 120 and len(out[~out.kept]) == 120
    shrunk = {h: g.rates.iloc[0]["symbols"] for h, g in out.groupby("host")}
    mean, strength = shrunk["tiny"]["mean"], shrunk["tiny"]["strength"]
    assert abs(mean - 182 / 2303) < 1e-12
    assert abs(shrunk["tiny"]["shrunk"] - (2 + mean * strength) / (3 + strength)) < 1e-12


def test_hot_buckets_lose_no_link(spark):
    """Texts of all lengths around one common passage: every bucket of it is hot."""
    rng = random.Random(3)
    passage = " ".join(f"c{i}" for i in range(30))
    texts = []
    for i in range(150):
        own = " ".join(f"t{i}x{j}" for j in range(rng.randrange(0, 90)))
        texts.append(f"{passage} {own}")
        if i % 3 == 0:
            texts.append(f"{passage} {own} tail{i}")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = brute_links(texts)
    for bucket in (5, 40, 2048):
        got = {r["doc_id"]: r["n_links"] for r in near_duplicates.jaccard_join(df, bucket=bucket).collect()}
        assert got == {i: sum(a == i for a, _ in want) for i in range(len(texts))}
