"""The corpus pipeline against a brute-force version of its stages."""

import zlib

import numpy as np
import public_tokenizers

import corpus_pipeline
from landframe.llm import pii, surrogates
from landframe.llm.token_counts import load_tokenizer
from tests.llm.test_duplicates_pii_toxicity import brute_join
from tests.llm.test_scans import brute_measures, brute_overlap

SF = "/root/testdata/sf0.001"


def brute_pipeline(docs, items):
    measured = {i: brute_measures(t) for i, t in docs.items()}
    docs = {i: t for i, t in docs.items() if measured[i][0] >= 50 and 100 * measured[i][4] <= 50 * measured[i][0]}
    ids = sorted(docs)
    docs = {i: docs[i] for i, c in zip(ids, brute_join([docs[i] for i in ids])) if c[0] == ids.index(i)}
    contaminated = {i for i, t in docs.items() if brute_overlap(t, items)[1]}
    return docs, contaminated


def test_pipeline_as_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r["doc_id"]: r["text"] for r in table.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    kept, contaminated = brute_pipeline(docs, items)
    stage = table
    for name, f in corpus_pipeline.STAGES[:4]:
        stage = f(spark, stage, SF)
        assert stage.columns == table.columns, name
    texts = {r["doc_id"]: r["text"] for r in stage.collect()}
    assert set(texts) == set(kept)  # at this size no host is bad and no document is all benchmark
    changed = {i for i in kept if texts[i] != kept[i]}
    assert changed == contaminated | {i for i, t in kept.items() if surrogates.find_entities(t)}
    assert not any(brute_overlap(texts[i], items)[1] for i in contaminated)
    for i in changed - contaminated:
        old = [s[2:] for s in surrogates.find_entities(kept[i])]
        new = [s[2:] for s in surrogates.find_entities(texts[i])]
        assert [k for k, _ in old] == [k for k, _ in new] and not {n for k, n in old if k != "given"} & {n for _, n in new}
    tok = load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: np.array(tok.encode(t, add_special_tokens=False).ids + [0], "<u4") for i, t in texts.items()}
    out = corpus_pipeline.run(spark, SF).toPandas()
    assert set(out["doc_id"]) == set(want) and out["length"].sum() == sum(map(len, want.values()))
    for r in out.itertuples():
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start:r.start + r.length].tobytes())
    assert (out.groupby("sequence_id")["length"].sum() <= 1024).all()


def test_stages_on_odd_tables(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    odd = table.limit(30).unionByName(spark.createDataFrame([(None, None, None, None, None), (1, "", None, "s", 0)], table.schema)).unionByName(table.limit(3))
    for docs in (odd, odd.limit(0)):
        for _, f in corpus_pipeline.STAGES:
            f(spark, docs, SF).count()
    assert corpus_pipeline.ORACLE_SQL is None and pii.QUERY_KEY
