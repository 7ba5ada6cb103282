"""Each stage on what its predecessor kept, against plain versions."""

import hashlib

import numpy as np
import tiktoken
from test_decontaminate import brute_force as leaks_of
from test_neardup import brute_force as groups_of

import corpus_pipeline
from tidegrid.llm import bpe
from tidegrid.session import materialise

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark, documents):
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, SF_DIR), f"test-{name}")
        if name != "byte_bpe":
            assert out.columns == documents.columns
            assert out.subtract(docs).count() == 0
            kept[name] = {r["doc_id"]: r["text"] for r in out.collect()}
            docs = out
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    everything = {r["doc_id"]: r["text"] for r in documents.collect()}
    # labelled junk goes, labelled good texts of some length stay
    assert not any(i in labels and labels[i]["quality"] == 0 for i in kept["quality"])
    assert all(i in kept["quality"] for i, t in everything.items() if i in labels and labels[i]["quality"] == 1 and len(t.split()) >= 50)
    seen = [i for i in kept["quality"] if i in labels]
    assert np.mean([(i in kept["toxicity"]) == (labels[i]["toxic"] == 0) for i in seen]) > 0.95
    groups = groups_of(kept["toxicity"].items())
    assert set(kept["near_dedup"]) == set(groups.values())
    bench = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    leaked = {d for d, _ in leaks_of(kept["near_dedup"].items(), bench)}
    assert set(kept["decontamination"]) == set(kept["near_dedup"]) - leaked
    path, pattern = bpe.multilingual()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load(path, pattern).ranks, special_tokens={})
    got = {r["doc_id"]: r for r in out.collect()}
    assert set(got) == set(kept["decontamination"])
    for i, text in kept["decontamination"].items():
        ids = library.encode_ordinary(text)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_empty_corpus(spark, documents):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF_DIR), "test-empty")
    assert docs.collect() == [] and "ids_sha256" in docs.columns
