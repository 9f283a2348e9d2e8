"""The registered queries, and the pipeline against plain versions of its stages."""

import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.compare import connect, differences
from tests.conftest import SF_DIR
from tests.llm import cases
from tests.llm.test_near_duplicates import expected as groups
from tests.llm.test_token_ids import TOKENIZER
from tidefold.llm import entropy_mix, queries, toxic_chain


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLES[name]) is None


def test_all_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert set(queries.ORACLES) <= set(entry.oracle_sql())


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "minhash near-dedup", "benchmark decontamination", "mixing sources", "token ids"]
    rows = {r.doc_id: r for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        before = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "toxicity":
            labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
            scores = {r.doc_id: r.p_toxic for r in toxic_chain.predict(docs, toxic_chain.train(docs, labels)).collect()}
            assert {r.doc_id for r in out.collect()} == {i for i, p in scores.items() if p < toxic_chain.REJECT}
            assert out.count() < docs.count()
        elif name == "minhash near-dedup":
            assert {r.doc_id for r in out.collect()} == {i for i, c in groups(before) if i == c}
        elif name == "benchmark decontamination":
            items = [cases.alnum(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            windows = {tuple(w[j : j + min(10, len(w))]) for w in items for j in range(max(len(w) - 9, 1)) if w}
            sizes = {len(w) for w in windows}
            hit = {i for i, t in before for w in [cases.alnum(t)] for n in sizes for j in range(len(w) - n + 1) if tuple(w[j : j + n]) in windows}
            assert {r.doc_id for r in out.collect()} == {i for i, _ in before} - hit
        elif name == "mixing sources":
            copies = {r.doc_id: r.copies for r in entropy_mix.mix(docs).select("doc_id", "mix.copies").collect()}
            have = {}
            for r in out.collect():
                assert r == rows[r.doc_id]
                have[r.doc_id] = have.get(r.doc_id, 0) + 1
            assert have == {i: c for i, c in copies.items() if c}
        else:
            total = 0
            got = sorted((tuple(r) for r in out.select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
            assert sorted(r[1] for r in got) == sorted(i for i, _ in before)
            for start, i, n, crc in got:
                ids = TOKENIZER.encode(rows[i].text or "", add_special_tokens=False).ids + [0]
                assert (start, n, crc) == (total, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
                total += n
        docs = out
