import tracemalloc

import numpy as np
import pyarrow as pa

from tests.llm import cases
from tidefold.llm import probminhash, simple8b, toxic_chain
from tidefold.llm.decontaminate import Lookup
from tidefold.llm.queries import tokenizer_path
from tidefold.llm.textbytes import freed


def batch():
    texts = [f"{k} {cases.words(600, k % 40)}" for k in range(2400)]
    n = pa.array(range(len(texts)), pa.int64())
    return pa.RecordBatch.from_pydict({"doc_id": n, "text": pa.array(texts), "text_hash": n})


def peak(run) -> float:
    """MB that Python and numpy hold at most, besides the input."""
    tracemalloc.start()
    try:
        for _ in run():
            pass
        return tracemalloc.get_traced_memory()[1] / 2**20
    finally:
        tracemalloc.stop()


def test_workers_stay_small():
    """The stages of the pipeline share idle workers, so that each keeps what its largest step took."""
    part = batch()
    assert part.nbytes > 7 << 20
    assert peak(lambda: probminhash._signed(iter([part]))) < 50
    known = np.sort(np.random.default_rng(0).integers(0, 2**63, 300).astype(np.uint64))
    models = [toxic_chain.Linear(np.zeros(304 + k), np.ones(304 + k), np.zeros(304 + k), 0.0) for k in range(2)]
    chain = toxic_chain.Chain(["a", "b"], known, models)
    assert peak(lambda: toxic_chain._scored(part, chain, Lookup(known))) < 50


def test_freed_gives_all_rows():
    parts = [batch().slice(0, 3), batch().slice(3, 4)]
    assert [p.num_rows for p in freed(lambda p: p)(iter(parts))] == [3, 4]


def test_other_steps_drop_the_tokenizer():
    kept = simple8b.encoder(tokenizer_path())
    list(freed(lambda p: p, keep=True)(iter([batch()])))
    assert simple8b.encoder(tokenizer_path()) is kept
    list(freed(lambda p: p)(iter([batch()])))
    assert simple8b.encoder.cache_info().currsize == 0
