"""Word-shuffle BPE: cuts against the pattern, ids against the library, and the round trip."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import regex

from tests.llm import cases
from tidefold.llm import word_bpe
from tidefold.llm.textbytes import buffer_of

RANKS = P.path("byte_bpe_50k.tiktoken")
LIBRARY = word_bpe.tokenizer(RANKS, P.PATTERN)


def _pattern():
    """P.PATTERN with the characters of each class written out, as the library's version of Unicode has them."""
    kinds = word_bpe.classes()

    def members(kind):
        at = np.flatnonzero(kinds == kind)
        runs = np.split(at, np.flatnonzero(np.diff(at) > 1) + 1)
        return "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs)

    letter, number, space = members(word_bpe.LETTER), members(word_bpe.NUMBER), members(word_bpe.SPACE)
    return regex.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


def test_cuts():
    r, pattern = random.Random(5), _pattern()
    parts = ["'", "s", "t", "re", "ve", "m", "ll", "d", " ", "  ", "\n", "\t", "　", "é", "日", "1", "²", ".", "!", "a", "B", "\x85", "🙂",
             "́", "\x1c", "\r", "x" * 50]
    for _ in range(1500):
        texts = [None if r.random() < 0.05 else "".join(r.choice(parts) for _ in range(r.randrange(14))) for _ in range(r.randrange(5))]
        data, at = buffer_of(pa.array(texts, pa.string()))
        start, first = word_bpe.cut(data, at)
        raw, end = data.tobytes(), [*start[1:].tolist(), len(data)]
        got = [[raw[start[i] : end[i]].decode() for i in range(first[k], first[k + 1])] for k in range(len(texts))]
        assert got == [pattern.findall(t or "") for t in texts]


def expected(text):
    return LIBRARY.encode_ordinary(text or "")


@pytest.mark.parametrize("size,chunk", [(1, 1), (20_000, 100), (word_bpe.SLICE, word_bpe.CHUNK)])
def test_cases(spark, size, chunk, monkeypatch):
    """Ids are the library's for every row, with slices of one text and of many."""
    monkeypatch.setattr(word_bpe, "SLICE", size)
    monkeypatch.setattr(word_bpe, "CHUNK", chunk)
    rows = cases.documents()
    encoded = word_bpe.encode(cases.frame(spark, rows), RANKS, P.PATTERN)
    got = sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in word_bpe.decode(encoded, word_bpe.token_bytes(spark, RANKS)).collect()), key=str)
    assert got == sorted(((r[0], expected(r[1]), (r[1] or "").encode()) for r in rows), key=str)


def test_packed(spark):
    rows = [(1, "Hello world"), (2, None), (3, "")]
    encoded = word_bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), RANKS, P.PATTERN)
    got = {r.doc_id: bytes(r.packed) for r in word_bpe.decode(encoded, word_bpe.token_bytes(spark, RANKS), packed=True).collect()}
    assert got == {i: np.array(expected(t), "<u4").tobytes() for i, t in rows}


def test_empty(spark):
    encoded = word_bpe.encode(cases.frame(spark, []), RANKS, P.PATTERN)
    assert word_bpe.decode(encoded, word_bpe.token_bytes(spark, RANKS)).collect() == []


def test_unknown_id(spark):
    with pytest.raises(Exception, match="not in the table"):
        word_bpe.decode(spark.createDataFrame([([1, 99],)], "ids array<int>"), spark.createDataFrame([(1, b"x")], "id int, bytes binary")).collect()


def test_query(spark):
    """The registered query over the whole table."""
    from tests.conftest import SF_DIR
    from tidefold.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = QUERIES["op11_word_bpe"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        ids = expected(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_places_of_a_slice_are_never_whole():
    """A slice is assembled row by row: memory for its places is that of a row."""
    import tracemalloc

    n, rows = 1 << 14, 64
    planes = word_bpe._planes(np.zeros(n, np.int32))
    left = pa.table({"slice": [0] * rows, "chunk": list(range(rows))[::-1], "doc_ids": pa.array([[i] for i in range(rows)][::-1], pa.list_(pa.int64())),
                     "counts": pa.array([[n]] * rows, pa.list_(pa.int32())), "places": pa.array([planes] * rows, pa.binary())})
    one = lambda *v: [word_bpe._planes(np.array(v, np.int32))]
    right = pa.table({"slice": [0], "numbers": one(0), "sizes": one(0), "ids": one()})
    tracemalloc.start()
    got = word_bpe._assembled((0,), left, right)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got["doc_id"].to_pylist() == list(range(rows)) and got["ids"].to_pylist() == [[]] * rows
    assert peak < 4 * n * rows
