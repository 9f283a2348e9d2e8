import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from tests.llm import cases
from tidefold.llm import simple8b as B
from tidefold.llm.queries import tokenizer_path
from tidefold.llm.textbytes import buffer_of


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=700))
def test_words_round_trip(values):
    v = np.array(values, np.uint64)
    words, offset, escapes = B.encode(v)
    assert B.decode(words, offset, escapes, len(v)).tolist() == values
    assert len(offset) == -(-len(v) // B.GROUP)


def test_words_are_dense():
    words, _, _ = B.encode(np.zeros(12_800, np.uint64))
    assert len(words) == 200
    words, _, _ = B.encode(np.full(1280, 1000, np.uint64))
    assert len(words) == 220  # six of ten bits a word, 22 words a group


def test_groups_decode_alone():
    v = np.random.default_rng(0).integers(0, 50_000, 1000).astype(np.uint64)
    words, offset, escapes = B.encode(v)
    a, z = offset[3], offset[4]
    assert (B.decode(words[a:z], np.zeros(1, np.uint32), escapes, 128) == v[384:512]).all()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab .1'sé  　日\n\t\x1c\x85🙂"), max_size=14), max_size=4))
def test_pieces_give_the_ids_of_whole_texts(texts):
    ids, size = ENCODER(*buffer_of(pa.array(texts, pa.string())))
    at = np.concatenate([[0], np.cumsum(size)])
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]


TOKENIZER, ENCODER = tokenizer(), B.Encoder(tokenizer_path())


def test_files(spark):
    folder = B.new_folder(spark)
    B.write(cases.frame(spark), folder, tokenizer_path(), block_ids=300)
    got = B.read(spark, folder).orderBy("start").collect()
    rows = [(i, TOKENIZER.encode(t or "", add_special_tokens=False).ids + [0]) for i, t, *_ in cases.documents()]
    number = lambda i: -(2**63) if i is None else i
    assert [number(r.doc_id) for r in got] == sorted(number(i) for i, _ in rows)
    assert sorted((str(r.doc_id), list(r.ids)) for r in got) == sorted((str(i), x) for i, x in rows)
    total = 0
    for r in got:
        assert (r.start, r.n_tokens) == (total, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        total += len(r.ids)
    empty = B.new_folder(spark)
    B.write(cases.frame(spark, []), empty, tokenizer_path())
    assert B.read(spark, empty).collect() == []
