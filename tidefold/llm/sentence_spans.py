"""Removal of sentences that lie in repeated runs of consecutive sentences.

A sentence is what stands between two of the characters . ! ? and line ends, without the blanks
(space, tab to carriage return) around it.  Every run of `run` consecutive sentences of a document is hashed; where
`words` is given, so is every run of as few sentences as have that many words, if they are fewer than `run` (equal runs
of more sentences hold equal runs of `run`).  Of equal runs the first by (doc_id, place) stays; the sentences of every later one go, whether it
is in another document or in the same one.

Cases: a null text is empty; texts that hold no run stay whole; rows that repeat a
doc_id follow each other in the order they were read in; a null doc_id comes first; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidefold.llm.exchange import ASKED, Batches, answer, ids_of, joined, question, unique
from tidefold.llm.textbytes import C1, C3, SPACED, buffer_of, hash_spans, mix, shingles, word_spans

RUN = 3
# fixed values: bytes that end a sentence
_STOP = np.zeros(256, bool)
_STOP[[0x2E, 0x21, 0x3F, 0x0A, 0x0D]] = True


class _Runs:
    def __init__(self, table: pa.Table, run: int, words: int | None = None):
        self.number, self.ids = ids_of(table)
        self.data, self.at = buffer_of(table["text"])
        start, end, first = word_spans(self.data, self.at, SPACED & ~_STOP)
        stops = np.concatenate([[0], np.cumsum(_STOP[self.data])])
        new = np.ones(len(start), bool)  # whether a word begins a sentence
        new[1:] = stops[start[1:]] != stops[end[:-1]]
        new[first[:-1][first[1:] > first[:-1]]] = True
        place = np.flatnonzero(new)
        self.start = start[place]
        self.end = end[np.append(place[1:], len(end)) - 1] if len(place) else self.start
        self.first = np.searchsorted(place, first)  # sentence of each text
        sentence = hash_spans(self.data, self.start, self.end)
        count = np.diff(self.first)
        count = np.where(count >= run, count, 0)
        key, begin, doc = shingles(sentence, self.first, run)
        full = count[doc] > 0
        key, self.begin, self.doc = key[full], begin[full], doc[full]
        self.size = np.full(len(key), run)
        if words:
            owner = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
            size = np.searchsorted(np.append(place, len(start)), place + words) - np.arange(len(place))
            few = np.flatnonzero((size < run) & (np.arange(len(place)) + size <= self.first[owner + 1]))
            size, tail = size[few], np.append(sentence, np.zeros(run, np.uint64))
            h = mix(size.astype(np.uint64) + C3)
            for k in range(run - 1):
                h = np.where(k < size, mix(h * C1 + tail[few + k]), h)
            key, self.size = np.append(key, h), np.append(self.size, size)
            self.begin, self.doc = np.append(self.begin, few), np.append(self.doc, owner[few])
        self.keys, self.of = unique(key)
        # the first run of each key in this batch, by document and place
        order = np.lexsort((self.begin, self.number[self.doc], self.of))
        head = np.ones(len(order), bool)
        head[1:] = self.of[order][1:] != self.of[order][:-1]
        self.one = order[head]
        self.nth = self.begin - self.first[self.doc]


def _later(asks: list[list[np.ndarray]]) -> list[tuple]:
    """Whether another batch has an earlier run."""
    _, of = unique(np.concatenate([a[0] for a in asks]))
    sizes = [len(a[0]) for a in asks]
    doc, nth = (np.concatenate([a[i] for a in asks]) for i in (1, 2))
    order = np.lexsort((np.repeat(np.arange(len(asks)), sizes), nth, doc, of))
    late = np.ones(len(order), np.uint8)
    first = np.ones(len(order), bool)
    first[1:] = of[order][1:] != of[order][:-1]
    late[order[first]] = 0
    return [(part,) for part in np.split(late, np.cumsum(sizes)[:-1])]


def dedup_sentences(docs: DataFrame, run: int = RUN, words: int | None = None) -> DataFrame:
    """doc_id, n_sentences, the numbers of the sentences removed (from 0), and the text that is left.

    A sentence goes with what stands behind it, up to the next one.
    """
    batches = Batches.write(docs.select("doc_id", "text"), "sentence-batches")
    buckets = batches.buckets

    def ask(batch: int, table: pa.Table, _) -> dict:
        r = _Runs(table, run, words)
        return question(batch, buckets, r.keys, r.number[r.doc[r.one]], r.nth[r.one].astype(np.int64))

    def remove(batch: int, table: pa.Table, got: dict) -> dict:
        r = _Runs(table, run, words)
        late = joined(got[0], kind="u1") > 0
        gone = late[r.of] if len(r.of) else np.zeros(0, bool)
        here = np.ones(len(r.of), bool)
        here[r.one] = False
        begin, size = r.begin[gone | here], r.size[gone | here]
        step = np.zeros(len(r.start) + 1, np.int64)
        np.add.at(step, begin, 1)
        np.add.at(step, begin + size, -1)
        out = np.cumsum(step[:-1]) > 0
        # a sentence goes with all that stands before the next one of its text, or the text's end
        stop = np.append(r.start[1:], len(r.data)) if len(r.start) else r.start
        last = r.first[1:][r.first[1:] > r.first[:-1]] - 1
        stop[last] = r.at[1:][r.first[1:] > r.first[:-1]]
        edge = np.zeros(len(r.data) + 1, np.int32)
        np.add.at(edge, r.start[out], 1)
        np.add.at(edge, stop[out], -1)
        keep = np.cumsum(edge[:-1]) == 0
        left = np.concatenate([[0], np.cumsum(keep)])[r.at].astype(np.int64)
        text = pa.Array.from_buffers(
            pa.large_string(), len(r.ids), [None, pa.py_buffer(left), pa.py_buffer(r.data[keep])]
        ).cast(pa.string())
        bare = np.flatnonzero(out)
        cuts = np.searchsorted(bare, r.first)
        nth = bare - np.repeat(r.first[:-1], np.diff(cuts))
        removed = pa.ListArray.from_arrays(cuts.astype(np.int32), pa.array(nth, pa.int64()))
        return {"doc_id": r.ids, "n_sentences": np.diff(r.first), "removed": removed, "text": text}

    later = batches.keep(answer(batches.each(ask, ASKED), _later), "sentence-runs")
    return batches.each(remove, "doc_id long, n_sentences long, removed array<long>, text string", later)
