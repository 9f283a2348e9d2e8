"""Removal of long byte strings that an earlier document holds too, by sorting suffixes.

Every byte covered by a string of `length` bytes that also starts in a document with a
smaller id goes.  Strings are judged on the input, overlaps count, matches do not cross
documents.  The result is exact:

1. Each string contains exactly one anchor: the place of its least 20-byte hash (the
   leftmost one).  Equal strings have equal anchors at equal places, so a string can
   repeat only where its anchor does.  Batches ask for each distinct anchor whether
   another document holds it.
2. For anchors that do, batches send the span of strings around them, each distinct span
   once with its smallest document id.  The bucket that owns the anchor sorts the suffixes
   of the spans deep-shallow: multikey sorting by 8-byte symbols to a shallow depth, then
   blind tries for groups with longer common prefixes.  Suffixes that agree in `length`
   bytes are one string; the smallest id among them is where it starts first.
3. Batches mark the bytes.

Cases: a null text is empty; texts shorter than `length` stay whole; rows that repeat a
doc_id are one document's, none is smaller; a null doc_id comes before all others; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidefold.llm.exchange import ASKED, Batches, answer, bounds, ids_of, joined, pack, question, unique
from tidefold.llm.textbytes import C1, C2, C3, buffer_of, hash_spans, mix, padded, ragged

LENGTH = 50
GRAM = 20
SHALLOW = 32
_BLOCK = 1 << 15
_LOW, _HIGH = np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF00000000)


# -- anchors ------------------------------------------------------------------------


def _gram_hashes(eight: np.ndarray, four: np.ndarray, a: int, z: int) -> np.ndarray:
    """A hash of the 20 bytes from each of the places a to z."""
    h = eight[a:z] * C1
    h ^= h >> np.uint64(32)
    h += eight[a + 8 : z + 8] * C2
    h ^= h >> np.uint64(29)
    h *= C3
    h += four[a + 16 : z + 16].astype(np.uint64) * C1
    h ^= h >> np.uint64(32)
    h *= C2
    return h


def anchors(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of strings with one anchor: first start, end of starts, anchor's hash, text."""
    none = np.zeros(0, np.int64)
    total = len(data) - length + 1
    if total <= 0:
        return none, none, none.astype(np.uint64), none
    raw = padded(data).tobytes()
    eight = np.ndarray((len(data) + 1,), "<u8", raw, strides=(1,))
    four = np.ndarray((len(data) + 5,), "<u4", raw, strides=(1,))
    want = length - GRAM + 1
    low = np.arange(_BLOCK + want, dtype=np.uint64)
    firsts, keys, last = [], [], -1
    for a in range(0, total, _BLOCK):  # blocks that stay in the processor's cache
        z = min(a + _BLOCK, total)
        hashes = _gram_hashes(eight, four, a, z + want - 1)
        least = (hashes & _HIGH) | low[: len(hashes)]
        wide = 1
        while wide < want:  # the least of `want` in a row
            step = min(wide, want - wide)
            least = np.minimum(least[:-step], least[step:])
            wide += step
        place = least.astype(np.uint32)
        new = np.empty(len(place), bool)
        new[0] = int(place[0]) + a != last
        np.not_equal(place[1:], place[:-1], out=new[1:])
        first = np.flatnonzero(new)
        firsts.append(first + a)
        keys.append(mix(hashes[place[first]]))  # least hashes are small: spread them over all buckets
        last = int(place[-1]) + a
    # runs end where texts do: the last strings of a text start `length` bytes before its end
    first, key = np.concatenate(firsts), np.concatenate(keys)
    long = np.diff(at) >= length
    begin, stop = at[:-1][long], at[1:][long] - length + 1
    of = np.searchsorted(first, begin, "right") - 1
    first, key = np.concatenate([first, begin]), np.concatenate([key, key[of]])
    order = np.argsort(first, kind="stable")
    first, key = first[order], key[order]
    kept = np.append(first[1:] != first[:-1], True)
    first, key = first[kept], key[kept]
    doc = np.searchsorted(begin, first, "right") - 1
    kept = (doc >= 0) & (first < stop[doc])
    end = np.minimum(np.append(first[1:], total)[kept], stop[doc[kept]])
    return first[kept], end, key[kept], np.flatnonzero(long)[doc[kept]]


def _least(groups: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
    out = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(out, groups, values)
    return out


def distinct_spans(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class of each span, one span of each class): spans are in one class if their bytes are equal."""
    for seed in itertools.count():
        keys, group = unique(hash_spans(data, first, first + size, seed))
        one = np.empty(len(keys), np.int64)
        one[group] = np.arange(len(first))
        same = size == size[one[group]]
        if same.all() and _equal(data, first, first[one[group]], size):
            return group, one


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> bool:
    other = a != b
    for k in range(0, len(a), 1 << 17):
        m = np.flatnonzero(other[k : k + (1 << 17)]) + k
        if not np.array_equal(data[ragged(a[m], size[m])], data[ragged(b[m], size[m])]):
            return False
    return True


# -- deep-shallow sorting -------------------------------------------------------------


class BlindTrie:
    """Suffixes of one length in order; nodes keep only the place where they branch."""

    def __init__(self):
        self.root = None

    def add(self, text: bytes, name: int) -> None:
        if self.root is None:
            self.root = [text, [name]]
            return
        node = self.root
        while len(node) == 3:  # blind: only branching bytes are looked at
            place, children, _ = node
            node = children.get(text[place]) or next(iter(children.values()))
        seen = node[0]
        if text == seen:
            node[1].append(name)
            return
        lcp = _common(text, seen)
        up, key, node = None, None, self.root
        while len(node) == 3 and node[0] < lcp:
            up, key = node, text[node[0]]
            node = node[1][key]
        leaf = [text, [name]]
        if len(node) == 3 and node[0] == lcp:
            node[1][text[lcp]] = leaf
            return
        branch = [lcp, {seen[lcp]: node, text[lcp]: leaf}, None]
        if up is None:
            self.root = branch
        else:
            up[1][key] = branch

    def groups(self) -> list[list[int]]:
        """Names of equal suffixes together, in order."""
        out, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if len(node) == 2:
                out.append(node[1])
            else:
                stack += [node[1][k] for k in sorted(node[1], reverse=True)]
        return out


def _common(a: bytes, b: bytes) -> int:
    x = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return len(a) - (x.bit_length() + 7) // 8


def deep_shallow(data: np.ndarray, starts: np.ndarray, length: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes at `starts` by their first `length` bytes: (order, rank of each in that order).

    Equal suffixes have equal rank.  The shallow phase partitions all open groups at once by
    their next 8-byte symbol, as multikey quicksort does with single symbols; groups still
    open at the shallow depth are finished by a blind trie each, unless all their members agree.
    """
    view = np.lib.stride_tricks.sliding_window_view(padded(data, max(length, 8)), 8)

    def symbol(which: np.ndarray, depth: int) -> np.ndarray:
        x = np.ascontiguousarray(view[starts[which] + depth]).view(">u8").ravel().astype(np.uint64)
        left = length - depth
        return x if left >= 8 else x & ~np.uint64((1 << (8 * (8 - left))) - 1)

    n = len(starts)
    order = np.arange(n)
    head = np.zeros(n, np.int64)  # where the group of each place in the order begins
    open_ = np.arange(n)  # places in groups of more than one
    for depth in range(0, min(shallow, length), 8):
        if not len(open_):
            break
        s = symbol(order[open_], depth)
        by = np.argsort(s)
        if depth:  # by group, then symbol
            nth = np.empty(len(s), np.int64)
            nth[by] = np.cumsum(np.append(0, s[by][1:] != s[by][:-1]))
            by = np.argsort((head[open_] << 32) | nth)
        order[open_], s, h = order[open_][by], s[by], head[open_][by]
        new = np.ones(len(open_), bool)
        new[1:] = (s[1:] != s[:-1]) | (h[1:] != h[:-1])
        start = open_[new]
        head[open_] = np.repeat(start, np.diff(np.append(np.flatnonzero(new), len(open_))))
        many = np.bincount(np.cumsum(new) - 1) > 1
        open_ = open_[many[np.cumsum(new) - 1]]
    if len(open_) and shallow < length:
        group, inverse = np.unique(head[open_], return_inverse=True)
        mixed = np.zeros(len(group), bool)  # groups whose members differ further on
        for depth in range(shallow, length, 8):
            s = symbol(order[open_], depth)
            first = np.searchsorted(head[open_], group)
            mixed |= np.bincount(inverse, weights=s != s[first[inverse]], minlength=len(group)) > 0
        deep = open_[mixed[inverse]]
        heads = head[deep]
        cut = np.append(np.flatnonzero(np.append(True, heads[1:] != heads[:-1])), len(deep)) if len(deep) else deep
        text, names = padded(data, length).tobytes(), order[deep].tolist()
        begins = starts[order[deep]].tolist()
        sorted_, heads, places = [], [], deep.tolist()
        for a, z in itertools.pairwise(cut.tolist()):
            if z - a == 2:  # they differ
                same = [[names[a]], [names[a + 1]]]
                if text[begins[a] : begins[a] + length] > text[begins[a + 1] : begins[a + 1] + length]:
                    same.reverse()
            else:
                trie = BlindTrie()
                for k in range(a, z):
                    trie.add(text[begins[k] : begins[k] + length], names[k])
                same = trie.groups()
            place = places[a]
            for group_ in same:
                sorted_ += group_
                heads += [place] * len(group_)
                place += len(group_)
        order[deep], head[deep] = sorted_, heads
    rank = np.empty(n, np.int64)
    rank[order] = head
    return order, rank


# -- the operator -----------------------------------------------------------------------


def _shared(asks: list[list[np.ndarray]]) -> list[tuple]:
    """Whether more than one document holds the anchor."""
    _, inverse = unique(np.concatenate([a[0] for a in asks]))
    weight = 1 + np.concatenate([a[1] for a in asks])
    shared = (np.bincount(inverse, weights=weight) > 1)[inverse].astype(np.uint8)
    return [(part,) for part in np.split(shared, np.cumsum([len(a[0]) for a in asks])[:-1])]


def _earlier(length: int):
    def run(asks: list[list[np.ndarray]]) -> list[tuple]:
        """For each span one bit per string in it: set if a smaller document holds the string."""
        key, size, owner, data = (np.concatenate([a[i] for a in asks]) for i in range(4))
        first = np.cumsum(size.astype(np.int64)) - size
        group, one = distinct_spans(data, first, size.astype(np.int64))
        least = _least(group, len(one), owner)
        anchor, of = unique(key[one])
        rest = np.flatnonzero((np.bincount(of) > 1)[of])  # classes whose anchor has other spans too
        count = size[one[rest]].astype(np.int64) - length + 1
        starts = ragged(first[one[rest]], count)
        mine = np.repeat(np.arange(len(rest)), count)
        _, rank = deep_shallow(data, starts, length)
        _, string = np.unique(rank, return_inverse=True)
        seen = _least(string, int(string.max()) + 1 if len(string) else 0, least[rest][mine])
        bit = (seen[string] < least[rest][mine]).astype(np.uint64) << (starts - first[one[rest]][mine]).astype(np.uint64)
        bits = np.zeros(len(one), np.uint64)
        np.bitwise_or.at(bits, rest[mine], bit)
        mask = np.where(owner > least[group], np.uint64(2**32 - 1), bits[group]).astype(np.uint32)
        return [(part,) for part in np.split(mask, np.cumsum([len(a[0]) for a in asks])[:-1])]

    return run


def dedup_substrings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, starts and ends of the removed runs, and the bytes that are kept.

    `length` lies between 24 and 51, so that the strings at one anchor fit 32 bits.
    """
    assert GRAM + 4 <= length <= GRAM + 31
    batches = Batches.write(docs.select("doc_id", "text"), "substring-batches")
    buckets = batches.buckets
    short = np.uint64(24)  # bits of the hash that the first question leaves out

    def spans(table: pa.Table):
        ids, column = ids_of(table)
        data, at = buffer_of(table["text"])
        first, end, key, doc = anchors(data, at, length)
        return ids, column, data, at, first, end - first + length - 1, key, doc

    def ask_anchors(batch: int, table: pa.Table, _) -> dict:
        ids, _, _, _, _, _, key, doc = spans(table)
        keys, group = unique(key >> short << short)
        low, high = _least(group, len(keys), ids[doc]), -_least(group, len(keys), -1 - ids[doc]) - 1
        return question(batch, buckets, keys, (low < high).astype(np.uint8))

    def chosen(table: pa.Table, got: dict):
        ids, column, data, at, first, size, key, doc = spans(table)
        _, group = unique(key >> short << short)
        used = np.flatnonzero(joined(got, kind="u1")[group] > 0) if len(key) else np.zeros(0, np.int64)
        # the questions' order: by anchor, then as the classes come
        cls, one = distinct_spans(data, first[used], size[used])
        order = np.argsort(key[used[one]], kind="stable")
        place = np.empty(len(one), np.int64)
        place[order] = np.arange(len(one))
        return ids, column, data, at, first, size, key, doc, used, place[cls], used[one[order]]

    def ask_spans(batch: int, table: pa.Table, got: dict) -> dict:
        ids, _, data, _, first, size, key, doc, used, cls, one = chosen(table, got[0])
        owner = _least(cls, len(one), ids[doc[used]])
        at = bounds(key[one], buckets)
        out: dict = {"bucket": [], "batch": [], "blob": []}
        for b in range(buckets):
            m = one[at[b] : at[b + 1]]
            if len(m):
                text = data[ragged(first[m], size[m])]
                out["bucket"].append(b)
                out["batch"].append(batch)
                out["blob"].append(pack(key[m], size[m].astype(np.uint8), owner[at[b] : at[b + 1]], text))
        return out

    def remove(batch: int, table: pa.Table, got: dict) -> dict:
        ids, column, data, at, first, size, _, doc, used, cls, one = chosen(table, got[0])
        owner = _least(cls, len(one), ids[doc[used]])
        mask = joined(got[1], kind="u4").astype(np.uint32)[cls] if len(one) else np.zeros(0, np.uint32)
        mask = np.where(ids[doc[used]] > owner[cls], np.uint32(2**32 - 1), mask)
        step = np.zeros(len(data) + 1, np.int8)  # at most `length` strings cover a byte
        count = size[used] - length + 1
        for t in range(int(count.max()) if len(count) else 0):
            hit = first[used][(t < count) & ((mask >> np.uint32(t)) & np.uint32(1) > 0)] + t
            step[hit] += 1
            step[hit + length] -= 1
        gone = np.cumsum(step[:-1], dtype=np.int8) > 0
        begin, stop = gone.copy(), gone.copy()
        begin[1:] &= ~gone[:-1]
        stop[:-1] &= ~gone[1:]
        full = at[1:] > at[:-1]
        begin[at[:-1][full]] = gone[at[:-1][full]]
        stop[at[1:][full] - 1] = gone[at[1:][full] - 1]
        begin, stop = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        of = np.searchsorted(begin, at)
        base = np.repeat(at[:-1], np.diff(of))
        kept = np.concatenate([[0], np.cumsum(~gone)])[at]
        lists = lambda v: pa.ListArray.from_arrays(of.astype(np.int32), pa.array(v - base, pa.int64()))
        left = pa.Array.from_buffers(
            pa.large_binary(), len(ids), [None, pa.py_buffer(kept.astype(np.int64)), pa.py_buffer(data[~gone])]
        ).cast(pa.binary())
        return {"doc_id": column, "n_bytes": np.diff(at), "starts": lists(begin), "ends": lists(stop), "kept": left}

    asked = batches.each(ask_anchors, ASKED)
    shared = batches.keep(answer(asked, _shared), "anchors-shared")
    strings = batches.keep(answer(batches.each(ask_spans, ASKED, shared), _earlier(length)), "strings-earlier")
    schema = "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary"
    return batches.each(remove, schema, shared, strings)
