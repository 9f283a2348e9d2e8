"""License notices in texts, by patience alignment with templates.

Texts and templates are lower-cased words of letters and digits.  Places where a text and a
template share a run of three words (of all its words, for a shorter template) open regions,
which take in the template's length around them.  A region is aligned with the template: equal ends are matched, words that stand
once in both are anchors, the longest increasing run of anchors is kept (found by patience
piles), and the gaps between them are aligned in the same way.  Besides, every place where the template
would begin by the runs shared is aligned on its own, from these runs on, so that copies of a notice that stand
close together do not hide each other.  Coverage is the share of
template words matched; a notice is reported from `COVERAGE` on, if no more than one word is lacking
of a template of under `SHORT` words, and if every phrase that a template has in braces (the name,
version and variant that tell licenses apart) is matched by words that follow each other.

Whole texts are searched; a text may hold any number of notices.  Nothing is shuffled; templates
are a parameter of bounded size and go to every task.

Cases: null, empty and short texts hold nothing; of notices the longer match, then the
first template, then the shorter and the earlier stretch, is best; a notice most of whose
words belong to a longer one is a part of that and not named; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidefold.llm.decontaminate import Lookup, Words
from tidefold.llm.license_texts import TEMPLATES
from tidefold.llm.textbytes import slices

COVERAGE = 0.75
RUN = 3

# a template of fewer words may lack one word at most
SHORT = 12


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by their first, whose second rises: patience piles with back links."""
    tops: list[int] = []
    last: list[int] = []
    back: list[int] = []
    for i, (_, y) in enumerate(pairs):
        pile = bisect_left(tops, y)
        if pile == len(tops):
            tops.append(y)
            last.append(i)
        else:
            tops[pile], last[pile] = y, i
        back.append(last[pile - 1] if pile else -1)
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Matched places (in a, in b), both rising."""
    out, work = [], [(0, len(a), 0, len(b))]
    while work:
        s, e, t, f = work.pop()
        while s < e and t < f and a[s] == b[t]:
            out.append((s, t))
            s, t = s + 1, t + 1
        while s < e and t < f and a[e - 1] == b[f - 1]:
            e, f = e - 1, f - 1
            out.append((e, f))
        if s >= e or t >= f:
            continue
        ca, cb = Counter(a[s:e]), Counter(b[t:f])
        where = {w: j for j, w in enumerate(b[t:f], t) if cb[w] == 1}
        anchors = _rising([(i, where[w]) for i, w in enumerate(a[s:e], s) if ca[w] == 1 and w in where])
        if not anchors:
            continue
        out += anchors
        edge = [(s - 1, t - 1), *anchors, (e, f)]
        work += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edge, edge[1:])]
    return sorted(out)


def _phrases(text: str) -> list[tuple[int, int]]:
    """The words [from, to) of what stands in braces."""
    parts = re.split("[{}]", text)
    ends = np.cumsum(np.diff(Words(pa.array(parts, pa.string())).first)).tolist()
    return list(zip(ends[0::2], ends[1::2]))


def _between(a: list, b: list, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Given matches, and what the gaps between them match."""
    out = list(pairs)
    edge = [(-1, -1), *pairs, (len(a), len(b))]
    for (i, j), (k, m) in zip(edge, edge[1:]):
        if k - i > 1 and m - j > 1:
            out += [(i + 1 + x, j + 1 + y) for x, y in align(a[i + 1 : k], b[j + 1 : m])]
    return sorted(out)


def align_at(a: list, b: list, at: int, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Like `align`, for a `b` that would begin at `at` in `a` and shares the runs `pairs` with it there."""
    same = [(at + j, j) for j, x in enumerate(b) if 0 <= at + j < len(a) and a[at + j] == x]
    return max(_between(a, b, pairs), _between(a, b, same), key=len)


class _Templates:
    def __init__(self, templates: Mapping[str, str | Sequence[str]], coverage: float):
        texts = [(n, t) for n, v in templates.items() for t in ([v] if isinstance(v, str) else v)]
        self.names = [n for n, _ in texts]
        w = Words(pa.array([t for _, t in texts], pa.string()))
        self.words = [w.hash[a:z].tolist() for a, z in zip(w.first[:-1], w.first[1:])]
        self.phrases = [_phrases(t) for _, t in texts]
        self.deciding = [{x[i] for a, z in ps for i in range(a, z)} for x, ps in zip(self.words, self.phrases)]
        self.least = [max(math.ceil(coverage * n), n - 1 if n < SHORT else 0) for n in map(len, self.words)]
        self.runs: dict[int, dict[int, list[tuple[int, int]]]] = {}  # by length, then hash: (template, place)
        for m in sorted({min(RUN, len(x)) for x in self.words if x}):
            tokens, found = w.tokens(m), {}
            for k, x in enumerate(self.words):
                if min(RUN, len(x)) == m:
                    for p in range(len(x) - m + 1):
                        found.setdefault(int(tokens[w.first[k] + p]), []).append((k, p))
            self.runs[m] = found
        self.lookups = {m: Lookup(np.sort(np.array(list(f), np.uint64))) for m, f in self.runs.items()}

    def decided(self, k: int, got: list[tuple[int, int]]) -> bool:
        """Whether the phrases of a template are matched without a gap."""
        at = {j: i for i, j in got}
        return all(j in at and at[j] - at.get(a, -1) == j - a for a, z in self.phrases[k] for j in range(a, z))

    def regions(self, w: Words) -> dict[tuple[int, int], tuple[list[list[int]], dict[int, list]]]:
        """(text, template): stretches of words [from, to) to align, and by where the template would begin
        the region of its own and the pairs (word, template word) of the shared runs."""
        near: dict[tuple[int, int], tuple[list[list[int]], dict[int, list]]] = {}
        for m, lookup in self.lookups.items():
            tokens = w.tokens(m)
            places, _ = lookup(tokens)
            docs = np.searchsorted(w.first, places, "right") - 1
            inside = places + m <= w.first[docs + 1]
            for p, d in zip(places[inside].tolist(), docs[inside].tolist()):
                for k, q in self.runs[m][int(tokens[p])]:
                    size = len(self.words[k])
                    pad = 2 + size // 4
                    a = max(int(w.first[d]), p - q - pad)
                    z = min(int(w.first[d + 1]), p - q + size + pad)
                    seen, own = near.setdefault((d, k), ([], {}))
                    pairs = own.setdefault(p - q, [a, z, []])[2]
                    done = pairs[-1][1] + 1 if pairs else 0
                    pairs += [(p - q + j, j) for j in range(max(q, done), q + m)]
                    if seen and a < seen[-1][1]:  # places rise
                        seen[-1][1] = max(seen[-1][1], z)
                    else:
                        seen.append([a, z])
        return near


def scan(docs: DataFrame, templates: Mapping[str, str | Sequence[str]] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """One row per document: doc_id, n_words, the best notice (license, coverage, its first and
    last word), and the names of all notices found."""
    templates = templates or TEMPLATES

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Templates(templates, coverage)
        for part in parts:
            for p in slices(part):
                w = Words(p["text"])
                best: dict[int, tuple] = {}
                names: dict[int, set] = {}
                found: dict[int, list[tuple]] = {}
                for (d, k), (stretches, own) in known.regions(w).items():
                    # a notice that stands there several times hides its anchors; a gap may be longer than one's own region
                    work = [(a, z, None, []) for a, z in stretches] + [(a, z, at, pairs) for at, (a, z, pairs) in own.items()]
                    for a, z, at, pairs in work:
                        words = w.hash[a:z].tolist()
                        if not known.deciding[k].issubset(words):
                            continue
                        if at is None:
                            got = align(words, known.words[k])
                        else:
                            got = align_at(words, known.words[k], at - a, [(i - a, j) for i, j in pairs])
                        if len(got) < known.least[k] or not known.decided(k, got):
                            continue
                        share = len(got) / len(known.words[k])
                        places = [a + i for i, _ in got]
                        rank = (len(got), share, -k, places[0] - places[-1], -places[0])
                        found.setdefault(d, []).append((rank, k, places))
                for d, notices in found.items():
                    notices.sort(key=lambda x: x[0], reverse=True)
                    base = int(w.first[d])
                    (_, share, *_), k, places = notices[0]
                    best[d] = (None, known.names[k], share, places[0] - base, places[-1] + 1 - base)
                    taken: set[int] = set()
                    for _, k, places in notices:
                        if 2 * sum(i in taken for i in places) <= len(places):
                            names.setdefault(d, set()).add(known.names[k])
                        taken.update(places)
                n = p.num_rows
                col = lambda i, t: pa.array([best[d][i] if d in best else None for d in range(n)], t)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": p["doc_id"], "n_words": pa.array(np.diff(w.first)), "license": col(1, pa.string()),
                    "coverage": col(2, pa.float64()), "first_word": col(3, pa.int64()), "end_word": col(4, pa.int64()),
                    "licenses": pa.array([sorted(names.get(d, ())) for d in range(n)], pa.list_(pa.string()))})

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_words long, license string, coverage double, first_word long, "
                                "end_word long, licenses array<string>")
