"""Hard negatives from embeddings, read from Hilbert-ordered blocks with zone maps.

Storage: components are made integers, floor(`SCALE` * x).  Rows are put in the order of a Hilbert curve over the
eight components of largest variance, and cut into blocks, one Parquet row each, beside a zone map: the
least and the largest value of every dimension and of the labels.

Search: an ask is an anchor, an interval of scores, a number k and whether its answers have the anchor's label.
The product of an anchor with a block's intervals bounds the scores in the block from both sides, so
only blocks whose interval meets the ask's, and whose labels fit, are read.  Each question is
asked twice: of the anchor's own block, whose rows are its neighbours on the curve and whose
k-th score raises the lower end of the interval; then of all blocks that the zone maps leave.
Positives are the first answers of the anchor's label, and every positive opens a window of scores
for negatives.  The bounds decide what is read, never what is returned: scores are integers and exact.

Blocks and anchors meet in groups (some blocks, some tiles of anchors), so that the vectors
of a block are sent once for a group of tiles.  Groups are of bounded size.  On vectors that are not
clustered the zone maps rule out little, and the work is that of all anchors against all blocks.

Cases: rows with a null id, label or vector, or a null or non-finite component take no part;
vectors of different lengths never meet; rows that repeat an id are rows each, and an anchor each;
ties go to the smaller id; fewer rows than asked for are returned as they are; a positive score below
0 has an empty window; empty tables give no rows; other columns are ignored.  A score whose
hundredfold is no long is an error, as overflow is in ANSI SQL.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidefold.sinks.folders import shared_folder

SCALE = 256
VALUES = 1 << 16  # numbers in a block: 1024 vectors of 64
ANCHORS = 1 << 17  # numbers in a tile of anchors
BLOCKS, TILES = 16, 16  # blocks and tiles of a group
ZONES = 512  # zone maps that a tile meets at once
CURVE, CURVE_BITS = 8, 4
FAR = 1 << 62
LIMIT = (1 << 63) // 100


# -- the curve ------------------------------------------------------------------------


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """The place on a Hilbert curve of each point (rows of x, values below 2 to the power of bits)."""
    x = x.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the turns of each level
        p = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    turn, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[n - 1] & q) > 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _leading(rows: DataFrame) -> dict[int, tuple[list[int], list[float], list[float]]]:
    """For every length of vectors, the dimensions of largest variance, their means and deviations."""

    def sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            size = part["size"].to_numpy()
            for n in np.unique(size).tolist():
                x = _matrix(part["q"].filter(pa.array(size == n)), n)
                yield pa.RecordBatch.from_pydict({
                    "size": pa.array(np.full(n, n, np.int32)), "dim": pa.array(np.arange(n, dtype=np.int32)),
                    "n": pa.array(np.full(n, float(len(x)))), "s": pa.array(x.sum(0)), "ss": pa.array((x * x).sum(0))})

    total = rows.select("size", "q").mapInArrow(sums, "size int, dim int, n double, s double, ss double")
    total = total.groupBy("size", "dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"))
    mean = F.col("s") / F.col("n")
    spread = F.sqrt(F.greatest(F.col("ss") / F.col("n") - mean * mean, F.lit(0.0)))
    total = total.select("size", "dim", mean.alias("mean"), spread.alias("spread"))
    first = F.row_number().over(Window.partitionBy("size").orderBy(F.desc("spread"), "dim"))
    out: dict[int, tuple[list, list, list]] = {}
    for r in total.withColumn("nth", first).filter(F.col("nth") <= CURVE).orderBy("size", "nth").collect():  # eight per length
        for values, v in zip(out.setdefault(r["size"], ([], [], [])), (r["dim"], r["mean"], r["spread"])):
            values.append(v)
    return out


def _matrix(column, size: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), size)


def _placed(leading: dict):
    """Rows with their place on the curve; values beyond two deviations fall into the outer cells."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = 1 << CURVE_BITS
        for part in parts:
            size = part["size"].to_numpy()
            place = np.zeros(part.num_rows, np.int64)
            for n in np.unique(size).tolist():
                if n == 0:
                    continue
                m = np.flatnonzero(size == n)
                dims, mean, spread = leading[n]
                x = _matrix(part["q"].take(pa.array(m)), n)[:, dims]
                z = (x - np.array(mean)) / np.maximum(np.array(spread), 1e-300)
                place[m] = hilbert(np.clip((z + 2) * cells / 4, 0, cells - 1).astype(np.int64), CURVE_BITS)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(place)], [*part.schema.names, "curve"])

    return run


# -- blocks and tiles of anchors --------------------------------------------------------

BLOCK = "block long, size int, n int, label_low long, label_high long, low array<double>, high array<double>, payload binary"
TILE = "tile long, size int, payload binary"


def _pack(x: np.ndarray, *others: np.ndarray) -> bytes:
    """Integers in a row, the narrowest kind that holds the vectors last."""
    most = np.abs(x).max(initial=0)
    kind = next(k for k in ("<i2", "<i4", "<f8") if k == "<f8" or most < np.iinfo(k).max)
    head = np.array([len(x), len(others), "<i2 <i4 <f8".split().index(kind)], "<i8")
    return b"".join([head.tobytes(), *[o.astype("<i8").tobytes() for o in others], x.astype(kind).tobytes()])


def _unpack(raw: bytes, size: int) -> tuple[np.ndarray, ...]:
    n, count, kind = np.frombuffer(raw, "<i8", 3).tolist()
    others = np.frombuffer(raw, "<i8", n * count, 24).reshape(count, n)
    x = np.frombuffer(raw, ["<i2", "<i4", "<f8"][kind], n * size, 24 + 8 * n * count).reshape(n, size)
    return (*others, x.astype(np.float64))


def _runs(parts: Iterator[pa.RecordBatch], values: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(size, ids, labels, vectors) of runs of rows of one length, of so many numbers at most."""
    held, size = [], None
    for part in parts:
        sizes, ids, labels = part["size"].to_numpy(), part["vec_id"].to_numpy(), part["label"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), part.num_rows]
        for a, z in zip(cuts[:-1], cuts[1:]):
            if a == z:
                continue
            n = int(sizes[a])
            if held and n != size:
                yield size, *(np.concatenate(c) for c in zip(*held))
                held = []
            size, room = n, max(1, values // max(n, 1))
            x = _matrix(part["q"].slice(a, z - a), n)
            while a < z:
                step = min(z - a, room - sum(len(h[0]) for h in held))
                held.append((ids[a : a + step], labels[a : a + step], x[:step]))
                a, x = a + step, x[step:]
                if sum(len(h[0]) for h in held) == room:
                    yield size, *(np.concatenate(c) for c in zip(*held))
                    held = []
    if held:
        yield size, *(np.concatenate(c) for c in zip(*held))


def _one(kind: str, **values) -> pa.RecordBatch:
    schema = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}
    types = dict(c.strip().split(" ") for c in kind.split(","))
    return pa.RecordBatch.from_pydict({c: pa.array([v], schema[types[c]]) for c, v in values.items()})


def _blocks(values: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for size, ids, labels, x in _runs(parts, values):
            yield _one(BLOCK, block=number, size=size, n=len(ids), label_low=int(labels.min()), label_high=int(labels.max()),
                       low=x.min(0).tolist(), high=x.max(0).tolist(), payload=_pack(x, ids, labels))
            number += 1

    return run


def _tiles(every: int, values: int):
    """The anchors of the blocks of a task: id, label, block and place in it, and the vector of each."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], None
        emit = lambda: _one(TILE, tile=number, size=size, payload=_pack(*(np.concatenate(c) for c in zip(*held))))
        for part in parts:
            for block, n, raw in zip(*(part[c].to_pylist() for c in ("block", "size", "payload"))):
                ids, labels, x = _unpack(raw, n)
                m = np.flatnonzero(ids % every == 0)
                if held and (n != size or (sum(len(h[0]) for h in held) + len(m)) * n > values):
                    yield emit()
                    number, held = number + 1, []
                size = n
                if len(m):
                    held.append((x[m], ids[m], labels[m], np.full(len(m), block), m))
        if held:
            yield emit()

    return run


# -- search ---------------------------------------------------------------------------


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors, exactly."""
    most = a.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0)
    if most < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(v) for v in r] for r in m], object).reshape(m.shape)
    product = whole(a) @ whole(b).T
    if max((abs(v) for v in product.ravel()), default=0) >= LIMIT:
        raise OverflowError("the hundredfold of an inner product is no long")
    return product.astype(np.int64)


def _asks(asks: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.array([r[c] for r in asks], np.int64) for c in ("nth", "ask", "low", "high"))


def _own_blocks(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every tile, the blocks its anchors are in."""
    for part in parts:
        for tile, size, raw, asks in zip(*(part[c].to_pylist() for c in ("tile", "size", "payload", "asks"))):
            _, _, block, _, _ = _unpack(raw, size)
            asked = np.zeros(len(block), bool)
            asked[_asks(asks)[0]] = True
            for b in np.unique(block[asked]).tolist():
                yield _one(NEED, block=b, tile=tile, who=np.packbits(asked & (block == b)).tobytes())


NEED = "block long, tile long, who binary"


def _zoned(same: bool):
    """For every tile and zone map, the anchors whose asks the block may answer."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for tile, size, raw, asks, zones in zip(*(part[c].to_pylist() for c in ("tile", "size", "payload", "asks", "zones"))):
                zones = [z for z in zones if z["size"] == size]
                if not zones:
                    continue
                _, label, _, _, x = _unpack(raw, size)
                nth, _, ask_low, ask_high = _asks(asks)
                plus, minus = np.maximum(x, 0), np.minimum(x, 0)
                low, high = (np.array([z[c] for z in zones], np.float64).reshape(len(zones), size) for c in ("low", "high"))
                slack = 1e-12 * (np.abs(x) @ np.maximum(np.abs(low), np.abs(high)).T) + 0.5
                above = plus @ high.T + minus @ low.T + slack
                below = plus @ low.T + minus @ high.T - slack
                first, last = (np.array([z[c] for z in zones], np.int64) for c in ("label_low", "label_high"))
                of = label[:, None]
                fits = (first <= of) & (of <= last) if same else (first != of) | (last != of)
                meets = (above[nth] >= ask_low[:, None]) & (below[nth] <= ask_high[:, None]) & fits[nth]
                who = np.zeros((len(zones), len(x)), bool)
                i, j = np.nonzero(meets)
                who[j, nth[i]] = True
                kept = np.flatnonzero(who.any(1))
                if len(kept):
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([zones[z]["block"] for z in kept.tolist()], pa.int64()), "tile": pa.array([tile] * len(kept), pa.int64()),
                        "who": pa.array([np.packbits(who[z]).tobytes() for z in kept.tolist()], pa.binary())})

    return run


FOUND = "tile long, nth int, ask int, score long, vec_id long, block long, place int"


def _met(same: bool, k: int):
    """The first k answers of a group's blocks to each ask of its tiles."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        kind = rows["kind"].to_numpy()
        part = lambda n: rows.filter(pa.array(kind == n)).to_pylist()
        out = []
        blocks = sorted(part(0), key=lambda r: r["block"])
        needs: dict[int, dict[int, bytes]] = {}
        for r in part(2):
            needs.setdefault(r["tile"], {})[r["block"]] = r["who"]
        for tile in part(1):
            size = tile["size"]
            ids, label, own, own_place, x = _unpack(tile["payload"], size)
            nth, ask, low, high = _asks(tile["asks"])
            read = [b for b in blocks if b["block"] in needs.get(tile["tile"], {})]
            if not read:
                continue
            loaded = [_unpack(b["payload"], size) for b in read]
            vec, of = (np.concatenate([b[c] for b in loaded]) for c in (0, 1))
            block = np.repeat([b["block"] for b in read], [len(b[0]) for b in loaded])
            place = np.concatenate([np.arange(len(b[0])) for b in loaded])
            nth_block = np.repeat(np.arange(len(read)), [len(b[0]) for b in loaded])
            who = np.array([np.unpackbits(np.frombuffer(needs[tile["tile"]][b["block"]], np.uint8), count=len(ids)) for b in read], bool)
            y = np.concatenate([b[2] for b in loaded])
            wanted = np.flatnonzero(who[:, nth].any(0))
            wanted = wanted[np.argsort(nth[wanted], kind="stable")]
            step = max(1, (1 << 21) // len(vec))
            for a in range(0, len(wanted), step):
                w = wanted[a : a + step]
                anchors, row = np.unique(nth[w], return_inverse=True)
                score = _times(x[anchors], y)
                ok = (of[None, :] == label[anchors][:, None]) == same
                ok &= who[:, anchors].T[:, nth_block]
                ok &= (block[None, :] != own[anchors][:, None]) | (place[None, :] != own_place[anchors][:, None])
                for q, r in zip(w.tolist(), row.tolist()):
                    s = score[r]
                    m = np.flatnonzero(ok[r] & (s >= low[q]) & (s <= high[q]))
                    if len(m) > k:
                        m = m[s[m] >= np.partition(s[m], len(m) - k)[len(m) - k]]
                    m = m[np.lexsort((place[m], block[m], vec[m], -s[m]))][:k]
                    if len(m):
                        out.append((np.full(len(m), tile["tile"]), np.full(len(m), nth[q]), np.full(len(m), ask[q]), s[m], vec[m], block[m], place[m]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 7
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
        names = [c.strip().split(" ")[0] for c in FOUND.split(",")]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types)})

    return run


class Index:
    """Blocks, zone maps and tiles of anchors of a table (vec_id, label, embedding) in a shared folder."""

    def __init__(self, embeddings: DataFrame, anchors_every: int):
        self.spark = embeddings.sparkSession
        self.folder = shared_folder(self.spark, "hard-negatives")
        rows = self._stored(self._integers(embeddings), "rows")
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        parts = min(parts, max(8, -(-rows.count() // (BLOCKS * 1024))))
        columns = "vec_id long, label long, size int, q array<double>, curve long"
        placed = rows.mapInArrow(_placed(_leading(rows)), columns)
        order = ["size", "curve", "vec_id", "label"]
        # rows that are equal in all of these are spread by a number of their own
        tie = F.monotonically_increasing_id()
        placed = self._stored(placed.withColumn("tie", tie), "placed")
        dealt = placed.repartitionByRange(parts, *order, "tie").sortWithinPartitions(*order, "tie")
        self.blocks = self._stored(dealt.select("vec_id", "label", "size", "q").mapInArrow(_blocks(VALUES), BLOCK), "blocks")
        self.tiles = self._stored(self.blocks.select("block", "size", "payload").mapInArrow(_tiles(anchors_every, ANCHORS), TILE), "tiles")
        self.block_group = self._grouped(self.blocks, "block", BLOCKS)
        self.tile_group = self._grouped(self.tiles, "tile", TILES)
        zones = self.blocks.drop("payload", "n")
        self.zone_parts = max(1, -(-zones.count() // ZONES))
        zones = zones.groupBy(F.pmod(F.xxhash64("block"), F.lit(self.zone_parts)).alias("zone"))
        self.zones = zones.agg(F.collect_list(F.struct("block", "size", "label_low", "label_high", "low", "high")).alias("zones"))

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def _grouped(self, df: DataFrame, number: str, most: int):
        """A group of so many blocks or tiles: neighbours of one task, or all those of neighbouring tasks."""
        tasks, rows = df.agg(F.count_distinct(F.shiftright(number, 32)), F.count("*")).first()
        near = max(1, most * tasks // max(rows, 1))
        return lambda c: F.shiftleft(F.floor(F.shiftright(c, 32) / near), 32) + F.floor(F.col(c).bitwiseAND((1 << 32) - 1) / most)

    @staticmethod
    def _integers(embeddings: DataFrame) -> DataFrame:
        # double floors: every component is an integer, whatever its size
        vector = F.transform("embedding", lambda x: x.cast("double"))
        rows = embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), vector.alias("v"))
        fine = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & fine)
        # x - pmod(x, 1) floors without leaving doubles; from 2 to the power of 53 on all doubles are integers
        scaled = F.transform("v", lambda x: x * F.lit(float(SCALE)))
        whole = F.transform(scaled, lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x))
        return rows.select("vec_id", "label", F.size("v").alias("size"), whole.alias("q"))

    def anchors(self) -> DataFrame:
        """(tile, nth, anchor_id)."""

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                for tile, size, raw in zip(*(part[c].to_pylist() for c in ("tile", "size", "payload"))):
                    ids = _unpack(raw, size)[0]
                    yield pa.RecordBatch.from_pydict({"tile": pa.array(np.full(len(ids), tile)), "nth": pa.array(np.arange(len(ids), dtype=np.int32)), "anchor_id": pa.array(ids)})

        return self.tiles.mapInArrow(run, "tile long, nth int, anchor_id long")

    def _answers(self, asks: DataFrame, same: bool, k: int, own: bool) -> DataFrame:
        """The first k answers to each ask, of the anchors' own blocks or of all."""
        packed = asks.groupBy("tile").agg(F.collect_list(F.struct("nth", "ask", "low", "high")).alias("asks"))
        asked = self._stored(self.tiles.join(packed, "tile"), f"asked-{same}-{own}")
        if own:
            needs = asked.mapInArrow(_own_blocks, NEED)
        else:
            met = asked.withColumn("zone", F.explode(F.sequence(F.lit(0), F.lit(self.zone_parts - 1))))
            met = met.withColumn("zone", F.col("zone").cast("long")).join(self.zones, "zone")
            needs = met.select("tile", "size", "payload", "asks", "zones").mapInArrow(_zoned(same), NEED)
        needs = needs.withColumn("bg", self.block_group("block")).withColumn("tg", self.tile_group("tile"))
        needs = self._stored(needs, f"needs-{same}-{own}")
        none = lambda kind: F.lit(None).cast(kind)
        asks_type = asked.schema["asks"].dataType
        blocks = needs.select("bg", "tg", "block").distinct().join(self.blocks.select("block", "size", "payload"), "block")
        blocks = blocks.select("bg", "tg", F.lit(0).alias("kind"), "block", none("long").alias("tile"), "size", "payload",
                               none("binary").alias("who"), none(asks_type).alias("asks"))
        tiles = needs.select("bg", "tg", "tile").distinct().join(asked, "tile")
        tiles = tiles.select("bg", "tg", F.lit(1).alias("kind"), none("long").alias("block"), "tile", "size", "payload",
                             none("binary").alias("who"), "asks")
        pairs = needs.select("bg", "tg", F.lit(2).alias("kind"), "block", "tile", none("int").alias("size"),
                             none("binary").alias("payload"), "who", none(asks_type).alias("asks"))
        found = blocks.unionByName(tiles).unionByName(pairs).groupBy("bg", "tg").applyInArrow(_met(same, k), FOUND)
        order = Window.partitionBy("tile", "nth", "ask").orderBy(F.desc("score"), "vec_id", "block", "place")
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        return self._stored(found, f"answers-{same}-{own}")

    def first(self, asks: DataFrame, same: bool, k: int) -> DataFrame:
        """(tile, nth, ask, rank, score, vec_id): the first k rows of the anchor's label, or of others, with scores from low to high."""
        near = self._answers(asks, same, k, own=True)
        raised = near.filter(F.col("rank") == k).select("tile", "nth", "ask", F.col("score").alias("least"))
        asks = asks.join(raised, ["tile", "nth", "ask"], "left")
        asks = asks.select("tile", "nth", "ask", F.greatest("low", F.coalesce("least", "low")).alias("low"), "high")
        return self._answers(asks, same, k, own=False).select("tile", "nth", "ask", "rank", "score", "vec_id")


def mine(embeddings: DataFrame, anchors_every: int = 100, positives: int = 5, negatives: int = 10,
         low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose vec_id `anchors_every` divides; a negative's score is from `low` to `high` percent of its positive's.
    """
    index = Index(embeddings, anchors_every)
    anchors = index.anchors()
    asks = anchors.select("tile", "nth", F.lit(0).alias("ask"), F.lit(-FAR).alias("low"), F.lit(FAR).alias("high"))
    good = index.first(asks, True, positives).select("tile", "nth", F.col("rank").alias("ask"), F.col("vec_id").alias("positive_id"),
                                                     F.col("score").alias("positive_score"))
    # integers between the two shares, rounded inwards; in decimals, which do not overflow
    share = lambda percent: F.col("positive_score").cast("decimal(20,0)") * F.lit(percent) / F.lit(100).cast("decimal(3,0)")
    windows = good.filter("positive_score >= 0").select(
        "tile", "nth", "ask", F.ceil(share(low)).cast("long").alias("low"), F.floor(share(high)).cast("long").alias("high"))
    bad = index.first(windows, False, negatives)
    out = bad.join(good, ["tile", "nth", "ask"]).join(anchors, ["tile", "nth"])
    return out.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def relabelled(embeddings: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """`embeddings` with the next label where `every` divides vec_id."""
    label: Column = F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return embeddings.withColumn("label", label)
