"""A configured sink: every topic of a log to its target table.

    sink = ConfiguredSink(spark, Settings({...}), "/tables")
    sink.apply(log, batch=0)                      # a bounded log
    sink.start(stream, "/checkpoints/sink")       # the same as a stream

Records are routed by the settings, each target has its own plan, and a table lies
under `<root>/<database>/<target>`.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field as attribute
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidefold.model import LOG_POSITION
from tidefold.operators import errors, keyless, route
from tidefold.operators.merge import after_offsets
from tidefold.plans.settings import Settings
from tidefold.plans.target_plan import Registry, TargetPlan
from tidefold.sinks import folders
from tidefold.sinks.bucket_table import PACKING, BucketTable
from tidefold.sources.decode import Decoder, decode
from tidefold.streaming.apply import apply_stream, apply_targets

SCAN_ROWS = 1_000_000  # records that a file of the stored log holds, and that a task reduces where a split holds more


@dataclass
class ConfiguredSink:
    spark: SparkSession
    settings: Settings
    root: str
    kind: str = "document"
    buckets: int = 15
    key_decoder: Decoder | None = None
    value_decoder: Decoder | None = None
    row_keys: Mapping[str, Sequence[str]] = attribute(default_factory=dict)
    registry: Registry = attribute(default_factory=Registry)
    now: Column | None = None
    fence: bool = True

    def plan(self, target: str) -> TargetPlan:
        keys = list(self.row_keys.get(target, []))
        return TargetPlan(self.settings, target, self.kind, self.now, keys, self.registry)

    def table(self, target: str) -> BucketTable:
        parts = [self.settings.get("catalog"), self.settings.get("database"), target]
        path = "/".join([self.root, *[p for p in parts if p]])
        return BucketTable(self.spark, path, ("k",), self.buckets, self.settings.number("max.batch.size", target))

    def rows(self, target: str) -> DataFrame:
        """Rows of a table without key, each as often as it is there."""
        stored = self.table(target).read()
        columns = stored.schema["doc"].dataType.names
        return keyless.rows(stored.select("doc.*", keyless.COUNT), columns)

    def routed(self, log: DataFrame) -> DataFrame:
        return route.route(log, self.settings.routes(), self.settings.get("route"), self.settings.rewrites())

    def apply(self, log: DataFrame, batch: int, source: str = "") -> None:
        """Apply one batch of records to all targets they are for; a source applies each batch once.

        The batch is read once and written by target to the shared folder, where each target reads its own
        records only, also after executors are lost.
        """
        folder, once = folders.shared_folder(self.spark, "routed"), []
        routed = self.routed(log)
        routed.write.partitionBy("target").option("compression", PACKING).option("maxRecordsPerFile", SCAN_ROWS).parquet(folder)
        routed = self.spark.read.schema(routed.schema).parquet(folder)
        try:
            # as many rows as there are topics
            counted = routed.groupBy("target", "topic").count().collect()
            topics, size = Counter(r["target"] for r in counted), Counter()
            for r in counted:
                size[r["target"]] += r["count"]
            targets, several = list(topics), [t for t, n in topics.items() if n > 1]
            small = [t for t, n in size.items() if n > SCAN_ROWS * self.scans(routed, t)]
            decoded = decode(routed, self.key_decoder, self.value_decoder)
            plans = {t: self.plan(t) for t in targets}
            tables = {t: self.table(t) for t in targets}
            steps = {t: (p.folded, p.merge) for t, p in plans.items()}
            for t, p in plans.items():
                if p.keeps_rejects():
                    judged = p.judged(decoded.filter(decoded["target"] == t))
                    if p.nested() and t not in several:
                        judged = self.judged_once(judged, once)
                        ops = self.unseen(errors.good(judged), tables[t])
                        steps[t] = (lambda _, ops=ops: ops), p.merge
                    self.write_rejects(judged, tables[t], routed, batch, source)
            resolves = {t: p.resolve for t, p in plans.items() if p.resolves()}
            held = {folders.FREED: "true"}
            if small:
                held[folders.SPLIT] = self.split(folder, size, small)
            with folders.settings(self.spark, held):
                apply_targets(tables, decoded, steps, batch, self.fence, source, resolves, several)
        finally:
            for f in (folder, *once):
                folders.remove(self.spark, f)

    def judged_once(self, judged: DataFrame, once: list[str]) -> DataFrame:
        """Operations of documents, stored: their texts are parsed once for the rejects and for what is applied."""
        once.append(folders.shared_folder(self.spark, "judged"))
        judged.write.option("compression", PACKING).parquet(once[-1])
        return self.spark.read.schema(judged.schema).parquet(once[-1])

    def unseen(self, ops: DataFrame, table: BucketTable) -> DataFrame:
        """Operations of records that were not applied before, as `apply_batch` drops the others of a log."""
        seen = table.offsets() if self.fence else None
        return ops if seen is None else after_offsets(ops, seen, seen.count())

    def scans(self, routed: DataFrame, target: str) -> int:
        """Tasks that read the stored log of a target: few, where its records are small."""
        return max(1, routed.filter(routed["target"] == target).rdd.getNumPartitions())

    def split(self, folder: str, sizes: Mapping[str, int], targets: Sequence[str]) -> str:
        """Bytes of the stored log that hold `SCAN_ROWS` records of any of the targets, as its files do."""
        stored = {unquote(n.split("=", 1)[1]): folders.size(self.spark, f"{folder}/{n}") for n in folders.children(self.spark, folder) if "=" in n}
        return str(max(1 << 20, min(stored.get(t, 0) * SCAN_ROWS // sizes[t] * 5 // 4 for t in targets)))

    def write_rejects(
        self, judged: DataFrame, table: BucketTable, routed: DataFrame, batch: int, source: str
    ) -> None:
        """Bad records with their reasons and as they were read, before anything of the batch is applied."""
        bad = errors.rejected(judged).select(*LOG_POSITION, "err")
        raw = routed.select(*LOG_POSITION, *[F.col(c).cast("string").alias(c) for c in ("key", "value")])
        table.reject(bad.join(raw, LOG_POSITION), batch, source, "records")

    def start(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        return apply_stream(stream, lambda log, batch: self.apply(log, batch, checkpoint), checkpoint, **trigger)
