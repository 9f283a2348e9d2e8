"""The plan of one target: from decoded log records to folded changes.

Plain records go through the processors and a write model, change events through
the handler of their source.  Handlers see the record as it was decoded: processors
do not run in change-event mode.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field as attribute
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidefold.functions import ids
from tidefold.operators import (
    cdc_document, cdc_relational, errors, evolve, fold, fold_nested, keyless, merge, meta, project, refuse, rename, writemodel,
)
from tidefold.model import ID, LOG_POSITION, PRESENT
from tidefold.plans.settings import Settings

Step = Callable[[DataFrame], DataFrame]

SQL_DIALECTS = ("relational", "mysql", "postgres")
DOCUMENT_SOURCES = ("document",)
ID_STEP = "id"


@dataclass
class Registry:
    """Own steps, id strategies, write models and change-event operations, by name."""

    steps: dict[str, Step] = attribute(default_factory=dict)
    id_strategies: dict[str, ids.IdStrategy] = attribute(default_factory=dict)
    write_models: dict[str, writemodel.WriteModel] = attribute(default_factory=dict)
    operations: dict[str, Mapping[str, cdc_relational.Built]] = attribute(default_factory=dict)


@dataclass
class TargetPlan:
    settings: Settings
    target: str = ""
    kind: str = "document"
    now: Column | None = None
    row_keys: list[str] = attribute(default_factory=list)
    registry: Registry = attribute(default_factory=Registry)

    # -- parts --------------------------------------------------------------

    def handler(self) -> str:
        name = self.settings.get("cdc.handler", self.target)
        known = (*SQL_DIALECTS, *DOCUMENT_SOURCES, *self.registry.operations)
        if name and name not in known:
            raise ValueError(f"unknown change-event handler {name!r}")
        return name

    def id_strategy(self) -> ids.IdStrategy:
        name = self.settings.get("id.strategy", self.target)
        if name in self.registry.id_strategies:
            return self.registry.id_strategies[name]
        return ids.strategy(name, self.settings.projection("key", self.target))

    def steps(self) -> list[Step]:
        """The processors in order, each once; the id step comes first unless it is placed."""
        names = list(dict.fromkeys(self.settings.names("processors", self.target)))
        if ID_STEP not in names:
            names.insert(0, ID_STEP)
        return [self.step(n) for n in names]

    def step(self, name: str) -> Step:
        if name in self.registry.steps:
            return self.registry.steps[name]
        side, _, what = name.partition(".")
        if what == "projection" and side in ("key", "value"):
            return partial(project.project, column=side, matcher=self.settings.projection(side, self.target))
        known: dict[str, Callable[[], Step]] = {
            ID_STEP: lambda: partial(ids.add_id, id_strategy=self.id_strategy()),
            "rename.mapping": lambda: partial(rename.rename, renamer=self.settings.mapping(self.target)),
            "rename.regexp": lambda: partial(rename.rename, renamer=self.settings.regexps(self.target)),
            "log.metadata": lambda: meta.add_log_metadata,
            "lower.case": lambda: partial(rename.lower_case, column="value"),
        }
        if name not in known:
            raise ValueError(f"unknown processor {name!r}")
        return known[name]()

    def time(self) -> Column:
        """Time of the run: a parameter, so that a run can be repeated."""
        return self.now if self.now is not None else F.current_timestamp()

    def write_model(self) -> writemodel.WriteModel:
        name = self.settings.get("write.model", self.target)
        if name in self.registry.write_models:
            return self.registry.write_models[name]
        now = self.time()
        known = {
            "replace": writemodel.replace_by_id,
            "business_key": writemodel.replace_by_business_key,
            "timestamps": writemodel.set_with_timestamps(now),
            "row_upsert": writemodel.row_upsert(self.row_keys),
            "row_upsert_timestamp": writemodel.row_upsert(self.row_keys, F.unix_millis(now.cast("timestamp"))),
        }
        if name not in known:
            raise ValueError(f"unknown write model {name!r}")
        return known[name]

    def delete_model(self) -> writemodel.WriteModel | None:
        if not self.settings.flag("delete.on.null", self.target):
            return None
        if self.kind == "row":
            return writemodel.row_delete(self.row_keys)
        how = self.settings.get("delete.model", self.target)
        if how == "key":
            return writemodel.delete_by_key
        if how != "id":
            raise ValueError(f"unknown delete model {how!r}")
        name = self.settings.get("id.strategy", self.target)
        if name not in ids.KEY_BASED and name not in self.registry.id_strategies:
            raise ValueError(f"deletes need an id strategy based on the key, not {name!r}")
        return writemodel.delete_by_id(self.id_strategy())

    # -- the plan -----------------------------------------------------------

    def process(self, log: DataFrame) -> DataFrame:
        df = reduce(_step, self.steps(), log)
        return _step(df, partial(rename.lower_case, column="value")) if self.lowers() else df

    def lowers(self) -> bool:
        return self.settings.flag("lower.case.names", self.target)

    def keyless(self) -> bool:
        """Whether the source table has no key: rows are known by their image, and counted."""
        return self.settings.flag("keyless", self.target)

    def nested(self) -> bool:
        """Whether changes are patches of documents, which address fields by dotted paths."""
        return self.handler() in DOCUMENT_SOURCES and self.kind == "document"

    def judged(self, log: DataFrame) -> DataFrame:
        """Operations of all records, the reason of bad ones in `err`."""
        handler = self.handler()
        if handler in DOCUMENT_SOURCES:
            ops = cdc_document.document_ops(log, self.kind)
            ops = _lower_fields(ops) if self.lowers() else ops
            return fold_nested.check_paths(ops) if self.nested() else ops
        if handler and self.lowers():
            log = rename.lower_case_images(log)
        if handler and self.keyless():
            return keyless.image_ops(log)
        if handler:
            return cdc_relational.relational_ops(log, self.kind, self.registry.operations.get(handler))
        return writemodel.write_ops(self.process(log), self.write_model(), self.delete_model())

    def operations(self, log: DataFrame) -> DataFrame:
        """Operations of the records, bad ones settled as `on.error` says."""
        return errors.settle(self.judged(log), self.settings.get("on.error", self.target))

    def keeps_rejects(self) -> bool:
        return self.settings.get("on.error", self.target) == "reject"

    def rejects(self, log: DataFrame) -> DataFrame:
        """Log position and reason of the bad records."""
        return errors.rejected(self.judged(log)).select(*LOG_POSITION, "err")

    def resolves(self) -> bool:
        """Whether changes depend on what the target holds before they can be folded."""
        return self.nested() or self.keyless()

    def resolve(self, target: DataFrame | None, ops: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """One change per key of the patches that the stored documents take, and the refused ones; or images not there."""
        if self.keyless():
            if not self.keeps_rejects():
                return ops, None
            bad = errors.rejected(keyless.merge_images(target if target is not None else ops.limit(0), ops))
            return ops, bad.select("k", "err", F.to_json("doc").alias("value"))
        ops = refuse.with_refusals(ops, target)
        if not self.keeps_rejects():
            return fold_nested.fold_writes(errors.fail_fast(ops)), None
        return fold_nested.fold_writes(errors.good(ops)), errors.rejected(ops).select(*LOG_POSITION, "k", "err")

    def folded(self, log: DataFrame) -> DataFrame:
        """One change per key; the operations themselves where `resolve` folds them."""
        ops = self.operations(log)
        if self.nested():
            return ops
        if self.keyless():
            return keyless.fold_images(ops)
        if "sets" in ops.columns:
            return fold.fold_fields(ops)
        model = self.settings.get("write.model", self.target)
        partial_rows = self.kind == "row" or (not self.handler() and model == "timestamps")
        if partial_rows:
            return fold.fold_columns(ops, mixed_upserts=bool(self.handler()))
        return fold.fold_latest(ops)


    def merge(self, target: DataFrame | None, delta: DataFrame) -> DataFrame:
        """Rows of the target after the changes of `folded`; a missing target is empty."""
        if self.nested():
            delta = delta if "writes" in delta.columns else self.resolve(target, delta)[0]
            empty = delta.select("k", F.lit("").alias("doc")).limit(0)
            rows = fold_nested.merge_paths(target if target is not None else empty, delta)
            return errors.fail_fast(rows)
        if self.keyless():
            rows = keyless.merge_images(target if target is not None else delta.limit(0), delta)
            return errors.good(rows) if self.keeps_rejects() else errors.fail_fast(rows)
        if "sets" in delta.columns and self.kind == "row":
            delta = evolve.written_columns(delta, target.schema["doc"].dataType if target is not None else None)
        elif "sets" in delta.columns:
            empty = delta.select("k", F.lit("").alias("doc")).limit(0)
            return merge.merge_fields(target if target is not None else empty, delta)
        model = self.settings.get("write.model", self.target)
        if "cols" in delta.columns:
            cols = [F.col("cols").getField(c).getField("v").alias(c) for c in delta.schema["cols"].dataType.names]
            empty = delta.select("k", F.struct(*cols).alias("doc")).limit(0)
            stamp = not self.handler() and model == "timestamps"
            on_insert = {writemodel.INSERTED: self.time()} if stamp else None
            return merge.merge_columns(target if target is not None else empty, delta, on_insert=on_insert)
        empty = delta.select("k", "doc").limit(0)
        if not self.handler() and model == "business_key":
            # made from the key and the place of its first record: the same on every replay
            new_id = F.substring(F.sha2(F.to_json(F.struct("d.k", "d.ord")), 256), 1, 24)
            empty = empty.withColumn(ID, F.lit(None).cast("string"))
            return merge.merge_latest(target if target is not None else empty, delta, generated_id=new_id)
        return merge.merge_latest(target if target is not None else empty, delta)


def _step(df: DataFrame, step: Step) -> DataFrame:
    """Run a step; the names of the fields a record holds follow their renames, and fields the step adds are held."""
    out = step(df)
    if PRESENT not in out.columns or not all(isinstance(d.schema["value"].dataType, T.StructType) for d in (df, out)):
        return out
    old, new = (d.schema["value"].dataType.names for d in (df, out))
    if old == new:
        return out
    renamed = {a: b for a, b in zip(old, new) if a != b} if len(old) == len(new) and set(old) != set(new) else {}
    added = [n for n in new if n not in old and n not in renamed.values()]
    present = F.col(PRESENT)
    if renamed:
        names = F.create_map(*[F.lit(x) for pair in renamed.items() for x in pair])
        present = F.transform(present, lambda n: F.coalesce(names[n], n))
    return out.withColumn(PRESENT, F.concat(present, F.array(*[F.lit(n) for n in added]).cast("array<string>")))


def _lower_fields(ops: DataFrame) -> DataFrame:
    """Lower-case the fields that document changes write and remove."""
    first = lambda p: F.concat_ws(".", F.lower(F.split(p, r"\.")[0]), F.slice(F.split(p, r"\."), 2, F.size(F.split(p, r"\."))))
    return ops.withColumn("sets", F.transform_keys("sets", lambda k, _: first(k))).withColumn("unsets", F.transform("unsets", first))


def plans_for(settings: Settings, **common) -> dict[str, TargetPlan]:
    """One plan per listed target, and one under "" for all others."""
    return {name: TargetPlan(settings, name, **common) for name in ["", *settings.targets()]}
