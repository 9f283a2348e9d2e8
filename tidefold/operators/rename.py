"""Field renaming by explicit mapping or by regular expressions.

Names come from the schema, so they are settled when the plan is built; only map
keys are renamed by expressions at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidefold.functions.walk import as_struct


@dataclass(frozen=True)
class ByMapping:
    """`key.a.b` or `value.a.b` to the new last name."""

    names: Mapping[str, str]

    def __bool__(self) -> bool:
        return bool(self.names)

    def name(self, path: str, name: str) -> str:
        return self.names.get(f"{path}.{name}", name)

    def map_key(self, path: str, k: Column) -> Column:
        out = k
        for full, new in self.names.items():
            head, _, last = full.rpartition(".")
            if head == path:
                out = F.when(k == last, F.lit(new)).otherwise(out)
        return out


@dataclass(frozen=True)
class NameRule:
    regexp: str
    pattern: str
    replace: str


@dataclass(frozen=True)
class ByRegExp:
    """Every rule whose regexp matches the whole path edits the name, in the given order."""

    rules: Sequence[NameRule]

    def __bool__(self) -> bool:
        return bool(self.rules)

    def name(self, path: str, name: str) -> str:
        new = name
        for r in self.rules:
            if _matches(r.regexp, f"{path}.{name}"):
                new = _pattern(r.pattern).matcher(new).replaceAll(r.replace)
        return new

    def map_key(self, path: str, k: Column) -> Column:
        new = k
        for r in self.rules:
            hit = F.concat(F.lit(path + "."), k).rlike(f"^(?:{r.regexp})$")
            new = F.when(hit, F.regexp_replace(new, r.pattern, r.replace)).otherwise(new)
        return new


Renamer = ByMapping | ByRegExp


def _pattern(regexp: str):
    """Names of fields are edited by the regular expressions that Spark uses for map keys."""
    return SparkSession.active()._jvm.java.util.regex.Pattern.compile(regexp)


def _matches(regexp: str, text: str) -> bool:
    return _pattern(regexp).matcher(text).matches()


def free_names(names: Sequence[str], wanted: Sequence[str]) -> list[str]:
    """New names; a field whose new name is taken keeps its old one."""
    taken = set(names)
    out = []
    for old, new in zip(names, wanted):
        if new != old and new in taken:
            new = old
        taken.add(new)
        out.append(new)
    return out


def rename_column(col: Column, dtype: T.DataType, path: str, renamer: Renamer) -> Column:
    """Sub-documents are followed under their new name; arrays are left as they are."""
    if isinstance(dtype, T.StructType):
        olds = [f.name for f in dtype.fields]
        news = free_names(olds, [renamer.name(path, n) for n in olds])
        parts = [
            rename_column(col.getField(f.name), f.dataType, f"{path}.{new}", renamer).alias(new)
            for f, new in zip(dtype.fields, news)
        ]
        return as_struct(col, parts)
    if isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType):
        return _rename_keys(col, lambda k: renamer.map_key(path, k))
    return col


def _rename_keys(col: Column, new_key) -> Column:
    """Rename map keys; an entry whose new key is taken, or wanted twice, keeps its old one."""
    keys = F.map_keys(col)

    def settle(news: Column) -> Column:
        def one(k: Column, i: Column) -> Column:
            new = F.get(news, i)
            wanted = F.size(F.filter(news, lambda n: n == new))
            return F.when((wanted == 1) & ~F.array_contains(keys, new), new).otherwise(k)

        return F.map_from_arrays(F.transform(keys, one), F.map_values(col))

    # the lambda argument holds the new keys, so that they are worked out once per map
    return F.transform(F.array(F.transform(keys, new_key)), settle)[0]


def rename(df: DataFrame, renamer: Renamer, columns: Sequence[str] = ("key", "value")) -> DataFrame:
    """Rename inside the key and value documents; paths start with the column name."""
    if not renamer:
        return df
    for c in columns:
        if isinstance(df.schema[c].dataType, (T.StringType, T.BinaryType, T.VariantType)):
            raise ValueError(f"{c} holds no fields that could be renamed: decode it with a schema first")
        df = df.withColumn(c, rename_column(F.col(c), df.schema[c].dataType, c, renamer))
    return df


def lowered(col: Column, dtype: T.StructType) -> Column:
    """A document with its top-level field names in lower case; clashing names are an error."""
    names = [f.name.lower() for f in dtype.fields]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"names differ by case only: {clashes}")
    return as_struct(col, [col.getField(f.name).alias(n) for f, n in zip(dtype.fields, names)])


def lower_case(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, lowered(F.col(column), df.schema[column].dataType))


def lower_case_images(df: DataFrame) -> DataFrame:
    """Lower-case the names of the key and of both images of relational change events."""
    value, env = F.col("value"), df.schema["value"].dataType
    parts = [
        (lowered(value.getField(f.name), f.dataType) if f.name in ("before", "after") and isinstance(f.dataType, T.StructType)
         else value.getField(f.name)).alias(f.name)
        for f in env.fields
    ]
    return lower_case(df, "key").withColumn("value", as_struct(value, parts))
