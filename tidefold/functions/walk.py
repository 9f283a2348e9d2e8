"""Rebuild a nested column from its schema when the plan is built.

Projection and renaming are decided once per schema field, never per row.  Only
the keys of MAP columns, which no schema lists, are tested at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

DOC, DOCS, LEAF = "doc", "docs", "leaf"


def kind(dtype: T.DataType) -> str:
    """doc: a sub-document, docs: an array of them, leaf: anything else."""
    if isinstance(dtype, (T.StructType, T.MapType)):
        return DOC
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, (T.StructType, T.MapType)):
        return DOCS
    return LEAF


def as_struct(source: Column, parts: list[Column]) -> Column:
    """Struct of the parts, null where the source document is null."""
    return F.when(source.isNotNull(), F.struct(*parts))


def null_of(dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype)
