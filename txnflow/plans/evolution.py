"""Backward-compatible change of the payload schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def incompatible_changes(old: T.StructType, new: T.StructType) -> list[str]:
    """What readers of `old` would break on: removed or retyped fields, new required ones."""
    before = {f.name: f for f in old.fields}
    after = {f.name: f for f in new.fields}
    found = [f"removed:{n}" for n, f in before.items() if n not in after and not f.nullable]
    found += [f"retyped:{n}" for n, f in before.items() if n in after and after[n].dataType != f.dataType]
    found += [f"required:{n}" for n, f in after.items() if not f.nullable and (n not in before or before[n].nullable)]
    return sorted(found)


def merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """A schema that parses payloads of both versions; refuses incompatible ones."""
    problems = incompatible_changes(old, new)
    if problems:
        raise ValueError(f"incompatible schema change: {', '.join(problems)}")
    return T.StructType([*old.fields, *(f for f in new.fields if f.name not in old.fieldNames())])


def union_versions(*versions: DataFrame) -> DataFrame:
    """Rows of all versions; fields a version lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), versions)
