"""Writers: fixed-field CSV, sorted-key JSON lines, appends, schema evolution, versioned rewrites, count reports."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType


def write_csv(df: DataFrame, path: str, fields: Sequence[str], mode: str = "error") -> None:
    """The given fields in order, others left out; missing ones are empty."""
    df.select(*((F.col(f) if f in df.columns else F.lit("")).alias(f) for f in fields)).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def in_key_order(c: Column, kind: DataType) -> Column:
    """The value with the fields of all its structs in order of their names."""
    if isinstance(kind, StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return F.when(c.isNotNull(), F.struct(*(in_key_order(c.getField(f.name), f.dataType).alias(f.name) for f in fields)))
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: in_key_order(x, kind.elementType))
    return c


def write_jsonl(df: DataFrame, path: str, mode: str = "error") -> None:
    """JSON lines with keys in order at every depth, nulls written, characters kept as they are."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    df.select(*(in_key_order(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields)).write.mode(mode).option("ignoreNullFields", False).json(path)


def append_events(df: DataFrame, path: str) -> None:
    write_jsonl(df, path, "append")


def stage_text(df: DataFrame) -> DataFrame:
    """Bronze form: every column as text, null as the empty string."""
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns))


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Silver form: blank is null, then a cast that yields null where it fails."""
    return df.select(*((F.nullif(F.col(c), F.lit("")).try_cast(types[c]) if c in types else F.nullif(F.col(c), F.lit(""))).alias(c) for c in df.columns))


def evolve(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns that df lacks, added as null."""
    return df.select("*", *(F.lit(None).cast(t).alias(c) for c, t in columns.items() if c not in df.columns))


def rewrite_versioned(df: DataFrame, base: str) -> str:
    """Write a new version beside the old ones and return its path; nothing is overwritten."""
    path = f"{base.rstrip('/')}/v={time.time_ns()}"
    df.write.parquet(path)
    return path


def count_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n) of every table, in order."""
    out = None
    for name, df in sorted(tables.items()):
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out.orderBy("table_name")


def constraint_violations(df: DataFrame, unique: Sequence[Sequence[str]] = (), allowed: dict[str, Sequence] | None = None, references: dict[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """(violated, n) for unique keys, value lists and references; all n must be 0."""
    parts = [df.groupBy(*k).count().filter("count > 1").agg(F.count(F.lit(1)).alias("n")).select(F.lit("unique " + ", ".join(k)).alias("violated"), "n") for k in unique]
    parts += [df.filter(~F.col(c).isin(*v)).agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"values {c}").alias("violated"), "n") for c, v in (allowed or {}).items()]
    parts += [df.filter(F.col(c).isNotNull()).join(t.select(F.col(k).alias(c)).distinct(), c, "left_anti").agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"reference {c}").alias("violated"), "n") for c, (t, k) in (references or {}).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
