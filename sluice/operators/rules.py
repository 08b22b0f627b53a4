"""Rules as one projection: an array of conditions becomes issue rows, labels, reasons or a status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .logs import quality_status

#: Severities in rising order; `blocked` counts as `error`.
SEVERITY_RANK = {"info": 0, "warning": 1, "error": 2, "blocked": 2}


def rules_to_issues(df: DataFrame, keys: Sequence[str], rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """(keys, issue_code, severity) for each rule (code, severity, condition) that holds; one scan, no join."""
    hits = F.array(*(F.when(cond, F.struct(F.lit(code).alias("issue_code"), F.lit(severity).alias("severity"))) for code, severity, cond in rules))
    return df.select(*keys, F.inline(F.filter(hits, lambda x: x.isNotNull())))


def severity_rank(severity: Column) -> Column:
    rank = F.lit(0)
    for name, value in SEVERITY_RANK.items():
        rank = F.when(severity == name, value).otherwise(rank)
    return rank


def status_of_issues(candidates: DataFrame, issues: DataFrame, key: str) -> DataFrame:
    """key, issue_count and quality_status from the greatest severity; without issues: 0 and pass."""
    per = issues.groupBy(key).agg(F.count(F.lit(1)).alias("issue_count"), F.max(severity_rank(F.col("severity"))).alias("rank"))
    return candidates.select(key).join(per, key, "left").select(key, F.coalesce("issue_count", F.lit(0)).alias("issue_count"), quality_status(F.coalesce("rank", F.lit(0))).alias("quality_status"))


def status_by_rules(df: DataFrame, keys: Sequence[str], rules: Sequence[tuple[str, str, Column]], keep: Sequence[str] = ()) -> DataFrame:
    """keys, issue_count, quality_status and the columns in keep, from the rules (code, severity, condition) of each row: no shuffle."""
    ranks = F.array_compact(F.array(*(F.when(cond, F.lit(SEVERITY_RANK[severity])) for _, severity, cond in rules)))
    rows = df.select(*keys, *keep, ranks.alias("__r"))
    return rows.select(*keys, *keep, F.size("__r").cast("long").alias("issue_count"), quality_status(F.coalesce(F.array_max("__r"), F.lit(0))).alias("quality_status"))


def labels(rules: Sequence[tuple[str, Column]]) -> Column:
    """Sorted array of the names of the rules that hold."""
    return F.array_sort(F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in rules))))


def reasons(rules: Sequence[tuple[str, Column]], separator: str = ";") -> Column:
    """Names of the rules that hold, in the rules' order, joined."""
    return F.concat_ws(separator, *(F.when(c, F.lit(n)) for n, c in rules))


def top_reasons(df: DataFrame, column: str, k: int, separator: str = ";") -> DataFrame:
    """The k most frequent reasons of a joined column, ties by name."""
    each = df.select(F.explode(F.split(column, separator)).alias("reason")).filter("reason <> ''")
    return each.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason").limit(k)


def gate(reason: Column) -> Column:
    return F.when(reason == "", "ready").otherwise("blocked")


def apply_correction(candidate: dict[str, Column], correction: dict[str, Column], append: Sequence[str] = ()) -> dict[str, Column]:
    """Fields of a candidate with those of a correction over them where present; `append` arrays are joined."""
    out = dict(candidate)
    for name, value in correction.items():
        out[name] = F.concat(candidate[name], F.coalesce(value, F.array())) if name in append else F.coalesce(value, candidate[name])
    return out


def sheet_status(block: Column, review: Column, accepted: Column, total: Column, reviewed: Column) -> Column:
    """block > needs_review > all accepted > some reviewed > null."""
    return F.when(block > 0, "block").when(review > 0, "needs_review").when(accepted == total, "accept").when(reviewed > 0, "reviewed")
