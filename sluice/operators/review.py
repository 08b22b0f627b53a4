"""Review-specific rules over nested candidates: answers, verdicts, overlays, sheets, batches, repairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import accepted_answers, answer_letters
from .reconcile import reconciled  # noqa: F401

# Verdicts that imported audits use, and what they count as.
VERDICTS = {"pass": "pass", "ok": "pass", "accept": "pass", "needs_review": "needs_review", "review": "needs_review", "block": "block", "blocked": "block", "fail": "block"}
ANSWER_CODES = ("missing_answer", "missing_answer_markdown", "unexpected_answer_value")


def resolved_answer(corrected: Column, reviewed: Column, parsed: Column) -> Column:
    """Corrected over reviewed over parsed; blanks do not count. Of alternatives the first."""
    text = F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in (corrected, reviewed, parsed)))
    return F.substring_index(text, "|", 1)


def answer_payload(answer: Column, raw: Column) -> Column:
    values = accepted_answers(answer)
    return F.struct(answer.alias("answer"), values.alias("accepted_values"), raw.alias("raw_answer"), (F.size(values) > 1).alias("is_special_correction"))


def answer_hint(parsed: Column, reviewed: Column, has_special: Column) -> Column:
    """Severity and flags of an answer that needs a look."""
    letters = answer_letters(parsed)
    flags = F.array_compact(F.array(
        F.when(F.coalesce(F.trim(parsed), F.lit("")) == "", "missing"), F.when(F.contains(parsed, F.lit("#")), "unresolved_mark"), F.when(F.size(letters) > 1, "several"),
        F.when(has_special, "special"), F.when(reviewed.isNotNull() & (reviewed != parsed), "differs_from_review"),
    ))
    severity = F.when(F.array_contains(flags, "missing") | F.array_contains(flags, "unresolved_mark"), "error").when(F.size(flags) > 0, "warning").otherwise("info")
    return F.struct(severity.alias("severity"), flags.alias("flags"))


def effective_verdict(status: Column, labels: Column, changes: Column, deferred: Sequence[str]) -> Column:
    """A verdict whose labels are all deferred passes; a pass that still lists changes needs review."""
    only_deferred = (F.size(labels) > 0) & (F.size(F.array_except(labels, F.array(*map(F.lit, deferred)))) == 0)
    return F.when(status == "block", "block").when(only_deferred, "pass").when((status == "pass") & (F.size(changes) > 0), "needs_review").otherwise(status)


def normal_verdict(df: DataFrame, status: str, confidence: str, labels: str, known: Sequence[str], default_label: str) -> DataFrame:
    """Imported results: mapped status, known labels (or the default), confidence between 0 and 1."""
    mapped = F.lit("needs_review")
    for name, value in VERDICTS.items():
        mapped = F.when(F.lower(F.trim(status)) == name, value).otherwise(mapped)
    good = F.array_intersect(F.coalesce(labels, F.array().cast("array<string>")), F.array(*map(F.lit, known)))
    number = F.col(confidence).cast("string").try_cast("double")
    return df.withColumns({status: mapped, labels: F.when(F.size(good) > 0, good).otherwise(F.array(F.lit(default_label))), confidence: F.when(number.isNotNull(), F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), number)), 3))})


def merged_options(options: Column, corrections: Column) -> Column:
    """Union by key, corrections last and winning, in order of keys; arrays of (key, text)."""
    clean = F.filter(F.transform(F.coalesce(corrections, F.array().cast("array<struct<key:string,text:string>>")), lambda o: F.struct(F.upper(F.substring(o["key"], 1, 1)).alias("key"), o["text"].alias("text"))), lambda o: o["key"] != "")
    kept = F.filter(options, lambda o: ~F.exists(clean, lambda c: c["key"] == o["key"]))
    return F.array_sort(F.concat(kept, clean))


def usable_assets(refs: Column) -> Column:
    """References that are not known to be missing or empty; structs (path, exists, bytes)."""
    return F.filter(refs, lambda r: (r["path"] != "") & F.coalesce(r["exists"], F.lit(True)) & (F.coalesce(r["bytes"], F.lit(1)) > 0))


def asset_kind(role: Column, mime: Column) -> Column:
    text = F.lower(F.concat_ws(" ", role, mime))
    out = F.lit("other")
    for word, kind in reversed((("image", "image"), ("pdf", "pdf"), ("markdown", "markdown"), ("json", "json"))):
        out = F.when(F.contains(text, F.lit(word)), kind).otherwise(out)
    return out


def promoted(ready: DataFrame) -> dict[str, DataFrame]:
    """Rows of the formal tables from ready candidates (candidate_key, source, group_ref, stem, options, answer, refs)."""
    return {
        "groups": ready.filter("group_ref is not null").select("source", "group_ref").distinct(),
        "questions": ready.select("candidate_key", "source", "group_ref", "stem"),
        "options": ready.select("candidate_key", F.posexplode("options").alias("i", "o")).select("candidate_key", (F.col("i") + 1).alias("option_order"), F.col("o.key").alias("option_label"), F.col("o.text").alias("option_text")),
        "answers": ready.select("candidate_key", F.explode(accepted_answers(F.col("answer"))).alias("answer_value")),
        "assets": ready.select("candidate_key", F.posexplode(usable_assets(F.col("refs"))).alias("i", "r")).select("candidate_key", "i", F.col("r.path").alias("path")),
    }


def reset_events(latest: DataFrame, keys: DataFrame, key: str, note: str) -> DataFrame:
    """A reset for each key that has a latest event, carrying what it replaces."""
    return latest.join(keys.select(key).distinct(), key, "left_semi").select(key, F.lit("reset_review").alias("action"), F.col("action").alias("previous_action"), F.col("notes").alias("previous_notes"), F.lit(note).alias("notes"))


def patched(df: DataFrame, patches: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Values of a patch table (key, field, value) over df's text columns; a repeated field takes its greatest seq."""
    wide = patches.groupBy(key).agg(*(F.max_by(F.when(F.col("field") == c, F.struct("value")), F.when(F.col("field") == c, F.col("seq"))).alias(f"__p_{c}") for c in columns))
    joined = df.join(wide, key, "left")
    return joined.select(*(F.when(F.col(f"__p_{c}").isNotNull(), F.col(f"__p_{c}.value")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns))


def planned_batches(rows: DataFrame, done: DataFrame, reserved: DataFrame, path: str, order: Sequence[Column], size: int, group: str) -> DataFrame:
    """Unfinished, unreserved rows, first of each path, numbered in batches of `size` within each group."""
    todo = rows.join(done.select(path).distinct(), path, "left_anti").join(reserved.select(path).distinct(), path, "left_anti")
    first = todo.withColumn("__rn", F.row_number().over(Window.partitionBy(path).orderBy(*order))).filter("__rn = 1").drop("__rn")
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return first.withColumn("batch", (F.floor((place - 1) / size) + 1).cast("int"))
