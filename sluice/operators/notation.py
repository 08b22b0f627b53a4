"""Audit of candidates' notation: what differs from its normal form, what looks like lost markup, what a parser broke.

Findings are a table of rules in order, each a condition with its evidence; labels, status and the suggested correction
follow from the findings. The normal form comes from Arrow batches, all else is one projection of built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.notation import candidate_notation, candidate_notation_all

# Patterns in which blood groups and haematology lose their markup, in order; letters in either case.
BLOOD_CHANGE = r"\b(?:Anti[- ]?)?(?:Fy|Jk|JK|Le|Lu|Di|Mi|Kp|C)\s*[abcw]\b|\bRh\s*null\b|\b(?:A|B)(?:\s+)?(?:el|end|m)\b"
BLOOD_PATTERNS = (
    r"\b(?:Anti[- ]?)?(?:Fy|Jk|JK|Le|Lu|Di|Mi|Kp|C)\s+[abcw]\b",
    r"\b(?:Rh\s*null|Rhnull)\b",
    r"\b(?:A|B)(?:\s+)?(?:el|end|m)\b",
    r"\b(?:BFU|CFU)\s+E\b",
    r"\bweak\s+D\s*\(\s*D\s*u\s*\)",
    r"\banti-PP₁P\s*k\b",
    r"\\zeta|\\gamma|\^\{\\circ\}",
)
EVIDENCE_CHARS, EVIDENCE_MOST = 240, 5
EITHER_CASE = "(?iuU)"  # and words, digits and white space as in Unicode


def _first(text: Column, pattern: str) -> Column:
    """The first match, null without one."""
    return F.regexp_substr(text, F.lit(EITHER_CASE + pattern))


def audited_notation(df: DataFrame, stem: str = "stem", options: str = "options", number: str = "question_number", has_image: str = "has_image") -> DataFrame:
    """df's candidates that have a finding, with `audit`: status, confidence, labels, evidence, recommended_action, findings, correction.

    options: an array of structs with key and text. A correction holds the normal stem if it differs, and all options with
    their normal texts if one differs.
    """
    none = F.array().cast("array<string>")
    texts = F.coalesce(F.transform(options, lambda o: F.struct(F.coalesce(o["key"], F.lit("")).alias("key"), F.coalesce(o["text"], F.lit("")).alias("text"))), F.expr("cast(array() as array<struct<key:string,text:string>>)"))
    base = df.withColumns({"__stem": F.coalesce(stem, F.lit("")), "__options": texts}).withColumn("__texts", F.transform("__options", lambda o: o["text"]))
    base = base.withColumns({"__normal": candidate_notation(F.col("__stem")), "__normals": candidate_notation_all(F.col("__texts"))})
    base = base.withColumn("__all", F.concat_ws("\n", F.array("__stem"), "__texts"))

    keys = F.transform("__options", lambda o: o["key"])
    changed = F.filter(F.transform(F.arrays_zip(keys.alias("key"), F.col("__texts").alias("old"), F.col("__normals").alias("new")), lambda o: F.when(o["old"] != o["new"], F.concat(F.lit("option "), o["key"]))), lambda x: x.isNotNull())
    changes = F.array_sort(F.array_distinct(F.concat(changed, F.when(F.col("__normal") != F.col("__stem"), F.array(F.lit("stem"))).otherwise(none))))
    after = (F.coalesce(F.col(number).cast("long"), F.lit(0)) + 1).cast("string")
    boundary = F.regexp_substr("__all", F.concat(F.lit(r"(?uUd)\n\s*"), after, F.lit(r"[\.．、]\s*\S.{0,80}")))
    base = base.withColumns({
        "__changes": changes, "__change": _first(F.col("__all"), BLOOD_CHANGE), "__blood": F.coalesce(*(_first(F.col("__all"), p) for p in BLOOD_PATTERNS)),
        "__keys": keys, "__next": F.when(after != "1", boundary), "__table": F.contains(F.lower("__all"), F.lit("<table")),
    })

    changed, blood, parsed = F.size("__changes") > 0, F.col("__blood").isNotNull(), F.col("__next").isNotNull()
    odd_options = ~F.size("__keys").isin(4, 5) | (F.size(F.array_distinct("__keys")) < F.size("__keys"))
    empty = F.exists("__texts", lambda t: F.trim(F.translate(t, "\t\n\x0b\x0c\r　", "      ")) == "")
    rules = (
        (changed, "hematology_notation_normalized", "warning", "text", F.array_join("__changes", "; "), ("science_notation_suspect",)),
        (blood, "hematology_symbol_suspect", "warning", "text", F.col("__blood"), ("science_notation_suspect", "blood_group_symbol_suspect")),
        (odd_options, "option_structure_suspect", "error", "options", F.to_json("__keys"), ("option_parse_suspect", "block_likely")),
        (empty, "empty_option_text", "error", "options", F.lit("empty option"), ("option_parse_suspect", "block_likely")),
        (parsed, "next_question_inside_candidate", "error", "text", F.col("__next"), ("parser_boundary_suspect", "block_likely")),
        (F.col("__table"), "structured_table_needs_visual_review", "warning", "stem", F.lit("<table>"), ("table_or_image_suspect",)),
    )
    finding = lambda code, severity, field, evidence: F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.lit(field).alias("field"), F.substring(evidence, 1, EVIDENCE_CHARS).alias("evidence"))
    findings = F.array_compact(F.array(*(F.when(ok, finding(code, severity, field, evidence)) for ok, code, severity, field, evidence, _ in rules)))
    labels = F.flatten(F.array(*(F.when(ok, F.array(*map(F.lit, names))).otherwise(none) for ok, *_, names in rules), F.when(changed & F.col("__change").isNotNull(), F.array(F.lit("blood_group_symbol_suspect"))).otherwise(none), F.array(F.lit("needs_human_review"))))
    blocked = odd_options | empty | parsed
    action = F.when(blocked, "fix_parser_rule").when(F.col("__table"), F.when(F.coalesce(F.col(has_image), F.lit(False)), "human_review_pdf_visual").otherwise("add_manual_asset")).otherwise("human_review_text")
    new_options = F.transform(F.arrays_zip(F.col("__keys").alias("key"), F.col("__normals").alias("text")), lambda o: F.struct(o["key"].alias("key"), o["text"].alias("text")))
    correction = F.struct(F.when(F.col("__normal") != F.col("__stem"), F.col("__normal")).alias("stem"), F.when(F.col("__texts") != F.col("__normals"), new_options).alias("options"))
    audit = F.struct(
        F.when(blocked, "block").otherwise("needs_review").alias("status"), F.when(changed, 0.82).otherwise(0.7).alias("confidence"), F.array_sort(F.array_distinct(labels)).alias("labels"),
        F.transform(F.slice("__findings", 1, EVIDENCE_MOST), lambda x: F.struct(x["field"].alias("field"), x["evidence"].alias("value"))).alias("evidence"),
        action.alias("recommended_action"), F.col("__findings").alias("findings"), F.when(changed, correction).alias("correction"),
    )
    return base.withColumn("__findings", findings).filter(F.size("__findings") > 0).select(*df.columns, audit.alias("audit"))
