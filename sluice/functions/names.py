"""Names, labels and paths of catalog files as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import normal_name, strip_tags, unescape_basic


# The notice at the end of answer pages' labels, and what tells markup in a text.
ANSWER_NOTICE = r"\s*本考試所有測\s*驗題標準答案.*$"
MARKUP_HINT = r"(<sub>|<sup>|\\[a-zA-Z]+|[α-ωΑ-ΩⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]|[A-Za-z][0-9][A-Za-z0-9]*|\^[0-9+-]+)"
MARKUP_REVIEW = r"(<sub>|<sup>|\\[a-zA-Z]+|\^[0-9+-]+)"


# Names of examinations that are parts of one group.
GROUP_OVERRIDES = {
    "牙醫師": "牙醫師", "牙醫師（一）": "牙醫師", "牙醫師（二）": "牙醫師", "醫師(一)": "醫師", "醫師(二)": "醫師", "牙醫師(一)": "牙醫師", "牙醫師(二)": "牙醫師", "藥師": "藥師",
    "藥師（一）": "藥師", "藥師（二）": "藥師", "藥師(一)": "藥師", "藥師(二)": "藥師", "中醫師": "中醫師", "中醫師(一)": "中醫師", "中醫師(二)": "中醫師",
}


def group_name(c: Column, overrides: dict[str, str] = GROUP_OVERRIDES) -> Column:
    """The name without blanks, or that of the group that it is part of. The overrides are a map within the plan; nothing is joined."""
    name = normal_name(c)
    named = F.create_map(*(F.lit(x) for pair in overrides.items() for x in pair))
    return F.coalesce(F.try_element_at(named, name), name) if overrides else name


def exam_label(c: Column) -> Column:
    """A label without tags, entities and the trailing notice of answer pages."""
    return F.trim(F.regexp_replace(unescape_basic(strip_tags(c)), ANSWER_NOTICE, ""))


def label_or(label: Column, fallback: Column) -> Column:
    """The fallback label unless it is blank or only says that a code was given; then the cleaned label."""
    clean = strip_tags(F.coalesce(fallback, F.lit("")))
    return F.when((clean != "") & (clean != "指定代號"), clean).otherwise(F.coalesce(F.nullif(exam_label(label), F.lit("")), clean))


def level_and_name(c: Column) -> Column:
    """(level, name) of `level_name`, cut at the first underscore; without one, all is name."""
    clean = strip_tags(c)
    at = F.instr(clean, "_")
    level = F.when(at > 0, F.trim(F.substring(clean, F.lit(1), at - 1))).otherwise("")
    return F.struct(level.alias("level"), F.trim(F.when(at > 0, F.substring(clean, at + 1, F.length(clean))).otherwise(clean)).alias("name"))


def file_part(c: Column) -> Column:
    """A name as part of a path: blanks removed, slashes and the like replaced."""
    return F.regexp_replace(normal_name(c), r'[\\/:*?"<>|]', "_")


def document_path(root: Column, category: Column, year: Column, ordinal: Column, subject: Column, role: Column, collision: Column) -> Column:
    """root/category/year/nth/file: where a document of a category track goes."""
    return F.concat_ws("/", root, file_part(category), year.cast("string"), F.concat(F.lit("第"), ordinal.cast("string"), F.lit("次")), F.concat(
        year.cast("string"), ordinal.cast("string"), F.lit("_"), file_part(category), F.lit("_"), file_part(subject), F.coalesce(collision, F.lit("")), F.coalesce(role, F.lit("")), F.lit(".pdf"),
    ))


def track_path(root: Column, level: Column, label: Column, code: Column, category: Column, year: Column, ordinal: Column, subject: Column, role: Column, collision: Column) -> Column:
    """root/level/label/Ccode_category/year/nth/file: where a document of an official track goes; blanks get a stand-in."""
    part = lambda c, name: F.coalesce(F.nullif(file_part(c), F.lit("")), F.lit(f"no_{name}"))
    folder = F.concat(F.lit("C"), code, F.lit("_"), part(category, "category_name"))
    name = F.concat(year.cast("string"), ordinal.cast("string"), F.lit("_"), folder, F.lit("_"), part(subject, "subject_name"), F.coalesce(collision, F.lit("")), F.coalesce(role, F.lit("")), F.lit(".pdf"))
    return F.concat_ws("/", root, part(level, "exam_level"), part(label, "category_label"), folder, year.cast("string"), F.concat(F.lit("第"), ordinal.cast("string"), F.lit("次")), name)


def has_collision_suffix(path: Column) -> Column:
    """Whether a file name ends with the code that tells two equal names apart."""
    return F.substring_index(path, "/", -1).rlike(r"_E[0-9]{5,6}(_ANS|_MOD)?\.pdf$")


def relative_to(path: Column, root: str) -> Column:
    """The path below root, or the whole path if it lies elsewhere."""
    below = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(below)), F.substring(path, F.lit(len(below) + 1), F.length(path))).otherwise(path)


def is_safe_path(path: Column) -> Column:
    """A relative path that never leaves its root: no leading slash, no parent step."""
    return (path != "") & ~F.startswith(path, F.lit("/")) & ~path.rlike(r"(^|/)\.\.(/|$)")


def markup_payload(c: Column) -> Column:
    """(plain, needs_review) of a text with formulas, scripts or Greek letters; null of others."""
    return F.when(c.rlike(MARKUP_HINT), F.struct(c.alias("plain"), c.rlike(MARKUP_REVIEW).alias("needs_review")))
