"""Text functions as Column expressions: names, tags, links, numbers, answers, options, groups."""

from __future__ import annotations

import html

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_name(c: Column) -> Column:
    """Blanks, also ideographic ones, removed; nulls are empty."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[\s　]+", "")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\s　]+|[\s　]+$", "")


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[ \t\n\r\f\x0B]+", " "))


def strip_tags(c: Column) -> Column:
    return collapse(F.regexp_replace(c, r"<[^>]+>", ""))


def unescape_basic(c: Column) -> Column:
    """The five named entities; & last, so that nothing is unescaped twice."""
    for name, value in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(value))
    return c


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'href="([^"]*)"'), F.lit(1))


def table_rows(html: Column) -> Column:
    """Array of rows of cell texts of an HTML table."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    return F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), strip_tags))


def without_tables(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?is)<table.*?</table>", ""), r"\n{3,}", "\n\n")


def question_number(c: Column) -> Column:
    return F.regexp_extract(c, r"[0-9]{1,3}", 0).try_cast("int")


def accepted_answers(c: Column) -> Column:
    """`|` separates accepted answers; `+` stays within one; blank is none."""
    parts = F.filter(F.transform(F.split(c, r"\|"), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.expr("cast(array() as array<string>)")).otherwise(parts)


def answer_letters(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.upper(F.coalesce(c, F.lit(""))), F.lit("[A-D]"), F.lit(0)))


def bracket_balance(c: Column, opening: str = "(", closing: str = ")") -> Column:
    count = lambda x: F.length(c) - F.length(F.replace(c, F.lit(x), F.lit("")))
    return (count(opening) - count(closing)).cast("long")


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the common prefix, 0 if either is empty."""
    n = F.least(F.length(a), F.length(b))
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(30))))  # the greatest equal length, bit by bit
    part = lambda x, at, step: F.substring(x, at + 1, step)
    same = F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= n) & (part(a, at, step) == part(b, at, step)), at + step).otherwise(at))
    return F.when(n > 0, same).otherwise(0).cast("long")


def unescaped(c: Column) -> Column:
    """All named and numeric HTML entities as their characters, in Arrow batches."""

    @F.arrow_udf("string")
    def plain(column: pa.Array) -> pa.Array:
        return pa.array([html.unescape(t) if t and "&" in t else t for t in column.to_pylist()], pa.string())

    return plain(c)


def html_text(c: Column) -> Column:
    """Text of HTML: tags dropped, entities as characters, white space as single blanks."""
    return F.trim(F.regexp_replace(unescaped(F.regexp_replace(c, "<[^>]+>", "")), r"(?U)\s+", " "))


# How stems name a range of questions, and how notes name the answers that are accepted.
GROUP_RANGE = r"第\s*([0-9]{1,3})\s*[至到~～\-－]\s*([0-9]{1,3})\s*題"
CORRECTION_NOTE = r"第\s*([0-9]{1,3})\s*題[^第]*?答\s*([A-E](?:\s*[或、,]\s*[A-E])*)"


def group_ref(text: Column, number: Column) -> Column:
    """qAAA-qBBB of the first range `第a至b題` in text that holds the number."""
    pattern = F.lit(GROUP_RANGE)
    ranges = F.arrays_zip(F.regexp_extract_all(text, pattern, F.lit(1)).alias("a"), F.regexp_extract_all(text, pattern, F.lit(2)).alias("b"))
    held = F.filter(ranges, lambda r: (r["a"].cast("int") <= number) & (number <= r["b"].cast("int")))
    first = F.get(held, F.lit(0))
    pad = lambda x: F.concat(F.lit("q"), F.lpad(x, 3, "0"))
    return F.when(F.size(held) > 0, F.concat(pad(first["a"]), F.lit("-"), pad(first["b"])))


def image_refs(c: Column) -> Column:
    """Paths of Markdown images, then of HTML images."""
    return F.concat(F.regexp_extract_all(c, F.lit(r"!\[[^\]]*\]\(([^)\s]+)\)"), F.lit(1)), F.regexp_extract_all(c, F.lit(r"""(?i)<img[^>]+src=["']([^"']+)["']"""), F.lit(1)))


def correction_notes(c: Column) -> Column:
    """Array of (number, accepted) from notes such as `第2題答A或B者均給分`."""
    pattern = F.lit(CORRECTION_NOTE)
    pairs = F.arrays_zip(F.regexp_extract_all(c, pattern, F.lit(1)).alias("n"), F.regexp_extract_all(c, pattern, F.lit(2)).alias("v"))
    return F.transform(pairs, lambda p: F.struct(p["n"].cast("int").alias("number"), F.regexp_extract_all(p["v"], F.lit("[A-E]"), F.lit(0)).alias("accepted")))


def safe_file_name(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r'[\\/:*?"<>|]+', "_"), r"\s+", " "))


def status_family(c: Column) -> Column:
    return F.substring_index(c, ":", 1)


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def option_texts(block: Column) -> Column:
    """Array of (key, text) of options A-E: text between consecutive markers `(A)` or `A.`, in label order."""
    marked = F.regexp_replace(block, r"(?m)(?:^|\s)\(?([A-E])[).．、]\s*", "\u0001$1\u0002")
    parts = F.filter(F.split(marked, "\u0001"), lambda _, i: i > 0)
    options = F.transform(parts, lambda p: F.struct(F.substring(p, 1, 1).alias("key"), strip(F.substring_index(p, "\u0002", -1)).alias("text")))
    return F.array_sort(options)


def question_blocks(markdown: Column) -> Column:
    """Array of (number, body): a question starts at a line's 1-3 digits with a mark; decimals start none."""
    marked = F.regexp_replace(markdown, r"(?m)^[ \t]*([0-9]{1,3})[.、．](?![0-9])[ \t]*", "\u0001$1\u0002")
    pieces = F.split(marked, "\u0001")
    parts = F.slice(pieces, 2, F.size(pieces))
    return F.transform(parts, lambda p: F.struct(F.substring_index(p, "\u0002", 1).cast("int").alias("number"), strip(F.substring_index(p, "\u0002", -1)).alias("body")))
