"""From Markdown to candidates: blocks, options, normal texts, images, answers and issues, as one plan.

Blocks come out of each document by built-in functions, the run of options by one scan in Arrow batches, notation by the steps of
functions.notation. Documents stay where they are until numbers are counted within them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names, ocr
from ..functions.questions import with_question
from . import bank as B
from .rules import severity_rank

# How Markdown and HTML refer to images.
IMAGE = r"!\[[^\]]*\]\(([^)]+)\)"
HTML_IMAGE = r"""(?i)<img[^>]+src=["']([^"']+)["']"""


def question_blocks(documents: DataFrame, key: str, markdown: str, year: Column) -> DataFrame:
    """(key, place, number, body) of every question's block; merged blocks are cut, headers left out."""
    blocks = documents.select(key, F.posexplode(ocr.split_merged(ocr.blocks_by_year(F.col(markdown), year))).alias("place", "b")).select(key, "place", "b.number", "b.body")
    return blocks.filter(~ocr.is_header(F.col("body")))


def _with_assets(parsed: DataFrame, key: str, assets: DataFrame | None) -> DataFrame:
    """image_refs (path, exists, bytes) of each block, in order; what is known of a path comes from `assets` (path, bytes)."""
    ref = lambda p, exists, size: F.struct(p.alias("path"), exists.alias("exists"), size.cast("bigint").alias("bytes"))
    if assets is None:
        return parsed.withColumn("image_refs", F.transform("__paths", lambda p: ref(p, F.lit(None).cast("boolean"), F.lit(None))))
    one = parsed.filter(F.size("__paths") > 0).select(key, "place", F.posexplode("__paths").alias("i", "path"))
    known = one.join(assets.groupBy("path").agg(F.max("bytes").alias("bytes"), F.lit(True).alias("there")), "path", "left")
    refs = known.groupBy(key, "place").agg(F.array_sort(F.collect_list(F.struct("i", ref(F.col("path"), F.coalesce("there", F.lit(False)), F.col("bytes")).alias("ref")))).alias("x"))  # images of one block
    joined = parsed.join(refs.select(key, "place", F.transform("x", lambda x: x["ref"]).alias("image_refs")), [key, "place"], "left")
    return joined.withColumn("image_refs", F.coalesce("image_refs", F.array().cast(f"array<{B.REF}>")))


def parsed_candidates(documents: DataFrame, key: str, markdown: str, answers: str, year: Column, assets: DataFrame | None = None) -> DataFrame:
    """Candidates of documents that have a question's and an answer's Markdown; (issue_code, severity) arrays in `issues`.

    candidate_key is `key:q001`, with :dup02 and so on for a number that comes again; answers go by number. A document with
    several candidates of a number, or with numbers that lack, has issues of its own, the latter at its first candidate.
    Other documents have rows in B.document_failures alone.
    """
    complete = documents.filter(F.col(markdown).isNotNull() & F.col(answers).isNotNull())
    blocks = question_blocks(complete, key, markdown, year)
    images = F.concat(F.regexp_extract_all("body", F.lit(IMAGE), F.lit(1)), F.regexp_extract_all("body", F.lit(HTML_IMAGE), F.lit(1)))
    parsed = with_question(blocks, "number", "body").withColumns({"__paths": images, "raw_block": F.trim("body")})
    parsed = parsed.withColumn("__texts", ocr.normal_texts(F.concat(F.array("stem"), F.transform("options", lambda o: o["text"]))))
    parsed = _with_assets(parsed, key, assets)

    texts = F.slice("__texts", F.lit(2), F.size("options"))
    blank = F.size(F.filter(texts, lambda t: t == ""))
    pictured = (F.size("__paths") >= F.size("options")) & (blank >= F.size("options") - 1)
    option = lambda o, i: F.struct(
        o["key"].alias("key"), F.get(F.col("__texts"), i + 1).alias("text"), F.when(pictured, F.get(F.col("__paths"), i)).alias("image"), o["raw_order"].alias("raw_order")
    )
    parsed = parsed.withColumns({"stem": F.get("__texts", F.lit(0)), "options": F.transform("options", option)}).withColumn("stem_markup", names.markup_payload(F.col("stem")))
    base = F.concat(F.col(key).cast("string"), F.lit(":q"), F.lpad(F.col("number").cast("string"), 3, "0"))
    same = Window.partitionBy(key, "number")  # blocks of one document
    rn = F.row_number().over(same.orderBy("place"))
    keyed = parsed.drop("__texts", "__paths").withColumns({"__rn": rn, "__same": F.count(F.lit(1)).over(same)})
    keyed = keyed.withColumn("candidate_key", F.when(F.col("__rn") > 1, F.concat(base, F.lit(":dup"), F.lpad(F.col("__rn").cast("string"), 2, "0"))).otherwise(base)).drop("__rn")
    answered = B.with_answers(keyed, B.answer_rows(complete, [key], answers), [key])

    own = B.with_issues(answered)
    code = lambda name, severity, ok: F.when(ok, F.array(F.struct(F.lit(name).alias("issue_code"), F.lit(severity).alias("severity")))).otherwise(F.expr("cast(array() as array<struct<issue_code:string,severity:string>>)"))
    lacks = F.max("number") - F.min("number") + 1 > F.count_distinct("number")
    about = blocks.groupBy(key).agg(F.min("place").alias("__first"), lacks.alias("__lacks"))  # numbers and places alone: blocks are found again, but not taken apart
    whole = own.join(about, key, "left")
    of_document = F.concat(code("duplicate_question_number", "error", F.col("__same") > 1), code("question_number_gap", "warning", (F.col("place") == F.col("__first")) & F.col("__lacks")))
    whole = whole.withColumn("issues", F.concat("issues", of_document)).drop("__same", "__first", "__lacks")
    rank = F.coalesce(F.array_max(F.transform("issues", lambda x: severity_rank(x["severity"]))), F.lit(0))
    return whole.withColumns({"quality_status": F.element_at(F.array(F.lit("pass"), F.lit("needs_review"), F.lit("blocked")), rank + 1), "issue_count": F.size("issues")})
