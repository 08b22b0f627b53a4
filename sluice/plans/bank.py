"""The question bank's own rules over tables shaped from the standard ones: answers, issues, gates, review state, staging, exports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import questions as Q
from ..operators import bank as B
from ..operators import relational as R
from ..operators.notation import audited_notation
from ..operators.parse import parsed_candidates
from .common import REVIEW_SQL, review_events, table


def rows():
    return F.count(F.lit(1)).alias("n")


# --- answers -------------------------------------------------------------------------------------


def _answer_pages(spark, d):
    """An answer page for each order: a table of its line numbers, and notes for even lines that are `#`."""
    l = table(spark, d, "lineitem").filter("l_linenumber is not null").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("flag"))
    line = F.col("l_linenumber").cast("string")
    cells = l.select("l_orderkey", F.struct("l_linenumber", F.concat(F.lit("<td>第"), line, F.lit("題</td>")).alias("head"), F.concat(F.lit("<td> "), F.when(F.col("flag") == "A", "A").when(F.col("flag") == "N", "B").otherwise("#"), F.lit("</td>")).alias("cell"),
        F.when((F.col("flag") == "R") & (F.col("l_linenumber") % 2 == 0), F.concat(F.lit("第"), line, F.lit("題答A或C者均給分"))).alias("note")).alias("x"))
    rows = cells.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("x")).alias("x"))  # the lines of one order
    joined = lambda name: F.array_join(f"x.{name}", "")
    page = F.concat(F.lit("# page\n<table><tr><td>題號</td><td></td>"), joined("head"), F.lit("</tr><tr><td>答案</td>"), joined("cell"), F.lit("</tr></table>\n"), F.coalesce(joined("note"), F.lit("")))
    return rows.select("l_orderkey", page.alias("page"))


def answer_tables(spark, d):
    found = B.answer_rows(_answer_pages(spark, d), ["l_orderkey"], "page")
    return found.select("l_orderkey", F.col("number").cast("long").alias("number"), "answer", "raw_answer", "special")


ANSWERS_SQL = """answers AS (SELECT l_orderkey, l_linenumber::BIGINT AS number, CASE flag WHEN 'A' THEN 'A' WHEN 'N' THEN 'B' ELSE CASE WHEN l_linenumber % 2 = 0 THEN 'A|C' ELSE '#' END END AS answer,
  CASE flag WHEN 'A' THEN 'A' WHEN 'N' THEN 'B' ELSE '#' END AS raw_answer, flag NOT IN ('A', 'N') AND l_linenumber % 2 = 0 AS special
  FROM (SELECT l_orderkey, l_linenumber, max(l_returnflag) AS flag FROM lineitem WHERE l_linenumber IS NOT NULL GROUP BY ALL))"""


def answers_joined(spark, d):
    """Questions 1 to 5 of each order beside the answers of its page."""
    q = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.explode(F.sequence(F.lit(1), F.lit(5))).alias("number"))
    a = B.answer_rows(_answer_pages(spark, d), ["l_orderkey"], "page")
    j = B.with_answers(q, a, ["l_orderkey"])
    return j.groupBy("number", F.coalesce("answer", F.lit("missing")).alias("answer")).agg(rows()).withColumn("number", F.col("number").cast("long"))


def question_parse(spark, d):
    """Blocks made of each order's lines, taken apart again; and how many questions have which options."""
    l = table(spark, d, "lineitem").filter("l_linenumber between 1 and 5").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part"))
    option = F.concat(F.lit("\n("), F.substring(F.lit("ABCDE"), F.col("l_linenumber"), F.lit(1)), F.lit(") part "), "part", F.lit(" E. coli"))
    blocks = l.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", option.alias("o")))).alias("x"))  # the lines of one order
    body = F.concat(F.lit("第1至9題 order "), "l_orderkey", F.array_join("x.o", ""))
    q = Q.with_question(blocks.select("l_orderkey", F.lit(5).alias("number"), body.alias("body")), "number", "body")
    return q.select("l_orderkey", "stem", F.size("options").cast("long").alias("n_options"), F.array_join(F.transform("options", lambda o: F.concat(o["key"], F.lit("="), o["text"])), ";").alias("options"), "group_ref")


def question_types(spark, d):
    """Whole documents as blocks: how many have options."""
    q = table(spark, d, "documents").select(Q.question(F.lit(1), F.col("text")).alias("q"))
    return q.groupBy(F.col("q.question_type").alias("question_type"), F.size("q.options").cast("long").alias("n_options")).agg(rows())


def _papers(spark, d):
    """A paper for each customer: its orders are questions, their lines options; the answers are a table, as pages have them."""
    one = table(spark, d, "lineitem").filter("l_linenumber between 1 and 5").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part"))
    lines = one.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "part"))).alias("x"))  # five lines at most
    option = lambda x: F.concat(F.lit("\n("), F.substring(F.lit("ABCDE"), x["l_linenumber"].cast("int"), F.lit(1)), F.lit(") part "), x["part"])
    options = F.array_join(F.transform("x", option), "")
    o = table(spark, d, "orders").join(lines.select(F.col("l_orderkey").alias("o_orderkey"), options.alias("options")), "o_orderkey", "left")
    key = F.col("o_orderkey")
    answer = F.when(key % 7 == 0, None).when(key % 11 == 0, "z").otherwise(F.substring(F.lit("ABCD"), (key % 4 + 1).cast("int"), F.lit(1)))
    body = F.concat(F.when((key % 13 == 0) & F.col("options").isNotNull(), "").otherwise(F.concat(F.lit("What is the way of order "), key, F.lit("?"))), F.coalesce("options", F.lit("")))
    own = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct(key, body.alias("body"), answer.alias("answer")))).alias("q"))  # the orders of one customer
    number = lambda i: (i + 1 + F.when(i >= 3, 1).otherwise(0)).cast("string")  # noqa: E731  a number lacks after the third
    cell = lambda x: F.concat(F.lit("<td>"), x, F.lit("</td>"))
    given = F.filter(F.transform("q", lambda x, i: F.struct(number(i).alias("n"), x["answer"].alias("a"))), lambda x: x["a"].isNotNull())
    pages = own.select("o_custkey", "q", given.alias("given"))
    row = lambda head, of: F.concat(F.lit(f"<tr><td>{head}</td>"), F.array_join(F.transform("given", lambda x: cell(of(x))), ""), F.lit("</tr>"))
    table_ = F.concat(F.lit("<table>"), row("題號", lambda x: x["n"]), row("答案", lambda x: x["a"]), F.lit("</table>"))
    return pages.select("o_custkey", F.array_join(F.transform("q", lambda x, i: F.concat(number(i), F.lit("、"), x["body"])), "\n").alias("markdown"), table_.alias("answers"))


def parsed_papers(spark, d):
    """Whole papers from Markdown to candidates: stems, options, answers, issues and states."""
    found = parsed_candidates(_papers(spark, d), "o_custkey", "markdown", "answers", F.lit("110"))
    codes = F.array_join(F.array_sort(F.transform("issues", lambda x: x["issue_code"])), ";")
    return found.select("candidate_key", F.col("number").cast("long").alias("number"), "stem", F.array_join(F.transform("options", lambda o: F.concat(o["key"], F.lit("="), o["text"])), ";").alias("options"), "answer", codes.alias("codes"), "quality_status")


PAPERS_SQL = """WITH o AS (SELECT o_custkey, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders),
  l AS (SELECT l_orderkey AS k, count(*) AS n, string_agg('ABCDE'[l_linenumber] || '=part ' || part, ';' ORDER BY l_linenumber) AS options, max(l_linenumber) AS top
    FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS part FROM lineitem WHERE l_linenumber BETWEEN 1 AND 5 GROUP BY ALL) GROUP BY 1),
  q AS (SELECT o_custkey, k, i, i + CASE WHEN i > 3 THEN 1 ELSE 0 END AS number, count(*) OVER (PARTITION BY o_custkey) AS many, coalesce(n, 0) AS n, top, coalesce(options, '') AS options,
    CASE WHEN k % 13 = 0 AND n > 0 THEN '' ELSE 'What is the way of order ' || k || '?' END AS stem, CASE WHEN k % 7 = 0 THEN NULL WHEN k % 11 = 0 THEN 'z' ELSE 'ABCD'[k % 4 + 1] END AS answer FROM o LEFT JOIN l USING (k)),
  s AS (SELECT *, list_sort(list_filter([CASE WHEN stem = '' THEN 'empty_stem' END, CASE WHEN n < 4 THEN 'too_few_options' END, CASE WHEN n >= 4 AND top > n THEN 'option_order_unusual' END, CASE WHEN answer IS NULL THEN 'missing_answer' END, CASE WHEN answer = 'z' THEN 'unexpected_answer_value' END,
    CASE WHEN i = 1 AND many > 3 THEN 'question_number_gap' END], lambda x: x IS NOT NULL)) AS codes FROM q)
  SELECT o_custkey || ':q' || lpad(number::VARCHAR, 3, '0') AS candidate_key, number, stem, options, answer, array_to_string(codes, ';') AS codes,
    CASE WHEN list_contains(codes, 'empty_stem') OR list_contains(codes, 'too_few_options') THEN 'blocked' WHEN list_contains(codes, 'unexpected_answer_value') OR list_contains(codes, 'question_number_gap') OR list_contains(codes, 'option_order_unusual') THEN 'needs_review' ELSE 'pass' END AS quality_status FROM s"""


# --- issues --------------------------------------------------------------------------------------


def candidates(spark, d):
    """A candidate for each document: its first line is the stem, the others are options labelled by their length."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality")), "doc_id", "left")
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    options = F.transform(F.slice(lines, F.lit(2), F.size(lines)), lambda x, i: F.struct(F.substring(F.lit("ABCDE"), F.length(x) % 5 + 1, F.lit(1)).alias("key"), F.trim(x).alias("text"), F.lit(None).cast("string").alias("image"), (i + 1).alias("raw_order")))
    ref = lambda exists, size: F.array(F.struct(F.lit("images/p.png").alias("path"), F.lit(exists).alias("exists"), F.lit(size).cast("bigint").alias("bytes")))
    return docs.select(
        "doc_id", "lang", "source", F.trim(F.get(lines, F.lit(0))).alias("stem"), F.array_sort(options, lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(a["raw_order"] - b["raw_order"])).alias("options"),
        F.when(F.col("quality") == 1, "A").when(F.col("quality") == 0, "x1").alias("answer"), F.when(F.col("source") == "src1", ref(False, None)).when(F.col("source") == "src2", ref(True, 0)).alias("image_refs"),
    )


def candidate_issue_codes(spark, d):
    return B.candidate_issues(candidates(spark, d), ["doc_id"])


def event_hashes(spark, d):
    """Events in two spellings of one JSON object: as many hashes as objects, and their typed values."""
    e = table(spark, d, "events").select("event_id", F.coalesce("props", F.lit("null")).alias("props"))
    one = e.select("event_id", F.concat(F.lit('{ "b" : '), "event_id", F.lit(',\n "a":'), "props", F.lit(" }")).alias("j"))
    two = e.select("event_id", F.concat(F.lit('{"a":'), "props", F.lit(',"b":'), "event_id", F.lit("}")).alias("j"))
    both = one.unionByName(two).select("event_id", B.canonical_hash(F.col("j")).alias("hash"), B.typed_paths(F.col("j"), {"b": ("$.b", "bigint"), "k": ("$.a.k", "int")}).alias("v"))
    return both.groupBy("event_id", "hash").agg(rows(), F.max("v.b").alias("b"), F.max("v.k").cast("long").alias("k"))


def notation_audit(spark, d):
    """Findings of notation, options and borders over all candidates; documents are numbered by doc_id."""
    c = candidates(spark, d).select("doc_id", "stem", "options", F.col("doc_id").alias("question_number"), F.col("image_refs").isNotNull().alias("has_image"))
    found = audited_notation(c)
    return found.select("doc_id", "audit.status", F.array_join("audit.labels", ";").alias("labels"), F.array_join(F.transform("audit.findings", lambda x: x["code"]), ";").alias("codes"), "audit.recommended_action", F.col("audit.correction.stem").alias("corrected_stem"))


CODES_SQL = r"""cand AS (SELECT doc_id, lang, source, trim(l[1]) AS stem, list_transform(l[2:], lambda x: substr('ABCDE', length(x) % 5 + 1, 1)) AS raw, list_transform(l[2:], lambda x: trim(x)) AS texts, q
    FROM (SELECT doc_id, lang, source, string_split(coalesce(text, ''), chr(10)) AS l, (SELECT max(quality) FROM labels b WHERE b.doc_id = a.doc_id) AS q FROM documents a)),
  said AS (SELECT doc_id, unnest(list_concat([CASE WHEN stem = '' THEN 'empty_stem:error' END, CASE WHEN stem <> '' AND length(stem) < 8 THEN 'short_stem:warning' END,
    CASE WHEN regexp_matches(stem, '(\x{FFFD}|□|▯|_{3,}|\.{6,}|。{3,})') THEN 'suspicious_ocr_chars:warning' END, CASE WHEN len(raw) < 4 THEN 'too_few_options:error' END,
    CASE WHEN len(list_distinct(raw)) < len(raw) THEN 'duplicate_option_label:error' END, CASE WHEN len(raw) >= 4 AND raw <> ['A', 'B', 'C', 'D', 'E'][1:least(len(raw), 5)] THEN 'option_order_unusual:warning' END,
    CASE WHEN q IS NULL OR q NOT IN (0, 1) THEN 'missing_answer:info' END, CASE WHEN q = 0 THEN 'unexpected_answer_value:warning' END,
    CASE WHEN regexp_matches(stem, '(<sub>|<sup>|\\[a-zA-Z]+|\^[0-9+-]+)') THEN 'markup_needs_review:warning' END,
    CASE WHEN source = 'src1' THEN 'missing_image_asset:error' WHEN source = 'src2' THEN 'empty_image_asset:error' END],
    list_transform(list_filter(texts, lambda x: x = ''), lambda x: 'empty_option:error'))) AS s FROM cand),
  codes AS (SELECT doc_id, split_part(s, ':', 1) AS issue_code, split_part(s, ':', 2) AS severity FROM said WHERE s IS NOT NULL)"""


def failure_codes(spark, d):
    l = table(spark, d, "lineitem")
    docs = l.groupBy("l_orderkey").agg(F.min(F.when(F.col("l_returnflag") == "N", F.col("l_partkey"))).alias("question"), F.min(F.when(F.col("l_returnflag") == "A", F.col("l_partkey"))).alias("answer"))
    return B.document_failures(docs, l.filter("l_quantity > 40"), "l_orderkey", "question", "answer")


def gate_split(spark, d):
    return B.split_statuses(B.candidate_issues(candidates(spark, d), ["doc_id"]), ["doc_id"])


def markup_flags(spark, d):
    docs = table(spark, d, "documents").select(N.markup_payload(F.col("text")).alias("m"))
    return docs.groupBy(F.col("m").isNotNull().alias("has_markup"), F.coalesce("m.needs_review", F.lit(False)).alias("needs_review")).agg(rows())


# --- corrections and gates -----------------------------------------------------------------------


def corrections_applied(spark, d):
    """Made-up corrections of each event: another stem, an answer taken back, or one more image."""
    e = review_events(spark, d).select("id", F.col("action").alias("stem"), F.lit("A").alias("answer"), F.array(F.lit("a.png")).alias("image_refs"),
        F.when(F.col("k") % 3 == 0, F.concat(F.lit('{"stem":"s'), F.col("k"), F.lit('"}'))).when(F.col("k") % 3 == 1, '{"answer":null}').when(F.col("k") % 3 == 2, '{"image_refs":["b.png","c.png"]}').alias("correction"))
    return B.corrected(e, "correction").select("id", "stem", "answer", F.array_join("image_refs", ",").alias("images"))


def _gate_rows(spark, d):
    c = B.with_issues(candidates(spark, d))
    has_four, has_asset = F.size("options") >= 4, F.coalesce(F.exists("image_refs", lambda r: r["exists"]), F.lit(False))
    blocking = F.filter("issues", lambda x: x["severity"].isin("error", "blocked"))
    solved = lambda x: B.is_resolved(x["issue_code"], has_four | (F.col("doc_id") % 2 == 0), has_asset, F.lit(None).cast("string"))
    codes = lambda ok: F.transform(F.filter("blocking", ok), lambda x: x["issue_code"])
    rank = F.array_max(F.transform("issues", lambda x: B.severity_rank(x["severity"])))
    c = c.withColumns({"blocking": blocking, "rank": rank}).withColumns({"open_codes": codes(lambda x: ~solved(x)), "settled_codes": codes(solved)})
    last = review_events(spark, d).groupBy(F.col("candidate_key").alias("doc_id")).agg(F.max_by("action", F.struct("created_at", "id")).alias("action"))
    none = F.array().cast("array<string>")
    j = c.join(last, "doc_id", "left")
    said = F.when(F.col("action") == "accept", "accept").when(F.col("action") == "block", "block").when(F.col("action") == "comment", "comment")
    return j.select(
        "doc_id", F.when(F.col("rank") >= 2, "blocked").when(F.col("rank") == 1, "needs_review").otherwise("pass").alias("quality_status"), said.alias("question_action"),
        (F.col("action") == "reset_review").eqNullSafe(True).alias("question_reset"), F.when(F.col("answer") == "A", "accept").alias("answer_action"), F.lit(False).alias("answer_reset"),
        F.coalesce("open_codes", none).alias("open_codes"), F.coalesce("settled_codes", none).alias("settled_codes"), F.contains("stem", F.lit("a")).alias("group_hint"), F.when(F.col("lang") == "en", "q001-q002").alias("group_ref"),
        F.contains("stem", F.lit("the")).alias("visual_hint"), has_asset.alias("has_asset"), F.contains("stem", F.lit("o")).alias("markup_hint"), (F.col("source") == "src3").eqNullSafe(True).alias("has_markup"),
    )


def formal_gate(spark, d):
    return B.formal_gate(_gate_rows(spark, d)).select("doc_id", "status", "reasons", "warnings")


GATE_SQL = CODES_SQL + f""", {REVIEW_SQL},
  bl AS (SELECT doc_id, issue_code, issue_code = 'too_few_options' AND (len(raw) >= 4 OR doc_id % 2 = 0) AS solved FROM codes JOIN cand USING (doc_id) WHERE severity = 'error'),
  per AS (SELECT doc_id, coalesce(string_agg(DISTINCT issue_code, ',' ORDER BY issue_code), '') AS every, coalesce(string_agg(DISTINCT issue_code, ',' ORDER BY issue_code) FILTER (NOT solved), '') AS opened,
    coalesce(string_agg(DISTINCT issue_code, ',' ORDER BY issue_code) FILTER (solved), '') AS settled FROM bl GROUP BY 1),
  st AS (SELECT doc_id, max(CASE severity WHEN 'error' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END) AS r FROM codes GROUP BY 1),
  la AS (SELECT candidate_key AS doc_id, arg_max(action, (created_at, id)) AS act FROM review GROUP BY 1),
  j AS (SELECT c.*, CASE WHEN r = 2 THEN 'blocked' WHEN r = 1 THEN 'needs_review' ELSE 'pass' END AS quality, coalesce(act, '') AS act, act = 'accept' IS TRUE AS ready, coalesce(every, '') AS every, coalesce(opened, '') AS opened,
    coalesce(settled, '') AS settled, contains(stem, 'a') AND (lang = 'en') IS NOT TRUE AS grp, contains(stem, 'the') AND (source = 'src2') IS NOT TRUE AS vis, contains(stem, 'o') AND (source = 'src3') IS NOT TRUE AS mark
    FROM cand c LEFT JOIN st USING (doc_id) LEFT JOIN per USING (doc_id) LEFT JOIN la USING (doc_id)),
  g AS (SELECT doc_id, concat_ws(';', CASE WHEN quality <> 'pass' AND NOT ready THEN 'candidate_quality_status=' || quality END,
      CASE WHEN act = 'reset_review' THEN 'question_review_reset_pending' WHEN act = 'block' THEN 'question_review_not_ready=block' WHEN NOT ready THEN 'question_review_missing_accept' END,
      CASE WHEN q = 1 IS NOT TRUE THEN 'answer_review_missing_accept' END, CASE WHEN (CASE WHEN ready THEN opened ELSE every END) <> '' THEN 'blocking_parse_issues=' || CASE WHEN ready THEN opened ELSE every END END,
      CASE WHEN grp AND NOT ready THEN 'group_hint_without_group_ref' END, CASE WHEN vis AND NOT ready THEN 'visual_hint_without_asset' END) AS reasons,
    concat_ws(';', CASE WHEN quality <> 'pass' AND ready THEN 'candidate_quality_resolved_by_human_review=' || quality END, CASE WHEN ready AND settled <> '' THEN 'blocking_parse_issues_resolved_by_human_correction=' || settled END,
      CASE WHEN grp AND ready THEN 'group_hint_without_group_ref_confirmed_by_human_review' END, CASE WHEN vis AND ready THEN 'visual_hint_without_asset_confirmed_by_human_review' END,
      CASE WHEN mark THEN 'markup_or_table_fragment_without_markup_json' END) AS warnings FROM j)
  SELECT doc_id, CASE WHEN reasons = '' THEN 'ready' ELSE 'blocked' END AS status, reasons, warnings FROM g"""
GATE_SQL = GATE_SQL.replace("act = 'accept' IS TRUE", "(act = 'accept') IS TRUE").replace("q = 1 IS NOT TRUE", "(q = 1) IS NOT TRUE")


# --- review state --------------------------------------------------------------------------------


def _states(spark, d):
    """Review and audit state of each key: its latest event, and labels as audits."""
    e = review_events(spark, d)
    last = e.groupBy("candidate_key").agg(F.max_by(F.struct("action", "k", "has_correction", "correction"), F.struct("created_at", "id")).alias("x"))
    reviewed = F.col("x.action") != "reset_review"
    return last.select(
        "candidate_key", reviewed.alias("is_reviewed"), F.when(reviewed, F.col("x.action")).otherwise("reset_review").alias("review_action"), F.lit(None).cast("string").alias("correction_json"),
        F.when(F.col("x.has_correction"), '{"correction":null}').otherwise('{"k":1}').alias("event_json"), (F.col("x.k") % 3 != 0).eqNullSafe(True).alias("ai_reviewed"), (F.col("x.k") % 5 == 0).eqNullSafe(True).alias("ai_has_suggestion"),
        F.when(F.col("x.k") % 3 == 1, "needs_review").when(F.col("x.k") % 3 == 2, F.when(F.col("x.k") % 2 == 0, "pass").otherwise("block")).alias("ai_effective_status"),
        F.when(F.col("x.k") > 50, "pass").otherwise("blocked").alias("question_quality_status"), F.col("x.k").alias("k"), F.col("x.action").alias("last_action"),
    )


STATES_SQL = f"""{REVIEW_SQL}, last AS (SELECT candidate_key, arg_max(action, (created_at, id)) AS a, arg_max(id, (created_at, id)) AS id FROM review GROUP BY 1),
  states AS (SELECT l.candidate_key, a, a <> 'reset_review' AS rev, r.k AS k, r.has_correction AS cor, coalesce(r.k % 3 <> 0, false) AS air, coalesce(r.k % 5 = 0, false) AS sug,
    CASE r.k % 3 WHEN 1 THEN 'needs_review' WHEN 2 THEN CASE WHEN r.k % 2 = 0 THEN 'pass' ELSE 'block' END END AS ais, CASE WHEN r.k > 50 THEN 'pass' ELSE 'blocked' END AS qual FROM last l JOIN review r ON r.id = l.id)"""

FORMS = [("", "not_accept", "", ""), ("", "correct", "", ""), ("", "reset_review", "", ""), ("", "unreviewed", "", ""), ("", "reviewed", "", ""), ("pass", "comment", "", ""), ("", "", "unreviewed", ""), ("", "", "reviewed", ""),
    ("", "", "suggested_correction", ""), ("", "", "needs_review", ""), ("", "", "pass", ""), ("blocked", "", "", " CKS"), ("", "", "", "lick")]
FORMS_SQL = ["rev AND a NOT IN ('accept', 'correct', 'unblock') OR NOT rev", "rev AND cor", "NOT rev", "NOT rev", "rev", "qual = 'pass' AND a = 'comment'", "NOT air", "air", "sug", "coalesce(ais IN ('needs_review', 'block'), false)", "coalesce(ais = 'pass', false)",
    "qual = 'blocked' AND contains(a, 'cks')", "contains(a, 'lick')"]


def review_filter_forms(spark, d):
    """Number of keys that each form of the page's filter keeps, in one pass."""
    s = _states(spark, d)
    counts = [F.count_if(F.coalesce(B.review_filter(*form, search=["review_action"]), F.lit(False))).alias(f"f{i:02d}") for i, form in enumerate(FORMS)]
    return s.agg(*counts)


def batch_accept_reasons(spark, d):
    s = _states(spark, d)
    reason = B.batch_reason(F.col("candidate_key") % 7 != 0, F.when(F.col("is_reviewed"), F.col("review_action")), F.col("ai_effective_status"), F.col("question_quality_status"))
    return s.groupBy(F.coalesce(reason, F.lit("saved")).alias("reason")).agg(rows())


def audit_statuses(spark, d):
    """Labels as audits: toxic ones are blocked, low quality leaves work, and documents of one language defer their answers."""
    j = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    status = F.when(F.col("toxic") == 1, "blocked").when(F.col("quality").isNotNull(), "pass")
    found = B.audit_status(status, status.isNotNull() & (F.col("lang") == "en"), F.col("quality") == 0)
    return j.select("doc_id", found.alias("status"))


def suggested_corrections(spark, d):
    """Every second document with a character that the tables repair; some have a correction of their own, or an empty one."""
    docs = table(spark, d, "documents").select("doc_id", F.concat("lang", F.when(F.col("doc_id") % 2 == 0, " 氢化钠").otherwise(" ok")).alias("stem"), F.when(F.col("doc_id") % 5 == 0, '{"stem":"given"}').when(F.col("doc_id") % 5 == 1, "{}").alias("explicit"))
    found = docs.select("doc_id", B.suggested_correction(F.col("explicit"), F.col("stem")).alias("x"))
    return found.select("doc_id", F.col("x.stem").alias("stem"), F.array_join("x.changes", ";").alias("changes"))


def repair_badges(spark, d):
    s = _states(spark, d)
    reviewer = F.when(F.col("k") % 4 == 0, "repair-auto").otherwise("local")
    sources = F.filter(F.array(F.when(F.col("k") % 9 == 0, "backfill")), lambda x: x.isNotNull())
    active = B.repair_active(F.when(F.col("is_reviewed"), F.col("review_action")), ~F.col("is_reviewed"), reviewer, sources, ["repair-", "codex-repair"])
    return s.select("candidate_key", F.coalesce(active, F.lit(False)).alias("active"))


def export_policies(spark, d):
    """Keys exported under each policy, in one pass."""
    s = _states(spark, d)
    has = F.col("ai_reviewed")
    action = F.when(has, F.when(F.col("k") % 7 == 0, "reset_ai_review").otherwise("audit"))
    reliable = B.is_reliable_audit(action, F.when(F.col("k") % 4 == 0, "heuristic").otherwise("m1"), F.when(F.col("k") % 6 == 0, "local").otherwise("codex-1"), F.lit("other"))
    review = F.when(F.col("is_reviewed"), F.col("review_action"))
    return s.agg(*(F.count_if(B.to_export(p, review, has, reliable)).alias(n) for p, n in (("all", "every"), ("pending-only", "pending"), ("reliable", "unreliable"))))


def answer_refusals(spark, d):
    a = B.answer_rows(_answer_pages(spark, d), ["l_orderkey"], "page")
    return a.groupBy(F.coalesce(B.rejected_answers(F.col("answer"), F.col("number") <= 4), F.lit("taken")).alias("outcome")).agg(rows())


# --- staging -------------------------------------------------------------------------------------


def event_staging(spark, d):
    """Events of buyers with a known action; payloads as audits."""
    e = review_events(spark, d).withColumns({"audit_status": F.when(F.col("k") % 4 == 0, " blocked ").when(F.col("k") % 4 == 1, "needs_review").when(F.col("k") % 4 == 2, ""), "audit_json": F.when(F.col("k") > 30, F.concat(F.lit('{"k":'), F.col("k"), F.lit("}")))})
    scope = table(spark, d, "customer").select(F.col("c_custkey").alias("candidate_key"))
    return B.staged_events(e, scope, "candidate_key", ["accept", "block", "comment"]).select("id", "action", "audit_status", "audit_json")


def candidate_staging(spark, d):
    i = B.candidate_issues(candidates(spark, d), ["doc_id"]).join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    i = i.withColumns({"issue_code": F.when(F.col("doc_id") % 3 != 0, F.col("issue_code")), "severity": F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.col("severity"))})
    return B.staged(i, ["source"], {"issue_code": "unknown_issue", "severity": "warning"}).groupBy("issue_code", "severity").agg(rows())


def json_paths(spark, d):
    """Paths, keys and array lengths of made-up metadata around each payload."""
    p = F.col("props")
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"metadata":{"name":"n'), "event_id", F.lit('"},"list":[1,2,'), F.coalesce(p, F.lit("null")), F.lit("]}"))).when(F.col("event_id") % 3 == 1, '{"group_name":"g","name":null,"list":{"a":1}}').otherwise(p).alias("j"))
    return e.select("event_id", B.path_text(F.col("j"), "$.metadata.name", "$.group_name").alias("name"), B.has_key(F.col("j"), "name").alias("has_name"), B.array_length(F.get_json_object("j", "$.list")).cast("long").alias("n"))


def preferences(spark, d):
    """Saved preferences of reviewers after the latest ones are written over them."""
    saved = table(spark, d, "customer").select(F.col("c_custkey").alias("reviewer"), F.concat(F.lit('{"segment":"'), "c_mktsegment", F.lit('"}')).alias("preferences"))
    new = review_events(spark, d).groupBy(F.col("candidate_key").alias("reviewer")).agg(F.max_by("action", F.struct("created_at", "id")).alias("a")).select("reviewer", F.concat(F.lit('{"last":"'), F.coalesce("a", F.lit("")), F.lit('"}')).alias("preferences"))
    return R.upsert(saved, new, ["reviewer"])


def hashed_assets(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    return B.hashed_assets(docs, "text", "doc_id", F.col("lang") == "en", 200).select("asset_key", "doc_id")


def pair_batch(spark, d):
    """One row for each pair of documents: how many questions it gave, or why it gave none."""
    l = table(spark, d, "lineitem")
    pairs = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    n = l.groupBy("l_orderkey").agg(F.count_if(F.col("l_returnflag") == "N").alias("questions"), F.count_if(F.col("l_returnflag") == "A").alias("answers"))
    error = F.when(F.coalesce("questions", F.lit(0)) == 0, "no question").when(F.col("answers") == 0, "no answer")
    return pairs.join(n, "l_orderkey", "left").groupBy(F.when(error.isNull(), "ok").otherwise("error").alias("status"), error.alias("error")).agg(rows())


# --- joins of documents, batches and results -----------------------------------------------------


def ready_pairs(spark, d):
    """Orders with a document for both roles."""
    l = table(spark, d, "lineitem")
    has = lambda flag: l.filter(F.col("l_returnflag") == flag).select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return table(spark, d, "orders").select("o_orderkey").join(has("N"), "o_orderkey", "left_semi").join(has("A"), "o_orderkey", "left_semi")


def first_assets(spark, d):
    l = table(spark, d, "lineitem").filter("l_linestatus = 'F'")
    return l.groupBy("l_orderkey").agg(F.min_by("l_partkey", F.struct("l_linenumber", "l_partkey")).alias("asset"))


def answer_report(spark, d):
    """Questions, options and answers of each document side by side, with counts where there are none."""
    c = candidates(spark, d)
    options = c.select("doc_id", F.explode("options").alias("o")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_options"), F.count_distinct("o.key").alias("n_labels"))
    answers = c.filter("answer is not null").select("doc_id", "answer")
    return c.select("doc_id").join(options, "doc_id", "left").join(answers, "doc_id", "left").select("doc_id", F.coalesce("n_options", F.lit(0)).alias("n_options"), F.coalesce("n_labels", F.lit(0)).alias("n_labels"), "answer")


def batch_index(spark, d):
    """Batch rows beside their index rows; paths the index lacks get a row of their own."""
    batch = table(spark, d, "lineitem").select(F.concat(F.lit("p/"), F.col("l_partkey") + 5).alias("path")).distinct()
    index = table(spark, d, "part").select(F.concat(F.lit("p/"), "p_partkey").alias("path"), "p_brand")
    j = batch.join(index, "path", "left")
    return j.select("path", F.coalesce("p_brand", F.lit("unindexed")).alias("brand"), F.coalesce("p_brand", F.substring_index("path", "/", -1)).alias("label"))


def merged_results(spark, d):
    """Results that belong to a manifest, by path; others are dropped."""
    l = table(spark, d, "lineitem").select((F.col("l_partkey") + 5).alias("p_partkey"), "l_linestatus")
    return l.join(table(spark, d, "part").select("p_partkey", "p_size"), "p_partkey").groupBy("p_size", "l_linestatus").agg(rows())


def outputs_by_stem(spark, d):
    """Outputs beside the official file of their stem, the last of equal stems; unmatched ones are errors."""
    official = table(spark, d, "part").select(F.concat(F.lower("p_brand"), (F.col("p_partkey") % 40).cast("string")).alias("stem"), "p_partkey").groupBy("stem").agg(F.max("p_partkey").alias("official"))
    outputs = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("brand#"), (F.col("s_suppkey") % 60 + 10).cast("string"), (F.col("s_suppkey") % 40).cast("string")).alias("stem"))
    return outputs.join(official, "stem", "left").select("s_suppkey", "official", F.when(F.col("official").isNull(), "error").otherwise("ok").alias("status"))


def progress_table(spark, d):
    """Categories of the catalog beside what their latest manifest has."""
    c = table(spark, d, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("expected"))
    o = table(spark, d, "orders").filter("o_orderstatus = 'F'").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(F.count_distinct("o_custkey").alias("got"))
    return c.join(o, "c_mktsegment", "left").select("c_mktsegment", "expected", F.coalesce("got", F.lit(0)).alias("got"), F.round(F.coalesce("got", F.lit(0)) / F.col("expected"), 4).alias("ratio"))


def local_paths(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.concat_ws("/", F.lit("docs"), "p_brand", F.concat("p_partkey", F.lit(".pdf"))).alias("relative"))
    return p.select("p_partkey", F.concat_ws("/", F.lit("/data/batch"), "relative").alias("path"), N.is_safe_path(F.col("relative")).alias("safe"))


# --- aggregates ----------------------------------------------------------------------------------


def track_subjects(spark, d):
    p = table(spark, d, "part")
    return p.groupBy("p_brand", "p_name", "p_size").agg(rows(), F.count_distinct("p_type").alias("n_types"), F.min("p_retailprice").alias("low"), F.max("p_retailprice").alias("high"))


def catalog_counts(spark, d):
    """The report of a catalog as lines: a table of years and one of priorities within years."""
    o = table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    years = o.groupBy("year").agg(F.count(F.lit(1)).alias("rows"))
    exams = o.groupBy("year", "o_orderpriority").agg(F.count_distinct("o_custkey").alias("categories"), F.count(F.lit(1)).alias("rows"))
    one = B.markdown_table(years, {"year": "Year", "rows": "Rows"}, [F.desc("year")], 1)
    two = B.markdown_table(exams, {"year": "Year", "o_orderpriority": "Exam", "categories": "Categories", "rows": "Subjects"}, [F.desc("year"), F.desc("o_orderpriority")], 1_000_000)
    return one.unionByName(two)


def status_counters(spark, d):
    """Statuses of each group and overall, as JSON objects."""
    l = table(spark, d, "lineitem")
    each = B.counter_json(l, ["l_returnflag"], "l_linestatus")
    return each.unionByName(B.counter_json(l.withColumn("l_returnflag", F.lit("all")), ["l_returnflag"], "l_linestatus"))


def peak_usage(spark, d):
    """Peaks of each number of workers, and how many runs went well."""
    l = table(spark, d, "lineitem")
    return l.groupBy(F.col("l_linenumber").alias("workers")).agg(F.max("l_extendedprice").alias("peak_memory"), F.max("l_quantity").alias("peak_load"), F.count_if(F.col("l_returnflag") != "R").alias("n_ok"), rows())


def expectations(spark, d):
    """Sessions, rows and expected documents of the locked groups."""
    locked = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    o = table(spark, d, "orders").join(locked, "o_custkey", "left_semi")
    return o.groupBy("o_orderpriority").agg(F.count_distinct(F.year("o_orderdate")).alias("sessions"), F.count(F.lit(1)).alias("rows"), F.sum(F.when(F.col("o_orderstatus") == "F", 3).otherwise(2)).alias("documents"))


def scope_plan(spark, d):
    """The first 300 orders in scope, later years first, then by priority, customer, status and key."""
    o = B.scoped(table(spark, d, "orders"), "o_orderpriority", exclude=("5-LOW",))
    o = B.scoped(o, "o_orderstatus", include=("F", "O")).withColumn("year", F.year("o_orderdate").cast("long"))
    return o.orderBy(F.desc("year"), "o_orderpriority", "o_custkey", "o_orderstatus", "o_orderkey").limit(300).select("o_orderkey", "year")


def name_matches(spark, d):
    """Names in a list that a catalog holds, by equality of normalised names and never by parts of them."""
    wanted = B.nonblank(table(spark, d, "part").select(F.concat(F.lit("  "), F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand")), F.lit(" ")).alias("name")).unionByName(table(spark, d, "part").select(F.lit(" ").alias("name"))), "name")
    known = table(spark, d, "part").filter("p_size < 5").select(N.normal_name(F.col("p_brand")).alias("name")).distinct()
    return wanted.withColumn("name", N.normal_name(F.col("name"))).join(known, "name", "left_semi")


# --- orders --------------------------------------------------------------------------------------


def unscoped_page(spark, d):
    e = table(spark, d, "events")
    return e.orderBy("event_id").limit(R.clamp_limit("75")).select("event_id", "user_id")


def sheet_orders(spark, d):
    """The first sheets in rising order, and the first groups in falling order with linked ones first."""
    o = table(spark, d, "orders").withColumn("year", F.year("o_orderdate").cast("long"))
    sheets = o.orderBy("year", "o_orderpriority", "o_orderkey").limit(50).select(F.lit("sheet").alias("kind"), "o_orderkey")
    groups = o.orderBy(F.desc("year"), F.desc("o_orderpriority"), F.when(F.col("o_orderstatus") == "F", 0).otherwise(1), "o_orderkey").limit(50).select(F.lit("group").alias("kind"), "o_orderkey")
    return sheets.unionByName(groups)


def review_page_order(spark, d):
    """The first page of orders under all six keys; some years are no numbers."""
    o = table(spark, d, "orders").select(
        F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")).alias("category"), F.col("o_orderstatus").alias("subject"), F.when(F.col("o_orderkey") % 5 == 0, "n/a").otherwise(F.year("o_orderdate").cast("string")).alias("year"),
        (F.col("o_custkey") % 4).cast("string").alias("ordinal"), F.concat(F.col("o_orderkey") % 50, F.when(F.col("o_orderkey") % 3 == 0, "b").otherwise("")).alias("number"), F.col("o_orderkey").alias("key"),
    )
    return o.orderBy(*R.review_order(*o.columns)).limit(500)


def group_names(spark, d):
    """Parts by group: brands of one group under one name."""
    p = table(spark, d, "part")
    name = N.group_name(F.concat(F.lit(" "), F.col("p_brand")), {"Brand#11": "one", "Brand#12": "one", "Brand#21": "two"})
    return p.groupBy(name.alias("name")).agg(rows())


def rank_reports(spark, d):
    """Each node's five largest categories, ties by name, without the categories that either of two lists leaves out."""
    part = table(spark, d, "part")
    p = part.groupBy("p_brand", "p_type").agg(rows())
    for left_out in ("p_size = 50", "p_size = 49"):
        p = p.join(B.nonblank(part.filter(left_out), "p_type"), "p_type", "left_anti")
    place = F.row_number().over(Window.partitionBy("p_brand").orderBy(F.desc("n"), F.asc("p_type")))
    return p.withColumn("place", place.cast("long")).filter("place <= 5").select("p_brand", "place", "p_type", "n")


def active_notes(spark, d):
    """Notes of latest events that ask for something, in order of time."""
    last = review_events(spark, d).groupBy("candidate_key").agg(F.max_by(F.struct("action", "created_at", "id", F.when(F.col("k") % 4 != 0, F.concat(F.lit(" note "), "k")).otherwise(" ").alias("note")), F.struct("created_at", "id")).alias("x")).select("candidate_key", "x.*")
    return last.filter(F.col("action").isin("block", "needs_review", "comment") & (F.trim("note") != "")).orderBy("created_at", "id").select("candidate_key", "action", F.trim("note").alias("note"))


def ordering_switch(spark, d):
    """The first rows forwards and backwards."""
    s = table(spark, d, "supplier").select("s_suppkey")
    page = lambda backwards: s.orderBy(F.desc("s_suppkey") if backwards else F.asc("s_suppkey")).limit(20).withColumn("backwards", F.lit(backwards))
    return page(False).unionByName(page(True))


# --- names, keys and exports ---------------------------------------------------------------------


def unique_in_order(spark, d):
    """Distinct letters of each source's languages, as first seen."""
    words = F.split(F.concat_ws(" ", "source", "lang", "source", "lang", F.lit("x")), " ")
    return table(spark, d, "documents").select("doc_id", F.array_join(F.array_distinct(words), " ").alias("words"))


def labels_cleaned(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.concat(F.lit("<b>"), "p_brand", F.lit("_"), "p_type", F.lit("_x</b>  本考試所有測驗題標準答案 more")).alias("label"), F.when(F.col("p_partkey") % 3 == 0, "指定代號").when(F.col("p_partkey") % 3 == 1, F.concat(F.lit(" <i>"), "p_brand", F.lit("</i>"))).alias("fallback"))
    split = N.level_and_name(N.exam_label(F.col("label")))
    return p.select("p_partkey", N.label_or(F.col("label"), F.col("fallback")).alias("label"), split["level"].alias("level"), split["name"].alias("name"))


def document_paths(spark, d):
    p = table(spark, d, "part").withColumn("collision", F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("_E"), F.lpad(F.col("p_partkey").cast("string"), 5, "0"))))
    path = N.document_path(F.lit("/root/files"), F.col("p_brand"), F.lit(110), F.col("p_size"), F.col("p_type"), F.when(F.col("p_partkey") % 2 == 0, "_ANS"), F.col("collision"))
    track = N.track_path(F.lit("tracks"), F.when(F.col("p_partkey") % 5 != 0, F.col("p_name")), F.col("p_brand"), F.lit("0101"), F.col("p_type"), F.lit(111), F.lit(1), F.lit(" "), F.lit(None), F.lit(None))
    return p.select("p_partkey", path.alias("path"), N.relative_to(path, "/root/files/").alias("relative"), N.has_collision_suffix(path).alias("collides"), track.alias("track"))


def sheet_keys(spark, d):
    o = table(spark, d, "orders")
    return o.groupBy(B.sheet_key(F.col("o_orderpriority"), F.lit(None), F.col("o_orderstatus"), F.year("o_orderdate")).alias("sheet")).agg(rows())


def candidate_payload(spark, d):
    """Candidates beside their issues, review and audit, with the options in compact form and the block cut as exports have it."""
    c = B.with_issues(candidates(spark, d))
    c = c.withColumns({"n_issues": F.size("issues").cast("long"), "n_errors": F.size(F.filter("issues", lambda x: x["severity"] == "error")).cast("long")})
    review = _states(spark, d).select(F.col("candidate_key").alias("doc_id"), F.struct("review_action", "is_reviewed").alias("review"), F.struct("ai_effective_status").alias("ai"))
    j = c.join(review, "doc_id", "left")
    text = F.array_join(F.transform(B.compact_options(F.col("options")), lambda o: F.concat(o["key"], F.lit("."), o["text"])), "\n")
    return j.select("doc_id", F.length("stem").cast("long").alias("stem_length"), F.left(text, F.lit(2000)).alias("options"), "n_issues", "n_errors", F.col("review.review_action").alias("action"), F.col("ai.ai_effective_status").alias("ai_status"))


def repair_scope(spark, d):
    """Keys to rebuild: in the chosen scope, and never with a protected action."""
    s = _states(spark, d)
    action = F.when(F.col("is_reviewed"), F.col("review_action")).otherwise("unreviewed")
    return s.filter(~action.isin("accept", "unblock", "block") & ((F.col("candidate_key") % 3 == 0) | ~F.col("is_reviewed"))).select("candidate_key")


QUERIES = {
    "answer_tables": (answer_tables, f"WITH {ANSWERS_SQL} SELECT * FROM answers"),
    "question_parse": (question_parse, """WITH l AS (SELECT l_orderkey, l_linenumber AS i, min(l_partkey) AS p FROM lineitem WHERE l_linenumber BETWEEN 1 AND 5 GROUP BY ALL)
      SELECT l_orderkey, '第1至9題 order ' || l_orderkey AS stem, count(*) AS n_options, string_agg(substr('ABCDE', i, 1) || '=part ' || p || ' E. coli', ';' ORDER BY i) AS options, 'q001-q009' AS group_ref FROM l GROUP BY 1"""),
    "question_types": (question_types, None),
    "answers_joined": (answers_joined, f"WITH {ANSWERS_SQL} SELECT u.number::BIGINT AS number, coalesce(answer, 'missing') AS answer, count(*) AS n FROM orders CROSS JOIN (SELECT unnest(range(1, 6)) AS number) u LEFT JOIN answers a ON a.l_orderkey = o_orderkey AND a.number = u.number GROUP BY ALL"),
    "candidate_issue_codes": (candidate_issue_codes, f"WITH {CODES_SQL} SELECT * FROM codes"),
    "failure_codes": (failure_codes, """SELECT l_orderkey, CASE WHEN q IS NULL THEN 'missing_question_markdown' WHEN a IS NULL THEN 'missing_answer_markdown' ELSE 'no_questions_parsed' END AS issue_code, 'blocked' AS severity
      FROM (SELECT l_orderkey, max(l_partkey) FILTER (l_returnflag = 'N') AS q, max(l_partkey) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_quantity > 40) AS n FROM lineitem GROUP BY 1) WHERE q IS NULL OR a IS NULL OR n = 0"""),
    "gate_split": (gate_split, f"""WITH {CODES_SQL}, r AS (SELECT *, CASE severity WHEN 'error' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END AS k, issue_code IN ('missing_answer', 'missing_answer_markdown', 'unexpected_answer_value') AS ans FROM codes)
      SELECT doc_id, ['pass', 'needs_review', 'blocked'][coalesce(max(k) FILTER (NOT ans), 0) + 1] AS question_status, ['pass', 'needs_review', 'blocked'][coalesce(max(k) FILTER (ans), 0) + 1] AS answer_status FROM r GROUP BY 1"""),
    "notation_audit": (notation_audit, None),
    "parsed_papers": (parsed_papers, PAPERS_SQL),
    "review_page_order": (review_page_order, """SELECT * FROM (SELECT nullif(o_orderpriority, '3-MEDIUM') AS category, o_orderstatus AS subject, CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE year(o_orderdate)::VARCHAR END AS year, (o_custkey % 4)::VARCHAR AS ordinal,
      (o_orderkey % 50) || CASE WHEN o_orderkey % 3 = 0 THEN 'b' ELSE '' END AS number, o_orderkey AS key FROM orders)
      ORDER BY coalesce(category, ''), subject, CASE WHEN regexp_full_match(year, '[0-9]+') THEN year::INTEGER ELSE 0 END DESC, ordinal::INTEGER DESC, CASE WHEN regexp_full_match(number, '[0-9]+') THEN number::INTEGER ELSE 0 END, key LIMIT 500"""),
    "group_names": (group_names, "SELECT coalesce(CASE replace(p_brand, ' ', '') WHEN 'Brand#11' THEN 'one' WHEN 'Brand#12' THEN 'one' WHEN 'Brand#21' THEN 'two' END, replace(coalesce(p_brand, ''), ' ', '')) AS name, count(*) AS n FROM part GROUP BY 1"),
    "event_hashes": (event_hashes, """SELECT event_id, sha256('{"a":' || coalesce(json(props)::VARCHAR, 'null') || ',"b":' || event_id || '}') AS hash, 2::BIGINT AS n, event_id AS b, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""),
    "markup_flags": (markup_flags, r"""SELECT m AS has_markup, m AND r AS needs_review, count(*) AS n FROM (SELECT coalesce(regexp_matches(text, '(<sub>|<sup>|\\[a-zA-Z]+|[α-ωΑ-ΩⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]|[A-Za-z][0-9][A-Za-z0-9]*|\^[0-9+-]+)'), false) AS m,
      coalesce(regexp_matches(text, '(<sub>|<sup>|\\[a-zA-Z]+|\^[0-9+-]+)'), false) AS r FROM documents) GROUP BY ALL"""),
    "corrections_applied": (corrections_applied, f"WITH {REVIEW_SQL} SELECT id, CASE WHEN k % 3 = 0 THEN 's' || k ELSE action END AS stem, CASE WHEN k % 3 = 1 THEN NULL ELSE 'A' END AS answer, CASE WHEN k % 3 = 2 THEN 'a.png,b.png,c.png' ELSE 'a.png' END AS images FROM review"),
    "formal_gate": (formal_gate, "WITH " + GATE_SQL),
    "review_filter_forms": (review_filter_forms, f"WITH {STATES_SQL} SELECT " + ", ".join(f"count(*) FILTER ({c}) AS f{i:02d}" for i, c in enumerate(FORMS_SQL)) + " FROM states"),
    "batch_accept_reasons": (batch_accept_reasons, f"""WITH {STATES_SQL} SELECT CASE WHEN candidate_key % 7 = 0 THEN 'not_found' WHEN a = 'block' THEN 'manual_block' WHEN a = 'accept' THEN 'already_accepted' WHEN ais IN ('needs_review', 'block') THEN 'ai_' || ais
      WHEN qual <> 'pass' THEN 'quality_' || qual ELSE 'saved' END AS reason, count(*) AS n FROM states GROUP BY 1"""),
    "audit_statuses": (audit_statuses, "SELECT doc_id, CASE WHEN quality IS NULL AND toxic IS DISTINCT FROM 1 THEN NULL WHEN lang = 'en' THEN 'pass' WHEN toxic = 1 THEN 'block' WHEN quality = 0 THEN 'needs_review' ELSE 'pass' END AS status FROM documents LEFT JOIN labels USING (doc_id)"),
    "suggested_corrections": (suggested_corrections, """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'given' WHEN doc_id % 2 = 0 THEN lang || ' 氫化鈉' END AS stem, CASE WHEN doc_id % 5 = 0 THEN 'explicit' WHEN doc_id % 2 = 0 THEN '氢 -> 氫;钠 -> 鈉' END AS changes FROM documents"""),
    "repair_badges": (repair_badges, f"WITH {STATES_SQL} SELECT candidate_key, a <> 'accept' AND (coalesce(k % 4 = 0, false) OR NOT rev OR coalesce(k % 9 = 0, false)) AS active FROM states"),
    "export_policies": (export_policies, f"""WITH {STATES_SQL} SELECT count(*) FILTER (a <> 'accept') AS every, count(*) FILTER (a <> 'accept' AND NOT air) AS pending,
      count(*) FILTER (a <> 'accept' AND NOT (air AND k % 7 <> 0 AND k % 4 <> 0 AND k % 6 <> 0)) AS unreliable FROM states"""),
    "answer_refusals": (answer_refusals, f"WITH {ANSWERS_SQL} SELECT CASE WHEN contains(answer, '#') THEN 'unresolved_mark' WHEN number > 4 THEN 'not_eligible' ELSE 'taken' END AS outcome, count(*) AS n FROM answers GROUP BY 1"),
    "event_staging": (event_staging, f"""WITH {REVIEW_SQL} SELECT id, action, CASE k % 4 WHEN 0 THEN 'block' WHEN 1 THEN 'needs_review' ELSE 'pass' END AS audit_status, CASE WHEN k > 30 THEN '{{"k":' || k || '}}' ELSE '{{}}' END AS audit_json
      FROM review WHERE action IN ('accept', 'block', 'comment') AND candidate_key IN (SELECT c_custkey FROM customer)"""),
    "candidate_staging": (candidate_staging, f"WITH {CODES_SQL} SELECT CASE WHEN c.doc_id % 3 = 0 THEN 'unknown_issue' ELSE issue_code END AS issue_code, CASE WHEN c.doc_id % 5 = 0 THEN 'warning' ELSE severity END AS severity, count(*) AS n FROM codes c JOIN documents d USING (doc_id) WHERE coalesce(source, '') <> '' GROUP BY ALL"),
    "json_paths": (json_paths, "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'n' || event_id WHEN 1 THEN 'g' ELSE '' END AS name, event_id % 3 = 1 AS has_name, CASE WHEN event_id % 3 = 0 THEN 3 ELSE 0 END::BIGINT AS n FROM events"),
    "preferences": (preferences, f"""WITH {REVIEW_SQL}, l AS (SELECT candidate_key, '{{"last":"' || coalesce(arg_max(action, (created_at, id)), '') || '"}}' AS p FROM review GROUP BY 1)
      SELECT coalesce(c_custkey, candidate_key) AS reviewer, coalesce(p, '{{"segment":"' || c_mktsegment || '"}}') AS preferences FROM customer FULL JOIN l ON candidate_key = c_custkey"""),
    "hashed_assets": (hashed_assets, "SELECT sha256(text) AS asset_key, min(doc_id) AS doc_id FROM (SELECT * FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 200) GROUP BY 1"),
    "pair_batch": (pair_batch, """SELECT CASE WHEN e IS NULL THEN 'ok' ELSE 'error' END AS status, e AS error, count(*) AS n FROM (SELECT CASE WHEN coalesce(q, 0) = 0 THEN 'no question' WHEN a = 0 THEN 'no answer' END AS e
      FROM orders LEFT JOIN (SELECT l_orderkey, count(*) FILTER (l_returnflag = 'N') AS q, count(*) FILTER (l_returnflag = 'A') AS a FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey) GROUP BY ALL"""),
    "ready_pairs": (ready_pairs, "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'N') AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')"),
    "first_assets": (first_assets, "SELECT l_orderkey, arg_min(l_partkey, (l_linenumber, l_partkey)) AS asset FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1"),
    "answer_report": (answer_report, f"WITH {CODES_SQL} SELECT doc_id, len(raw) AS n_options, len(list_distinct(raw)) AS n_labels, CASE q WHEN 1 THEN 'A' WHEN 0 THEN 'x1' END AS answer FROM cand"),
    "batch_index": (batch_index, "SELECT DISTINCT 'p/' || (l_partkey + 5) AS path, coalesce(p_brand, 'unindexed') AS brand, coalesce(p_brand, (l_partkey + 5)::VARCHAR) AS label FROM lineitem LEFT JOIN part ON p_partkey = l_partkey + 5"),
    "merged_results": (merged_results, "SELECT p_size, l_linestatus, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey + 5 GROUP BY ALL"),
    "outputs_by_stem": (outputs_by_stem, """WITH o AS (SELECT lower(p_brand) || (p_partkey % 40) AS stem, max(p_partkey) AS official FROM part GROUP BY 1)
      SELECT s_suppkey, official, CASE WHEN official IS NULL THEN 'error' ELSE 'ok' END AS status FROM supplier LEFT JOIN o ON o.stem = 'brand#' || (s_suppkey % 60 + 10) || (s_suppkey % 40)"""),
    "progress_table": (progress_table, """SELECT c_mktsegment, count(*) AS expected, coalesce(any_value(g), 0) AS got, round(coalesce(any_value(g), 0) / count(*), 4) AS ratio FROM customer LEFT JOIN (SELECT c_mktsegment, count(DISTINCT o_custkey) AS g
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY 1) USING (c_mktsegment) GROUP BY 1"""),
    "local_paths": (local_paths, "SELECT p_partkey, '/data/batch/docs/' || p_brand || '/' || p_partkey || '.pdf' AS path, true AS safe FROM part"),
    "track_subjects": (track_subjects, "SELECT p_brand, p_name, p_size, count(*) AS n, count(DISTINCT p_type) AS n_types, min(p_retailprice) AS low, max(p_retailprice) AS high FROM part GROUP BY ALL"),
    "catalog_counts": (catalog_counts, """WITH y AS (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1), e AS (SELECT year(o_orderdate) AS y, o_orderpriority AS p, count(DISTINCT o_custkey) AS c, count(*) AS n FROM orders GROUP BY ALL)
      SELECT 1 AS place, '| Year | Rows |' AS line UNION ALL SELECT 2, '|---|---|' UNION ALL SELECT 2 + row_number() OVER (ORDER BY y DESC), '| ' || y || ' | ' || n || ' |' FROM y
      UNION ALL SELECT 1000000, '| Year | Exam | Categories | Subjects |' UNION ALL SELECT 1000001, '|---|---|---|---|' UNION ALL SELECT 1000001 + row_number() OVER (ORDER BY y DESC, p DESC), '| ' || y || ' | ' || p || ' | ' || c || ' | ' || n || ' |' FROM e"""),
    "status_counters": (status_counters, """WITH c AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem WHERE l_linestatus IS NOT NULL GROUP BY ALL UNION ALL SELECT 'all', l_linestatus, count(*) FROM lineitem WHERE l_linestatus IS NOT NULL GROUP BY ALL)
      SELECT l_returnflag, '{' || string_agg('"' || l_linestatus || '":' || n, ',' ORDER BY l_linestatus) || '}' AS counts FROM c GROUP BY 1"""),
    "peak_usage": (peak_usage, "SELECT l_linenumber AS workers, max(l_extendedprice) AS peak_memory, max(l_quantity) AS peak_load, count(*) FILTER (l_returnflag <> 'R') AS n_ok, count(*) AS n FROM lineitem GROUP BY 1"),
    "expectations": (expectations, "SELECT o_orderpriority, count(DISTINCT year(o_orderdate)) AS sessions, count(*) AS rows, sum(CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 2 END)::BIGINT AS documents FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1"),
    "scope_plan": (scope_plan, "SELECT o_orderkey, year(o_orderdate) AS year FROM orders WHERE coalesce(o_orderpriority, '') <> '5-LOW' AND o_orderstatus IN ('F', 'O') ORDER BY year DESC, o_orderpriority, o_custkey, o_orderstatus, o_orderkey LIMIT 300"),
    "name_matches": (name_matches, "SELECT DISTINCT replace(p_brand, ' ', '') AS name FROM part WHERE p_partkey % 4 <> 0 AND replace(p_brand, ' ', '') IN (SELECT replace(p_brand, ' ', '') FROM part WHERE p_size < 5)"),
    "unscoped_page": (unscoped_page, "SELECT event_id, user_id FROM events ORDER BY event_id LIMIT 75"),
    "sheet_orders": (sheet_orders, """SELECT 'sheet' AS kind, o_orderkey FROM (SELECT * FROM orders ORDER BY year(o_orderdate), o_orderpriority, o_orderkey LIMIT 50)
      UNION ALL SELECT 'group', o_orderkey FROM (SELECT * FROM orders ORDER BY year(o_orderdate) DESC, o_orderpriority DESC, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, o_orderkey LIMIT 50)"""),
    "rank_reports": (rank_reports, """SELECT p_brand, place, p_type, n FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS place FROM
      (SELECT p_brand, p_type, count(*) AS n FROM part WHERE p_type NOT IN (SELECT p_type FROM part WHERE p_size IN (49, 50) AND p_type IS NOT NULL) GROUP BY ALL)) WHERE place <= 5"""),
    "active_notes": (active_notes, f"""WITH {REVIEW_SQL}, l AS (SELECT candidate_key, arg_max(action, (created_at, id)) AS action, arg_max(coalesce(k, -1), (created_at, id)) AS k FROM review GROUP BY 1)
      SELECT candidate_key, action, 'note ' || k AS note FROM l WHERE action IN ('block', 'comment') AND k >= 0 AND k % 4 <> 0"""),
    "ordering_switch": (ordering_switch, "SELECT s_suppkey, false AS backwards FROM (SELECT * FROM supplier ORDER BY s_suppkey LIMIT 20) UNION ALL SELECT s_suppkey, true FROM (SELECT * FROM supplier ORDER BY s_suppkey DESC LIMIT 20)"),
    "unique_in_order": (unique_in_order, "SELECT doc_id, concat_ws(' ', source, lang, 'x') AS words FROM documents"),
    "labels_cleaned": (labels_cleaned, "SELECT p_partkey, CASE WHEN p_partkey % 3 = 1 THEN p_brand ELSE p_brand || '_' || p_type || '_x' END AS label, p_brand AS level, p_type || '_x' AS name FROM part"),
    "document_paths": (document_paths, """SELECT p_partkey, '/root/files/' || tail AS path, tail AS relative, p_partkey % 4 = 0 AS collides, track FROM (SELECT *, b || '/110/第' || p_size || '次/110' || p_size || '_' || b || '_' || t || CASE WHEN p_partkey % 4 = 0 THEN '_E' || lpad(p_partkey::VARCHAR, 5, '0') ELSE '' END
        || CASE WHEN p_partkey % 2 = 0 THEN '_ANS' ELSE '' END || '.pdf' AS tail,
        'tracks/' || CASE WHEN p_partkey % 5 <> 0 THEN replace(p_name, ' ', '') ELSE 'no_exam_level' END || '/' || b || '/C0101_' || t || '/111/第1次/1111_C0101_' || t || '_no_subject_name.pdf' AS track
      FROM (SELECT *, replace(p_brand, ' ', '') AS b, replace(p_type, ' ', '') AS t FROM part))"""),
    "sheet_keys": (sheet_keys, "SELECT coalesce(o_orderpriority, '') || '||' || coalesce(o_orderstatus, '') || '|' || coalesce(year(o_orderdate)::VARCHAR, '') AS sheet, count(*) AS n FROM orders GROUP BY 1"),
    "candidate_payload": (candidate_payload, f"""WITH {CODES_SQL}, {STATES_SQL}, i AS (SELECT doc_id, count(*) AS n, count(*) FILTER (severity = 'error') AS e FROM codes GROUP BY 1),
      o AS (SELECT doc_id, left(coalesce(array_to_string(list_transform(list_sort(list_transform(range(1, len(raw) + 1), lambda x: raw[x] || lpad(x::VARCHAR, 9, '0'))), lambda x: x[1] || '.' || texts[x[2:]::INTEGER]), chr(10)), ''), 2000) AS options FROM cand)
      SELECT c.doc_id, length(stem) AS stem_length, options, coalesce(n, 0) AS n_issues, coalesce(e, 0) AS n_errors, CASE WHEN rev THEN a WHEN NOT rev THEN 'reset_review' END AS action, ais AS ai_status FROM cand c JOIN o USING (doc_id) LEFT JOIN i USING (doc_id) LEFT JOIN states s ON s.candidate_key = c.doc_id"""),
    "repair_scope": (repair_scope, f"WITH {STATES_SQL} SELECT candidate_key FROM states WHERE CASE WHEN rev THEN a ELSE 'unreviewed' END NOT IN ('accept', 'unblock', 'block') AND (candidate_key % 3 = 0 OR NOT rev)"),
}
