"""Candidates and their documents: issues, gaps, keys, answer and group sheets, gate and promotion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational as R
from ..operators import review as V
from ..operators import rules as G
from . import bank
from .common import REVIEW_SQL, review_events, table

ISSUES = [
    ("empty_stem", "error", lambda: F.trim("text") == ""),
    ("short_stem", "warning", lambda: F.length("text") < 300),
    ("too_many_brackets", "info", lambda: F.length("text") - F.length(F.replace("text", F.lit("("), F.lit(""))) >= 1),
    ("suspicious_chars", "warning", lambda: F.col("text").rlike("[#*]{2,}")),
    ("markup_needs_review", "warning", lambda: F.contains(F.col("text"), F.lit("\\"))),
    ("missing_source", "blocked", lambda: F.col("source").isNull()),
    ("unusual_source", "error", lambda: F.col("source").isin("src3", "src7")),
]
ISSUES_SQL = """issues AS (SELECT doc_id, unnest(list_filter([
  CASE WHEN trim(text) = '' THEN 'empty_stem:error' END, CASE WHEN length(text) < 300 THEN 'short_stem:warning' END,
  CASE WHEN contains(text, '(') THEN 'too_many_brackets:info' END, CASE WHEN regexp_matches(text, '[#*]{2,}') THEN 'suspicious_chars:warning' END,
  CASE WHEN contains(text, chr(92)) THEN 'markup_needs_review:warning' END, CASE WHEN source IS NULL THEN 'missing_source:blocked' END,
  CASE WHEN source IN ('src3', 'src7') THEN 'unusual_source:error' END], lambda x: x IS NOT NULL)) AS said FROM documents),
 coded AS (SELECT doc_id, split_part(said, ':', 1) AS issue_code, split_part(said, ':', 2) AS severity FROM issues)"""


def _rules():
    return [(c, s, f()) for c, s, f in ISSUES]


def _issues(spark, d):
    return G.rules_to_issues(table(spark, d, "documents"), ["doc_id"], _rules())


def issue_rules(spark, d):
    return _issues(spark, d)


def issue_flags(spark, d):
    i = _issues(spark, d).filter(F.col("issue_code") != "missing_source")
    return i.groupBy("doc_id").agg(F.bool_or(F.col("severity").isin("error", "blocked")).alias("has_error"), F.bool_or(F.col("severity") == "warning").alias("has_warning"))


def issue_status(spark, d):
    s = G.status_by_rules(table(spark, d, "documents"), ["doc_id"], _rules())
    return s.groupBy("quality_status", "issue_count").agg(F.count(F.lit(1)).alias("n"))


def _gaps(c):
    return R.gaps(c, "conv_id", "turn").select("conv_id", F.array_join(F.transform("missing", lambda x: x.cast("string")), ",").alias("missing"))


def document_gaps(spark, d):
    return _gaps(table(spark, d, "conversations").withColumn("turn", F.col("turn") * 3))


def document_gaps_whole(spark, d):
    return _gaps(table(spark, d, "conversations"))


def duplicate_numbers(spark, d):
    c = table(spark, d, "conversations").withColumn("number", F.floor(F.col("turn") / 2))
    return c.groupBy("conv_id", "number").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def dup_key_suffix(spark, d):
    c = table(spark, d, "conversations").withColumn("number", F.floor(F.col("turn") / 2).cast("int"))
    base = F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit(":q"), F.lpad(F.col("number").cast("string"), 3, "0"))
    return R.occurrence_keys(c, ["conv_id", "number"], [F.asc("turn")], base).select("conv_id", "turn", "candidate_key")


def _sheet(c):
    """Numbers 0 to the greatest of each sheet, with placeholders; a repeated number is its last row."""
    return R.filled_sheet(c, "conv_id", "turn", ["role", "text"], ["role"]).select("conv_id", "turn", "role", "placeholder")


def answer_sheet_fill(spark, d):
    return _sheet(table(spark, d, "conversations").withColumn("turn", F.col("turn") * 3 + 2))


def answer_sheet_whole(spark, d):
    return _sheet(table(spark, d, "conversations"))


def answer_sheet_status(spark, d):
    e = review_events(spark, d).groupBy("candidate_key").agg(F.max_by("action", F.struct("created_at", "id")).alias("action"))
    n = lambda a: F.count_if(F.col("action") == a)
    s = e.groupBy((F.col("candidate_key") % 40).alias("sheet")).agg(F.count(F.lit(1)).alias("total"), n("block").alias("blocked"), n("comment").alias("review"), n("accept").alias("accepted"), F.count_if(F.col("action") != "reset_review").alias("reviewed"))
    return s.select("sheet", "total", G.sheet_status(F.col("blocked"), F.col("review"), F.col("accepted"), F.col("total"), F.col("reviewed")).alias("status"))


def group_sheet(spark, d):
    """Rows and reasons of each source: a histogram of issue codes as text."""
    i = _issues(spark, d).join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    h = i.groupBy("source", "issue_code").agg(F.count(F.lit(1)).alias("n"))
    pairs = F.transform(F.array_sort(F.collect_list(F.struct("issue_code", "n"))), lambda x: F.concat_ws(":", x["issue_code"], x["n"].cast("string")))
    return h.groupBy("source").agg(F.sum("n").alias("n_issues"), F.array_join(pairs, ";").alias("reasons"))


def _preflight(spark, d):
    status = G.status_by_rules(table(spark, d, "documents"), ["doc_id"], _rules(), ["n_chars"])
    last = review_events(spark, d).groupBy("candidate_key").agg(F.max_by("action", F.struct("created_at", "id")).alias("action"))
    j = status.join(last.withColumnRenamed("candidate_key", "doc_id"), "doc_id", "left").join(table(spark, d, "labels"), "doc_id", "left")
    action = F.coalesce("action", F.lit(""))
    return j.select(
        "doc_id",
        G.reasons([
            ("quality_blocked", (F.col("quality_status") == "blocked") & (action != "accept")), ("question_review_missing_accept", action != "accept"),
            ("answer_review_missing", F.col("quality").isNull()), ("answer_blocked", F.coalesce(F.col("toxic") == 1, F.lit(False))),
        ]).alias("reasons"),
        G.reasons([("quality_resolved_by_review", (F.col("quality_status") == "blocked") & (action == "accept")), ("long_text", F.col("n_chars") > 3000)]).alias("warnings"),
    ).withColumn("status", G.gate(F.col("reasons")))


PREFLIGHT_SQL = f"""{REVIEW_SQL}, {ISSUES_SQL},
 st AS (SELECT d.doc_id, d.n_chars, max(CASE severity WHEN 'error' THEN 2 WHEN 'blocked' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END) AS rank FROM documents d LEFT JOIN coded c ON c.doc_id = d.doc_id GROUP BY 1, 2),
 la AS (SELECT candidate_key, arg_max(action, (created_at, id)) AS action FROM review GROUP BY 1),
 j AS (SELECT st.*, coalesce(la.action, '') AS a, quality, toxic FROM st LEFT JOIN la ON la.candidate_key = st.doc_id LEFT JOIN labels l ON l.doc_id = st.doc_id),
 pre AS (SELECT doc_id, concat_ws(';', CASE WHEN rank = 2 AND a <> 'accept' THEN 'quality_blocked' END, CASE WHEN a <> 'accept' THEN 'question_review_missing_accept' END,
   CASE WHEN quality IS NULL THEN 'answer_review_missing' END, CASE WHEN toxic = 1 THEN 'answer_blocked' END) AS reasons,
   concat_ws(';', CASE WHEN rank = 2 AND a = 'accept' THEN 'quality_resolved_by_review' END, CASE WHEN n_chars > 3000 THEN 'long_text' END) AS warnings FROM j)"""


def preflight(spark, d):
    return _preflight(spark, d)


def preflight_top_reasons(spark, d):
    return G.top_reasons(_preflight(spark, d), "reasons", 20)


def promote_options(spark, d):
    """Option rows of the candidates that pass the gate."""
    ready = _preflight(spark, d).filter("status = 'ready'").select("doc_id")
    c = bank.candidates(spark, d).join(ready, "doc_id", "left_semi").select(F.col("doc_id").alias("candidate_key"), "source", F.lit(None).cast("string").alias("group_ref"), "stem", "options", "answer", F.col("image_refs").alias("refs"))
    return V.promoted(c)["options"].select(F.col("candidate_key").alias("doc_id"), F.col("option_order").cast("long").alias("option_order"), "option_label", "option_text")


def risk_labels(spark, d):
    t = F.col("text")
    found = G.labels([("digits", t.rlike("[0-9]")), ("brackets", F.contains(t, F.lit("("))), ("long", F.length(t) > 2000), ("pipe", F.contains(t, F.lit("|"))), ("caps", t.rlike("[A-Z]{4,}"))])
    return table(spark, d, "documents").select("doc_id", F.array_join(found, ";").alias("labels"))


def reconcile_documents(spark, d):
    """Every document against the others of its source and language by whole texts; unmatched ones too."""
    docs = table(spark, d, "documents").select("doc_id", F.concat("lang", F.lit("|"), "source").alias("folder"), F.col("text").alias("name"))
    return V.reconciled(docs, docs, key="doc_id").select(F.col("wanted").alias("doc_id"), "score", "status", F.col("found").alias("best"))


def reconcile_prefix(spark, d):
    """The documents that another one of their source and language begins like."""
    return reconcile_documents(spark, d).filter("status <> 'unmatched'")


def reconcile_counts(spark, d):
    """How many documents were matched, are ambiguous, have no match."""
    return reconcile_documents(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


#: Best other document by common prefix: 24 characters or more, or one text inside the other's beginning.
RECONCILED_SQL = """d AS (SELECT doc_id, lang || '|' || source AS f, text AS t FROM documents WHERE text IS NOT NULL),
  j AS (SELECT a.doc_id, b.doc_id AS other, a.t AS x, b.t AS y, least(length(a.t), length(b.t)) AS n FROM d a JOIN d b ON a.f = b.f AND left(a.t, 24) = left(b.t, 24) AND a.doc_id <> b.doc_id AND a.t <> ''
    UNION SELECT a.doc_id, b.doc_id, a.t, b.t, least(length(a.t), length(b.t)) FROM d a JOIN d b ON a.f = b.f AND a.doc_id <> b.doc_id AND a.t <> '' AND b.t <> ''
      AND ((length(b.t) < 24 AND starts_with(a.t, b.t)) OR (length(a.t) < 24 AND starts_with(b.t, a.t)))),
  s AS (SELECT doc_id, other, list_reduce([0, 1048576, 524288, 262144, 131072, 65536, 32768, 16384, 8192, 4096, 2048, 1024, 512, 256, 128, 64, 32, 16, 8, 4, 2, 1],
    lambda p, q: CASE WHEN p + q <= n AND left(x, p + q) = left(y, p + q) THEN p + q ELSE p END)::BIGINT AS score FROM j),
  best AS (SELECT doc_id, score, count(*) AS ties, min(other) AS other FROM s GROUP BY doc_id, score QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC) = 1),
  said AS (SELECT doc_id, score, CASE WHEN ties > 1 THEN 'ambiguous' ELSE 'matched' END AS status, CASE WHEN ties = 1 THEN other END AS best FROM best)"""


QUERIES = {
    "issue_rules": (issue_rules, f"WITH {ISSUES_SQL} SELECT * FROM coded"),
    "issue_flags": (issue_flags, f"WITH {ISSUES_SQL} SELECT doc_id, bool_or(severity IN ('error', 'blocked')) AS has_error, bool_or(severity = 'warning') AS has_warning FROM coded WHERE issue_code <> 'missing_source' GROUP BY 1"),
    "issue_status": (issue_status, f"""WITH {ISSUES_SQL}, st AS (SELECT d.doc_id, count(issue_code) AS issue_count, max(CASE severity WHEN 'error' THEN 2 WHEN 'blocked' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END) AS r FROM documents d LEFT JOIN coded c ON c.doc_id = d.doc_id GROUP BY 1)
      SELECT CASE r WHEN 2 THEN 'blocked' WHEN 1 THEN 'needs_review' ELSE 'pass' END AS quality_status, issue_count, count(*) AS n FROM st GROUP BY ALL"""),
    "document_gaps": (document_gaps, """WITH c AS (SELECT conv_id, turn * 3 AS turn FROM conversations), g AS (SELECT conv_id, unnest(range(min(turn), max(turn) + 1)) AS t FROM c GROUP BY 1)
      SELECT conv_id, string_agg(t, ',' ORDER BY t) AS missing FROM (SELECT g.* FROM g ANTI JOIN c ON c.conv_id = g.conv_id AND c.turn = g.t QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY t) <= 50) GROUP BY 1"""),
    "duplicate_numbers": (duplicate_numbers, "SELECT conv_id, turn // 2 AS number, count(*) AS n FROM conversations GROUP BY ALL HAVING count(*) > 1"),
    "dup_key_suffix": (dup_key_suffix, """SELECT conv_id, turn, 'c' || conv_id || ':q' || lpad((turn // 2)::VARCHAR, 3, '0') || CASE WHEN rn > 1 THEN ':dup' || lpad(rn::VARCHAR, 2, '0') ELSE '' END AS candidate_key
      FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn // 2 ORDER BY turn) AS rn FROM conversations)"""),
    "answer_sheet_fill": (answer_sheet_fill, """WITH c AS (SELECT conv_id, turn * 3 + 2 AS turn, max(role) AS role FROM conversations GROUP BY ALL), g AS (SELECT conv_id, unnest(range(0, max(turn) + 1)) AS turn FROM c GROUP BY 1)
      SELECT g.conv_id, g.turn, role, role IS NULL AS placeholder FROM g LEFT JOIN c USING (conv_id, turn)"""),
    "answer_sheet_status": (answer_sheet_status, f"""WITH {REVIEW_SQL}, la AS (SELECT candidate_key, arg_max(action, (created_at, id)) AS a FROM review GROUP BY 1)
      SELECT candidate_key % 40 AS sheet, count(*) AS total, CASE WHEN bool_or(a = 'block') THEN 'block' WHEN bool_or(a = 'comment') THEN 'needs_review' WHEN bool_and(a = 'accept') THEN 'accept' WHEN bool_or(a <> 'reset_review') THEN 'reviewed' END AS status FROM la GROUP BY 1"""),
    "group_sheet": (group_sheet, f"""WITH {ISSUES_SQL} SELECT source, sum(n)::BIGINT AS n_issues, string_agg(issue_code || ':' || n, ';' ORDER BY issue_code) AS reasons FROM (SELECT source, issue_code, count(*) AS n FROM coded JOIN documents USING (doc_id) GROUP BY ALL) GROUP BY 1"""),
    "preflight": (preflight, f"WITH {PREFLIGHT_SQL} SELECT *, CASE WHEN reasons = '' THEN 'ready' ELSE 'blocked' END AS status FROM pre"),
    "preflight_top_reasons": (preflight_top_reasons, f"WITH {PREFLIGHT_SQL} SELECT reason, count(*) AS n FROM (SELECT unnest(string_split(reasons, ';')) AS reason FROM pre) WHERE reason <> '' GROUP BY 1 ORDER BY n DESC, reason LIMIT 20"),
    "promote_options": (promote_options, f"""WITH {PREFLIGHT_SQL}, {bank.CODES_SQL}, o AS (SELECT doc_id, raw, texts, list_sort(list_transform(range(1, len(raw) + 1), lambda i: raw[i] || lpad(i::VARCHAR, 9, '0'))) AS k FROM cand WHERE doc_id IN (SELECT doc_id FROM pre WHERE reasons = ''))
      SELECT doc_id, i AS option_order, k[i][1] AS option_label, texts[k[i][2:]::INTEGER] AS option_text FROM o, unnest(range(1, len(k) + 1)) AS u(i)"""),
    "risk_labels": (risk_labels, """SELECT doc_id, array_to_string(list_filter([CASE WHEN contains(text, '(') THEN 'brackets' END, CASE WHEN regexp_matches(text, '[A-Z]{4,}') THEN 'caps' END, CASE WHEN regexp_matches(text, '[0-9]') THEN 'digits' END,
      CASE WHEN length(text) > 2000 THEN 'long' END, CASE WHEN contains(text, '|') THEN 'pipe' END], lambda x: x IS NOT NULL), ';') AS labels FROM documents"""),
    "reconcile_prefix": (reconcile_prefix, f"WITH {RECONCILED_SQL} SELECT * FROM said"),
    "document_gaps_whole": (document_gaps_whole, """WITH g AS (SELECT conv_id, unnest(range(min(turn), max(turn) + 1)) AS t FROM conversations GROUP BY 1)
      SELECT conv_id, string_agg(t, ',' ORDER BY t) AS missing FROM (SELECT g.* FROM g ANTI JOIN conversations c ON c.conv_id = g.conv_id AND c.turn = g.t QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY t) <= 50) GROUP BY 1"""),
    "answer_sheet_whole": (answer_sheet_whole, """WITH c AS (SELECT conv_id, turn, max(role) AS role FROM conversations GROUP BY ALL), g AS (SELECT conv_id, unnest(range(0, max(turn) + 1)) AS turn FROM c GROUP BY 1)
      SELECT g.conv_id, g.turn, role, role IS NULL AS placeholder FROM g LEFT JOIN c USING (conv_id, turn)"""),
    "reconcile_documents": (reconcile_documents, f"WITH {RECONCILED_SQL} SELECT doc_id, score, coalesce(status, 'unmatched') AS status, best FROM documents LEFT JOIN said USING (doc_id)"),
    "reconcile_counts": (reconcile_counts, f"WITH {RECONCILED_SQL} SELECT coalesce(status, 'unmatched') AS status, count(*) AS n FROM documents LEFT JOIN said USING (doc_id) GROUP BY 1"),
}
