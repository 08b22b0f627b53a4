"""Review state: latest events, folds, pages, facets, search, pipeline counts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import logs, relational as R
from .common import REVIEW_SQL, review_events, table

ORDER = ["created_at", "id"]


def latest_distinct_on(spark, d):
    e = review_events(spark, d)
    return R.distinct_on(e, ["candidate_key"], [F.desc("created_at"), F.desc("id")]).select("candidate_key", "action", "id")


def log_fold_carry(spark, d):
    f = logs.fold_with_reset(review_events(spark, d), "candidate_key", ORDER, "action", "reset_review", ("correction", F.col("has_correction")))
    return f.select("candidate_key", "state", "action", F.when(F.col("state") == "latest", F.col("carried")).cast("long").alias("correction"))


def log_fold_reset(spark, d):
    return logs.last_event(review_events(spark, d), "candidate_key", ORDER, ["action", "id"], ("action", "reset_review"))


def log_fold_counts(spark, d):
    e = review_events(spark, d)
    n = e.groupBy("candidate_key").agg(F.count(F.lit(1)).alias("n_events"))
    return logs.fold_with_reset(e, "candidate_key", ORDER, "action", "reset_review").join(n, "candidate_key").select("candidate_key", "state", "n_events")


def log_fold_scoped(spark, d):
    """Latest actions of the keys that are labelled good; reset keys are left out."""
    good = table(spark, d, "labels").filter("quality = 1").select(F.col("doc_id").alias("candidate_key"))
    return logs.last_event(review_events(spark, d), "candidate_key", ORDER, ["action", "id"], ("action", "reset_review"), good)


def log_last_wins_notes(spark, d):
    last = logs.last_event(review_events(spark, d), "candidate_key", ORDER, ["action", "id", "k"])
    return last.filter(F.col("action").isin("block", "comment") & F.col("k").isNotNull()).select("candidate_key", "action", "id", F.col("k").cast("long").alias("k"))


def review_page_counts(spark, d):
    docs = table(spark, d, "documents").withColumn("long_text", F.col("n_chars") > 2000)
    page = R.counted_page(docs, [F.asc("lang"), F.asc("source"), F.desc("n_chars"), F.asc("doc_id")], R.clamp_limit("40"), F.col("long_text"))
    return page.select("doc_id", "lang", "source", "total", "flagged")


def facets_except_self(spark, d):
    return R.facets(table(spark, d, "documents"), {"lang": "en", "source": "src1"})


def not_accept_filter(spark, d):
    last = logs.last_event(review_events(spark, d), "candidate_key", ORDER, ["action"], ("action", "reset_review"))
    return last.filter(F.col("action") != "accept").select("candidate_key", "action")


def text_search(spark, d):
    return table(spark, d, "documents").filter(R.contains_text("TION O", "text", "source")).select("doc_id", "lang")


def optional_filter(spark, d):
    return R.optional_filters(table(spark, d, "documents"), {"lang": "de", "source": "", "n_chars": None}).select("doc_id", "source")


def year_window_filter(spark, d):
    o = table(spark, d, "orders").filter(R.within_years(F.col("o_orderdate"), 1995, 1993))
    return o.groupBy(F.year("o_orderdate").cast("long").alias("year")).agg(F.count(F.lit(1)).alias("n"))


def pipeline_counts(spark, d):
    last = logs.last_event(review_events(spark, d), "candidate_key", ORDER, ["action"])
    n = lambda c: F.count_if(c)
    a = F.col("action")
    return last.agg(
        F.count(F.lit(1)).alias("total"), n(a != "reset_review").alias("reviewed"), n(a == "accept").alias("accepted"), n(a == "block").alias("blocked"),
        n(a == "comment").alias("commented"), n(a == "reset_review").alias("reset"),
    )


def total_over_page(spark, d):
    """Counts beside each row of its key: a window keyed by the page's scope."""
    e = review_events(spark, d)
    w = Window.partitionBy("candidate_key")
    return e.select("candidate_key", "id", F.count(F.lit(1)).over(w).alias("n"), F.sum(F.when(F.col("action") == "accept", 1).otherwise(0)).over(w).alias("accepts"))


def total_over_table(spark, d):
    """Counts beside every event: counted by key first, then joined back, so that a hot key needs no window."""
    e = review_events(spark, d)
    n = e.groupBy("candidate_key").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("action") == "accept").alias("accepts"))
    j = e.select(F.col("candidate_key").alias("own"), "id").join(n, F.col("own").eqNullSafe(F.col("candidate_key")))
    return j.select("candidate_key", "id", "n", "accepts")


def correct_action_rewrite(spark, d):
    """Corrections (events with a payload of 50 or more) take the action of the key's state before them."""
    return logs.corrected_actions(review_events(spark, d), "candidate_key", ORDER, "action", F.col("has_correction"), "reset_review").select("id", "action")


def batch_accept_guard(spark, d):
    """First reason that keeps a key from being accepted in a batch."""
    e = review_events(spark, d)
    g = e.groupBy("candidate_key").agg(F.max_by("action", F.struct(*ORDER)).alias("last"), F.bool_or(F.col("action") == "block").alias("ever"), F.count(F.lit(1)).alias("n"))
    reason = F.when(F.col("last") == "accept", "already_accepted").when(F.col("last") == "block", "blocked").when(F.col("ever"), "was_blocked").when(F.col("n") < 3, "too_few_events").otherwise("ok")
    return g.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def ai_effective_status(spark, d):
    """Verdicts of labels as statuses; deferred ones pass, unlabelled documents need review."""
    docs = table(spark, d, "documents").select("doc_id")
    j = docs.join(table(spark, d, "labels"), "doc_id", "left")
    status = F.when(F.col("quality").isNull(), "unreviewed").when(F.col("toxic") == 1, "block").when(F.col("quality") == 0, "needs_review").otherwise("pass")
    return j.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def pending_audit(spark, d):
    """Documents without a verdict, in order, the first 25."""
    docs = table(spark, d, "documents")
    return docs.join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti").orderBy(F.desc("n_chars"), "doc_id").limit(25).select("doc_id", "n_chars")


QUERIES = {
    "latest_distinct_on": (latest_distinct_on, f"WITH {REVIEW_SQL} SELECT candidate_key, action, id FROM review QUALIFY row_number() OVER (PARTITION BY candidate_key ORDER BY created_at DESC, id DESC) = 1"),
    "log_fold_carry": (log_fold_carry, f"""WITH {REVIEW_SQL},
      seg AS (SELECT *, sum(CASE WHEN action = 'reset_review' THEN 1 ELSE 0 END) OVER (PARTITION BY candidate_key ORDER BY created_at, id) AS s FROM review),
      car AS (SELECT *, max(CASE WHEN has_correction AND action <> 'reset_review' THEN row_at END) OVER (PARTITION BY candidate_key, s ORDER BY created_at, id) AS src
        FROM (SELECT *, row_number() OVER (PARTITION BY candidate_key ORDER BY created_at, id) AS row_at FROM seg)),
      last AS (SELECT * FROM car QUALIFY row_number() OVER (PARTITION BY candidate_key ORDER BY created_at DESC, id DESC) = 1)
      SELECT l.candidate_key, CASE WHEN l.action = 'reset_review' THEN 'reset' ELSE 'latest' END AS state, l.action,
        CASE WHEN l.action <> 'reset_review' THEN c.correction::BIGINT END AS correction
      FROM last l LEFT JOIN car c ON c.candidate_key = l.candidate_key AND c.row_at = l.src"""),
    "log_fold_reset": (log_fold_reset, f"WITH {REVIEW_SQL} SELECT * FROM (SELECT candidate_key, arg_max(action, (created_at, id)) AS action, arg_max(id, (created_at, id)) AS id FROM review GROUP BY candidate_key) WHERE action <> 'reset_review'"),
    "log_fold_scoped": (log_fold_scoped, f"WITH {REVIEW_SQL} SELECT * FROM (SELECT candidate_key, arg_max(action, (created_at, id)) AS action, arg_max(id, (created_at, id)) AS id FROM review WHERE candidate_key IN (SELECT doc_id FROM labels WHERE quality = 1) GROUP BY candidate_key) WHERE action <> 'reset_review'"),
    "log_fold_counts": (log_fold_counts, f"WITH {REVIEW_SQL} SELECT candidate_key, CASE arg_max(action, (created_at, id)) WHEN 'reset_review' THEN 'reset' ELSE 'latest' END AS state, count(*) AS n_events FROM review GROUP BY candidate_key"),
    "log_last_wins_notes": (log_last_wins_notes, f"""WITH {REVIEW_SQL}, last AS (SELECT * FROM review QUALIFY row_number() OVER (PARTITION BY candidate_key ORDER BY created_at DESC, id DESC) = 1)
      SELECT candidate_key, action, id, k::BIGINT AS k FROM last WHERE action IN ('block', 'comment') AND k IS NOT NULL"""),
    "review_page_counts": (review_page_counts, """SELECT doc_id, lang, source, (SELECT count(*) FROM documents) AS total, (SELECT count(*) FROM documents WHERE n_chars > 2000) AS flagged
      FROM documents ORDER BY lang, source, n_chars DESC, doc_id LIMIT 40"""),
    "facets_except_self": (facets_except_self, "SELECT DISTINCT 'lang' AS facet, lang AS value FROM documents WHERE source = 'src1' AND lang IS NOT NULL UNION SELECT DISTINCT 'source', source FROM documents WHERE lang = 'en' AND source IS NOT NULL"),
    "not_accept_filter": (not_accept_filter, f"WITH {REVIEW_SQL} SELECT * FROM (SELECT candidate_key, arg_max(action, (created_at, id)) AS action FROM review GROUP BY candidate_key) WHERE action NOT IN ('accept', 'reset_review')"),
    "text_search": (text_search, "SELECT doc_id, lang FROM documents WHERE contains(lower(concat_ws(' ', text, source)), 'tion o')"),
    "optional_filter": (optional_filter, "SELECT doc_id, source FROM documents WHERE lang = 'de'"),
    "year_window_filter": (year_window_filter, "SELECT year(o_orderdate) AS year, count(*) AS n FROM orders WHERE year(o_orderdate) BETWEEN 1993 AND 1995 GROUP BY 1"),
    "pipeline_counts": (pipeline_counts, f"""WITH {REVIEW_SQL}, last AS (SELECT arg_max(action, (created_at, id)) AS a FROM review GROUP BY candidate_key)
      SELECT count(*) AS total, count(*) FILTER (a <> 'reset_review') AS reviewed, count(*) FILTER (a = 'accept') AS accepted, count(*) FILTER (a = 'block') AS blocked,
        count(*) FILTER (a = 'comment') AS commented, count(*) FILTER (a = 'reset_review') AS reset FROM last"""),
    "total_over_page": (total_over_page, f"""WITH {REVIEW_SQL} SELECT candidate_key, id, count(*) OVER (PARTITION BY candidate_key) AS n,
      (count(*) FILTER (action = 'accept') OVER (PARTITION BY candidate_key))::BIGINT AS accepts FROM review"""),
    "total_over_table": (total_over_table, f"""WITH {REVIEW_SQL} SELECT candidate_key, id, count(*) OVER (PARTITION BY candidate_key) AS n,
      count(*) FILTER (action = 'accept') OVER (PARTITION BY candidate_key) AS accepts FROM review"""),
    "correct_action_rewrite": (correct_action_rewrite, f"""WITH {REVIEW_SQL},
      seen AS (SELECT *, count(CASE WHEN NOT has_correction THEN 1 END) OVER (PARTITION BY candidate_key ORDER BY created_at, id) AS run FROM review),
      state AS (SELECT candidate_key, run, action FROM seen WHERE NOT has_correction)
      SELECT e.id, CASE WHEN NOT has_correction THEN e.action WHEN s.action IN ('accept', 'block', 'comment', 'reviewed') THEN s.action ELSE 'reviewed' END AS action
      FROM seen e LEFT JOIN state s ON s.candidate_key = e.candidate_key AND s.run = e.run"""),
    "batch_accept_guard": (batch_accept_guard, f"""WITH {REVIEW_SQL}, g AS (SELECT candidate_key, arg_max(action, (created_at, id)) AS last, bool_or(action = 'block') AS ever, count(*) AS n FROM review GROUP BY 1)
      SELECT CASE WHEN last = 'accept' THEN 'already_accepted' WHEN last = 'block' THEN 'blocked' WHEN ever THEN 'was_blocked' WHEN n < 3 THEN 'too_few_events' ELSE 'ok' END AS reason, count(*) AS n FROM g GROUP BY 1"""),
    "ai_effective_status": (ai_effective_status, """SELECT CASE WHEN quality IS NULL THEN 'unreviewed' WHEN toxic = 1 THEN 'block' WHEN quality = 0 THEN 'needs_review' ELSE 'pass' END AS status, count(*) AS n
      FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1"""),
    "pending_audit": (pending_audit, "SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY n_chars DESC, doc_id LIMIT 25"),
}
