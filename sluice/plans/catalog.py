"""Catalog roll-ups, pairing, dimensions, upserts, batches."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import logs, relational as R
from ..session import work_folder
from ..sources.merge import StoredTable
from .common import table


def node_label(segment):
    """First match of a cascade: exact names first, then keywords."""
    return F.when(segment.isin("AUTOMOBILE", "BUILDING"), "locked").when(F.contains(segment, F.lit("HOUSE")), "seed").otherwise("future")


def node_summary(spark, d):
    c = table(spark, d, "customer")
    return c.groupBy(node_label(F.col("c_mktsegment")).alias("node")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("c_nationkey").alias("n_nations"), F.count_distinct("c_mktsegment", "c_nationkey").alias("n_pairs"),
        F.count_if(F.col("c_acctbal") > 0).alias("n_positive"), F.min("c_custkey").alias("min_key"), F.max("c_custkey").alias("max_key"),
    )


def category_mode(spark, d):
    """Each status's most common priority; ties go to the one seen first."""
    o = table(spark, d, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first"))
    return o.groupBy("o_orderstatus").agg(F.max_by("o_orderpriority", F.struct("n", -F.col("first"))).alias("mode"), F.sum("n").alias("n_rows"))


def track_top3(spark, d):
    p = table(spark, d, "part").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    top = top_rows(p, "p_brand", [F.desc("n"), F.asc("p_type")], 3)
    return top.groupBy("p_brand").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "p_type"))), lambda x: x["p_type"]), " | ").alias("top_types"))


def top_rows(df, key, order, k):
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("rn") <= k)


def subject_variants(spark, d):
    """Codes with more than one name, with the names joined in order."""
    p = table(spark, d, "part").withColumn("code", (F.col("p_size") * 100 + F.length("p_type")).cast("long"))
    g = p.groupBy("code").agg(F.collect_set("p_brand").alias("names"))
    return g.filter(F.size("names") > 1).select("code", F.array_join(F.array_sort("names"), " | ").alias("names"), F.size("names").cast("long").alias("n_names"))


def pair_documents(spark, d):
    """Roles of each document as a pivot, and the status of the pair."""
    l = table(spark, d, "lineitem")
    p = l.groupBy("l_orderkey").agg(*(F.max(F.when(F.col("l_returnflag") == r, F.col("l_partkey"))).alias(n) for r, n in (("N", "question"), ("A", "answer"), ("R", "correction"))))
    status = F.when(F.col("question").isNull(), "no_question").when(F.col("correction").isNotNull(), "paired_mod_primary").when(F.col("answer").isNotNull(), "paired_ans_only").otherwise("missing_answer")
    return p.groupBy(status.alias("pair_status")).agg(F.count(F.lit(1)).alias("n"), F.count("correction").alias("n_corrections"))


def manifest_summary(spark, d):
    """`status:count;...` in order, and the number of destinations used twice or more."""
    l = table(spark, d, "lineitem")
    by = l.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    said = by.groupBy("l_returnflag").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linestatus", "n"))), lambda x: F.concat_ws(":", x["l_linestatus"], x["n"].cast("string"))), ";").alias("statuses"), F.sum("n").alias("n_rows"))
    twice = l.groupBy("l_returnflag", "l_partkey", "l_suppkey").count().groupBy("l_returnflag").agg(F.count_if(F.col("count") > 1).alias("n_twice"))
    return said.join(twice, "l_returnflag")


def exam_ordinals(spark, d):
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_suppkey") % 5 == 0, (F.col("l_suppkey") % 9).cast("int")).alias("explicit"))
    return logs.ordinals(l, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"], "explicit").select("l_orderkey", "l_linenumber", "ordinal")


def collision_names(spark, d):
    """The first claimant of a destination keeps it; later ones get a suffix."""
    p = table(spark, d, "part").withColumn("dest", F.concat_ws("/", "p_brand", F.col("p_size").cast("string")))
    rn = F.row_number().over(Window.partitionBy("dest").orderBy("p_partkey"))
    return p.select("p_partkey", F.when(rn > 1, F.concat("dest", F.lit("_E"), F.col("p_partkey").cast("string"))).otherwise(F.col("dest")).alias("destination"))


def dimension_join(spark, d):
    c, n, r, o = (table(spark, d, x) for x in ("customer", "nation", "region", "orders"))
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    return j.groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def self_join_roles(spark, d):
    """Each order with three optional role rows of one table."""
    roles = {1: "first", 4: "fourth", 7: "seventh"}
    l = table(spark, d, "lineitem").filter(F.col("l_linenumber").isin(*roles)).groupBy(F.col("l_orderkey").alias("o_orderkey"))
    found = l.agg(*(F.min(F.when(F.col("l_linenumber") == number, F.col("l_partkey"))).alias(name) for number, name in roles.items()))
    return table(spark, d, "orders").select("o_orderkey").join(found, "o_orderkey", "left")


def or_join_union(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("x"), (F.col("s_suppkey") % 25).cast("int").alias("y"))
    n = table(spark, d, "nation").select("n_nationkey", F.col("n_nationkey").alias("nx"), F.col("n_nationkey").alias("ny"))
    return R.or_join(s, n, [("x", "nx"), ("y", "ny")], ["s_suppkey", "n_nationkey"])


def anti_unfinished(spark, d):
    """Parts neither shipped by line 1 nor reserved by a small order."""
    p, l = table(spark, d, "part").select("p_partkey"), table(spark, d, "lineitem")
    done = l.filter("l_linenumber = 1").select(F.col("l_partkey").alias("p_partkey"))
    reserved = l.filter("l_quantity < 3").select(F.col("l_partkey").alias("p_partkey"))
    return p.join(done, "p_partkey", "left_anti").join(reserved, "p_partkey", "left_anti")


def semi_either_path(spark, d):
    """Line items that touch a selected part or supplier, once each."""
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.explode(F.array(F.concat(F.lit("p"), F.col("l_partkey")), F.concat(F.lit("s"), F.col("l_suppkey")))).alias("path"))
    chosen = table(spark, d, "part").filter("p_size = 7").select(F.concat(F.lit("p"), F.col("p_partkey")).alias("path")).unionByName(table(spark, d, "supplier").filter("s_nationkey = 3").select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("path")))
    return l.join(chosen, "path", "left_semi").select("l_orderkey", "l_linenumber").distinct()


def _changed(part, key):
    return part.select(key.alias("p_partkey"), F.when(F.col("p_size") % 4 != 0, F.upper("p_type")).alias("brand"), (F.col("p_size") + F.when(F.col("p_partkey") % 4 == 0, 1).otherwise(0)).cast("int").alias("size"))


def _prices(spark, d):
    """All parts as they were, and changed ones under twice their keys: some known, some new."""
    part = table(spark, d, "part")
    return part.select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_size").alias("size")), _changed(part, F.col("p_partkey") * 2)


OLD_NEW = """old AS (SELECT p_partkey, p_brand AS brand, p_size AS size FROM part),
  new AS (SELECT p_partkey * 2 AS p_partkey, CASE WHEN p_size % 4 <> 0 THEN upper(p_type) END AS brand, (p_size + CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END)::INTEGER AS size FROM part)"""
WHOLE_SQL = """old AS (SELECT p_partkey, p_brand AS brand, p_size AS size FROM part WHERE p_partkey % 3 <> 0),
  new AS (SELECT p_partkey, CASE WHEN p_size % 4 <> 0 THEN upper(p_type) END AS brand, (p_size + CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END)::INTEGER AS size FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0)"""


def upsert_state(spark, d):
    return R.upsert(*_prices(spark, d), ["p_partkey"])


def upsert_stored(spark, d):
    """The same on a stored table: only the buckets of the new prices are read and written."""
    old, new = _prices(spark, d)
    t = StoredTable(spark, f"{work_folder(spark)}/prices-{uuid.uuid4().hex}", ["p_partkey"], 16).create(old)
    t.upsert(new, ["p_partkey"])
    return t.read()


def path_prefix_join(spark, d):
    """Parts as files beside lists of exact files and of folders."""
    p = table(spark, d, "part")
    folder = F.concat_ws("/", F.lit("out"), "p_brand", F.replace("p_type", F.lit(" "), F.lit("/")))
    files = p.select("p_partkey", F.concat_ws("/", folder, F.col("p_partkey").cast("string")).alias("path"))
    lists = p.filter("p_size <= 3").select(F.col("p_partkey").alias("list_key"), F.concat_ws("/", folder, F.col("p_partkey").cast("string")).alias("exact"), F.when(F.col("p_size") == 1, F.concat_ws("/", F.lit("out"), "p_brand")).when(F.col("p_size") == 2, folder).alias("folder"))
    return R.path_join(files, lists, "path", "exact", "folder", ["p_partkey", "list_key"])


PATHS_SQL = """WITH f AS (SELECT p_partkey, p_size, concat_ws('/', 'out', p_brand, replace(p_type, ' ', '/')) AS folder, concat_ws('/', 'out', p_brand) AS top FROM part),
  l AS (SELECT p_partkey AS list_key, folder || '/' || p_partkey AS exact, CASE p_size WHEN 1 THEN top WHEN 2 THEN folder END AS folder FROM f WHERE p_size <= 3)
  SELECT DISTINCT p_partkey, list_key FROM (SELECT p_partkey, folder || '/' || p_partkey AS path FROM f) a JOIN l ON a.path = l.exact OR starts_with(a.path, l.folder || '/')"""


def insert_ignore(spark, d):
    return R.insert_ignore(*_prices(spark, d), ["p_partkey"])


def scoped_replace(spark, d):
    old, new = _prices(spark, d)
    return R.replace_scope(old, new.filter("size < 10"), new.filter("size < 5"), ["p_partkey"])


def mirror_delete(spark, d):
    old, new = _prices(spark, d)
    return R.mirror_delete(old, new.withColumn("brand", F.lit("Brand#11")), "brand", ["p_partkey"])


def full_outer_diff(spark, d):
    return R.full_outer_diff(*_prices(spark, d), ["p_partkey"], ["size"]).groupBy("change").agg(F.count(F.lit(1)).alias("n"))


def _whole(spark, d):
    """Every row of `part` in the old state or the new one, or both."""
    part = table(spark, d, "part")
    old = part.filter("p_partkey % 3 <> 0").select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
    return old, _changed(part.filter("p_partkey % 2 = 0 or p_partkey % 3 = 0"), F.col("p_partkey"))


def upsert_whole(spark, d):
    return R.upsert(*_whole(spark, d), ["p_partkey"])


def insert_ignore_whole(spark, d):
    return R.insert_ignore(*_whole(spark, d), ["p_partkey"])


def scoped_replace_whole(spark, d):
    old, new = _whole(spark, d)
    return R.replace_scope(old, new, new, ["p_partkey"])


def mirror_delete_whole(spark, d):
    old, new = _whole(spark, d)
    return R.mirror_delete(old, new.withColumn("brand", F.lit("Brand#11")), "brand", ["p_partkey"])


def full_outer_diff_whole(spark, d):
    return R.full_outer_diff(*_whole(spark, d), ["p_partkey"], ["size"]).groupBy("change").agg(F.count(F.lit(1)).alias("n"))


def union_counts(spark, d):
    out = None
    for t in ("customer", "nation", "orders", "part", "region", "supplier"):
        part = table(spark, d, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def bool_stringagg(spark, d):
    p = table(spark, d, "part")
    names = F.array_join(F.array_sort(F.collect_set(F.nullif(F.lower("p_brand"), F.lit("")))), " | ")
    return p.groupBy("p_size").agg(F.max("p_name").alias("name"), F.bool_or(F.lower("p_type").isin("small", "promo brushed tin", "economy")).alias("locked"), F.nullif(names, F.lit("")).alias("notes"))


def batch_classify(spark, d):
    """Orders by the states of their items: rows that are missing do not prevent `done`."""
    l = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_if(F.col("l_linestatus") == "F").alias("ok"), F.count_if(F.col("l_returnflag") == "R").alias("bad"), F.count(F.lit(1)).alias("n"))
    status = F.when(F.col("ok") + F.col("bad") == 0, "unknown").when(F.col("bad") == 0, "done").when(F.col("ok") == 0, "failed").otherwise("partial")
    return l.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("n_items"))


def status_top_groups(spark, d):
    """Ten largest groups, with their completion ratio."""
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("done"))
    return o.orderBy(F.desc("n"), F.asc("o_custkey")).limit(10).withColumn("ratio", F.round(F.col("done") / F.col("n"), 4))


def progress_status(spark, d):
    o = table(spark, d, "orders")
    done = F.col("o_orderstatus") == "F"
    g = o.groupBy("o_custkey").agg(F.bool_and(done).alias("every"), F.bool_or(done).alias("some"))
    return g.groupBy(F.when(F.col("every"), "done").when(F.col("some"), "partial").otherwise("not_started").alias("status")).agg(F.count(F.lit(1)).alias("n"))


def years_histogram(spark, d):
    """`year:n,...` of each customer segment."""
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    y = o.groupBy("c_mktsegment", F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    return y.groupBy("c_mktsegment").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y", "n"))), lambda x: F.concat_ws(":", x["y"].cast("string"), x["n"].cast("string"))), ",").alias("years"))


def chunk_tasks(spark, d):
    s = R.chunked(table(spark, d, "supplier").select("s_suppkey"), [F.asc("s_suppkey")], 30, "part")
    return s.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("s_suppkey").alias("first_key"), F.max("s_suppkey").alias("last_key"))


def last_wins_path(spark, d):
    l = table(spark, d, "lineitem").withColumn("seq", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    w = l.groupBy("l_partkey").agg(F.max_by(F.struct("l_orderkey", "l_suppkey"), F.struct("seq", "l_suppkey")).alias("x"))
    return w.select("l_partkey", "x.l_orderkey", "x.l_suppkey")


def numeric_sort_values(spark, d):
    """Values in natural numeric order with text as 9999, as (place, value)."""
    v = table(spark, d, "documents").select(F.regexp_replace("source", "^src", "").alias("v")).distinct()
    v = v.unionByName(spark.createDataFrame([("none",)], "v string"))
    key = F.when(F.col("v").rlike("^[0-9]+$"), F.col("v").try_cast("int")).otherwise(9999)
    return v.select(F.row_number().over(Window.orderBy(key, "v")).cast("long").alias("place"), "v")  # a facet's values: few


QUERIES = {
    "node_summary": (node_summary, """SELECT CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'locked' WHEN contains(c_mktsegment, 'HOUSE') THEN 'seed' ELSE 'future' END AS node, count(*) AS n_rows,
      count(DISTINCT c_nationkey) AS n_nations, count(DISTINCT (c_mktsegment, c_nationkey)) AS n_pairs, count(*) FILTER (c_acctbal > 0) AS n_positive, min(c_custkey) AS min_key, max(c_custkey) AS max_key FROM customer GROUP BY 1"""),
    "category_mode": (category_mode, """SELECT o_orderstatus, arg_max(o_orderpriority, (n, -first)) AS mode, sum(n)::BIGINT AS n_rows
      FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n, min(o_orderkey) AS first FROM orders GROUP BY ALL) GROUP BY 1"""),
    "track_top3": (track_top3, """SELECT p_brand, string_agg(p_type, ' | ' ORDER BY rn) AS top_types FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS rn
      FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL)) WHERE rn <= 3 GROUP BY 1"""),
    "subject_variants": (subject_variants, """SELECT (p_size * 100 + length(p_type))::BIGINT AS code, string_agg(DISTINCT p_brand, ' | ' ORDER BY p_brand) AS names, count(DISTINCT p_brand) AS n_names FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1"""),
    "pair_documents": (pair_documents, """SELECT CASE WHEN q IS NULL THEN 'no_question' WHEN c IS NOT NULL THEN 'paired_mod_primary' WHEN a IS NOT NULL THEN 'paired_ans_only' ELSE 'missing_answer' END AS pair_status, count(*) AS n, count(c) AS n_corrections
      FROM (SELECT l_orderkey, max(l_partkey) FILTER (l_returnflag = 'N') AS q, max(l_partkey) FILTER (l_returnflag = 'A') AS a, max(l_partkey) FILTER (l_returnflag = 'R') AS c FROM lineitem GROUP BY 1) GROUP BY 1"""),
    "manifest_summary": (manifest_summary, """SELECT l_returnflag, statuses, n_rows, n_twice FROM (SELECT l_returnflag, string_agg(l_linestatus || ':' || n, ';' ORDER BY l_linestatus) AS statuses, sum(n)::BIGINT AS n_rows
      FROM (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY 1) JOIN (SELECT l_returnflag, count(*) FILTER (n > 1) AS n_twice
      FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag, l_partkey, l_suppkey) GROUP BY 1) USING (l_returnflag)"""),
    "exam_ordinals": (exam_ordinals, """WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_suppkey % 5 = 0 THEN l_suppkey % 9 END AS e, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem)
      SELECT l_orderkey, l_linenumber, (rn + greatest(0, coalesce(max(e - rn) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING), 0)))::BIGINT AS ordinal FROM r"""),
    "collision_names": (collision_names, """SELECT p_partkey, dest || CASE WHEN row_number() OVER (PARTITION BY dest ORDER BY p_partkey) > 1 THEN '_E' || p_partkey ELSE '' END AS destination FROM (SELECT p_partkey, p_brand || '/' || p_size AS dest FROM part)"""),
    "dimension_join": (dimension_join, """SELECT r_name, n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"""),
    "self_join_roles": (self_join_roles, """SELECT o_orderkey, min(l_partkey) FILTER (l_linenumber = 1) AS first, min(l_partkey) FILTER (l_linenumber = 4) AS fourth, min(l_partkey) FILTER (l_linenumber = 7) AS seventh
      FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1"""),
    "or_join_union": (or_join_union, "SELECT DISTINCT s_suppkey, n_nationkey FROM supplier JOIN nation ON s_nationkey = n_nationkey OR s_suppkey % 25 = n_nationkey"),
    "anti_unfinished": (anti_unfinished, "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_linenumber = 1) AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity < 3)"),
    "semi_either_path": (semi_either_path, "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 7) OR l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 3)"),
    "upsert_state": (upsert_state, f"WITH {OLD_NEW} SELECT coalesce(o.p_partkey, n.p_partkey) AS p_partkey, CASE WHEN n.p_partkey IS NOT NULL THEN n.brand ELSE o.brand END AS brand, CASE WHEN n.p_partkey IS NOT NULL THEN n.size ELSE o.size END AS size FROM old o FULL JOIN new n ON o.p_partkey = n.p_partkey"),
    "path_prefix_join": (path_prefix_join, PATHS_SQL),
    "insert_ignore": (insert_ignore, f"WITH {OLD_NEW} SELECT * FROM old UNION ALL SELECT * FROM new WHERE p_partkey NOT IN (SELECT p_partkey FROM old)"),
    "scoped_replace": (scoped_replace, f"WITH {OLD_NEW} SELECT * FROM old WHERE p_partkey NOT IN (SELECT p_partkey FROM new WHERE size < 10) UNION ALL SELECT * FROM new WHERE size < 5"),
    "mirror_delete": (mirror_delete, f"WITH {OLD_NEW} SELECT brand, p_partkey, size FROM old WHERE NOT (brand = 'Brand#11' AND p_partkey NOT IN (SELECT p_partkey FROM new))"),
    "full_outer_diff": (full_outer_diff, f"WITH {OLD_NEW} SELECT CASE WHEN n.p_partkey IS NULL THEN 'remove' WHEN o.p_partkey IS NULL THEN 'add' WHEN o.size = n.size THEN 'keep' ELSE 'replace' END AS change, count(*) AS n FROM old o FULL JOIN new n ON o.p_partkey = n.p_partkey GROUP BY 1"),
    "union_counts": (union_counts, " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in ("customer", "nation", "orders", "part", "region", "supplier"))),
    "bool_stringagg": (bool_stringagg, "SELECT p_size, max(p_name) AS name, bool_or(lower(p_type) IN ('small', 'promo brushed tin', 'economy')) AS locked, string_agg(DISTINCT lower(p_brand), ' | ' ORDER BY lower(p_brand)) AS notes FROM part GROUP BY 1"),
    "batch_classify": (batch_classify, """SELECT CASE WHEN ok + bad = 0 THEN 'unknown' WHEN bad = 0 THEN 'done' WHEN ok = 0 THEN 'failed' ELSE 'partial' END AS status, count(*) AS n, sum(n)::BIGINT AS n_items
      FROM (SELECT l_orderkey, count(*) FILTER (l_linestatus = 'F') AS ok, count(*) FILTER (l_returnflag = 'R') AS bad, count(*) AS n FROM lineitem GROUP BY 1) GROUP BY 1"""),
    "status_top_groups": (status_top_groups, "SELECT *, round(done / n, 4) AS ratio FROM (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS done FROM orders GROUP BY 1) ORDER BY n DESC, o_custkey LIMIT 10"),
    "progress_status": (progress_status, "SELECT CASE WHEN e THEN 'done' WHEN s THEN 'partial' ELSE 'not_started' END AS status, count(*) AS n FROM (SELECT bool_and(o_orderstatus = 'F') AS e, bool_or(o_orderstatus = 'F') AS s FROM orders GROUP BY o_custkey) GROUP BY 1"),
    "years_histogram": (years_histogram, "SELECT c_mktsegment, string_agg(y || ':' || n, ',' ORDER BY y) AS years FROM (SELECT c_mktsegment, year(o_orderdate) AS y, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) GROUP BY 1"),
    "chunk_tasks": (chunk_tasks, "SELECT (row_number() OVER (ORDER BY s_suppkey) - 1) // 30 + 1 AS part, s_suppkey FROM supplier"),
    "last_wins_path": (last_wins_path, "SELECT l_partkey, arg_max(l_orderkey, (l_orderkey * 10 + l_linenumber, l_suppkey)) AS l_orderkey, arg_max(l_suppkey, (l_orderkey * 10 + l_linenumber, l_suppkey)) AS l_suppkey FROM lineitem GROUP BY 1"),
    "numeric_sort_values": (numeric_sort_values, """SELECT row_number() OVER (ORDER BY CASE WHEN regexp_full_match(v, '[0-9]+') THEN v::INTEGER ELSE 9999 END, v) AS place, v FROM (SELECT DISTINCT regexp_replace(source, '^src', '') AS v FROM documents UNION ALL SELECT 'none')"""),
}
QUERIES["chunk_tasks"] = (chunk_tasks, f"SELECT part, count(*) AS n, min(s_suppkey) AS first_key, max(s_suppkey) AS last_key FROM ({QUERIES['chunk_tasks'][1]}) GROUP BY 1")

QUERIES |= {
    f"{name}_whole": (query, QUERIES[of][1].replace(OLD_NEW, WHOLE_SQL))
    for name, of, query in (("upsert", "upsert_state", upsert_whole), ("insert_ignore", "insert_ignore", insert_ignore_whole), ("mirror_delete", "mirror_delete", mirror_delete_whole), ("full_outer_diff", "full_outer_diff", full_outer_diff_whole))
}
QUERIES["upsert_stored"] = (upsert_stored, QUERIES["upsert_state"][1])
QUERIES["scoped_replace_whole"] = (scoped_replace_whole, f"WITH {WHOLE_SQL} SELECT * FROM old WHERE p_partkey NOT IN (SELECT p_partkey FROM new) UNION ALL SELECT * FROM new")
