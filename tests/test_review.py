from pyspark.sql import functions as F

from sluice.operators import review as V


def test_answers_and_verdicts(spark):
    rows = spark.createDataFrame([("A|B", " ", "C"), (None, "b", "C"), (None, None, "#")], "c string, r string, p string")
    assert [r.x for r in rows.select(V.resolved_answer(F.col("c"), F.col("r"), F.col("p")).alias("x")).collect()] == ["A", "b", "#"]
    hint = rows.select(V.answer_hint(F.col("p"), F.col("r"), F.lit(False)).alias("h")).collect()
    assert [(r.h.severity, r.h.flags) for r in hint] == [("warning", ["differs_from_review"]), ("warning", ["differs_from_review"]), ("error", ["unresolved_mark"])]
    raw = spark.createDataFrame([("OK", "1.7", ["x", "bad"]), ("odd", None, None)], "status string, confidence string, labels array<string>")
    got = V.normal_verdict(raw, "status", "confidence", "labels", ["x"], "none").collect()
    assert [tuple(r) for r in got] == [("pass", 1.0, ["x"]), ("needs_review", None, ["none"])]


def test_options_assets_promotion(spark):
    df = spark.createDataFrame([("k", "s", None, "stem", [("A", "1"), ("B", "2")], "A|B", [("p", None, None), ("q", False, 3), ("", True, 3)])], "candidate_key string, source string, group_ref string, stem string, options array<struct<key:string,text:string>>, answer string, refs array<struct<path:string,exists:boolean,bytes:long>>")
    fixed = F.expr("array(named_struct('key', 'bx', 'text', 'two'), named_struct('key', '', 'text', 'none'))")
    assert [(o.key, o.text) for o in df.select(V.merged_options(F.col("options"), fixed).alias("x")).first().x] == [("A", "1"), ("B", "two")]
    out = {k: v.collect() for k, v in V.promoted(df).items()}
    assert [len(out[k]) for k in ("groups", "questions", "options", "answers", "assets")] == [0, 1, 2, 2, 1]


def test_patches_and_batches(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "k int, x string, y string")
    patches = spark.createDataFrame([(1, "x", "old", 1), (1, "x", None, 2), (2, "y", "D", 1)], "k int, field string, value string, seq int")
    assert sorted(map(tuple, V.patched(df, patches, "k", ["x", "y"]).collect())) == [(1, None, "b"), (2, "c", "D")]
    rows = spark.createDataFrame([(f"p{i % 7}", i, "g") for i in range(9)], "path string, seq int, grp string")
    one = spark.createDataFrame([("p0",)], "path string")
    got = V.planned_batches(rows, one, one.select(F.lit("p1").alias("path")), "path", [F.asc("seq")], 2, "grp").orderBy("seq").collect()
    assert [(r.path, r.batch) for r in got] == [("p2", 1), ("p3", 1), ("p4", 2), ("p5", 2), ("p6", 3)]


def test_reconcile(spark):
    stem = "a" * 24
    errors = spark.createDataFrame([("f", stem + "xyz"), ("f", "short-name"), ("f", "lonely"), ("g", stem + "xyz")], "folder string, name string")
    outputs = spark.createDataFrame([("f", stem + "xyq"), ("f", stem + "q"), ("f", "short"), ("g", stem + "1"), ("g", stem + "2")], "folder string, name string")
    got = {(r.folder, r.wanted): (r.status, r.found, r.score) for r in V.reconciled(errors, outputs).collect()}
    assert got[("f", stem + "xyz")] == ("matched", stem + "xyq", 26)
    assert got[("f", "short-name")] == ("matched", "short", 5)
    assert got[("f", "lonely")][0] == "unmatched"
    assert got[("g", stem + "xyz")] == ("ambiguous", None, 24)
