"""Small operators and functions on a few rows each."""

from datetime import datetime

from pyspark.sql import functions as F

from sluice.functions import names as N
from sluice.functions import text as T
from sluice.operators import relational as R
from sluice.operators import review as V
from sluice.operators import rules as G
from sluice.sources import readers, sinks
from sluice.streaming import latest as S

OPTIONS = "array<struct<key:string,text:string>>"


def test_text_functions(spark):
    row = spark.createDataFrame([('a/b:c   "d"', "第 12 題", datetime(2024, 1, 2, 3, 4, 5, 999000))], "f string, q string, t timestamp").select(
        T.safe_file_name(F.col("f")).alias("f"), T.question_number(F.col("q")).alias("q"), T.iso_seconds(F.col("t")).alias("t"), T.status_family(F.lit("error:x:y")).alias("s"), T.table_rows(F.lit("<table><tr><td>a <b>b</b></td></tr></table>")).alias("r")
    ).first()
    assert tuple(row) == ("a_b_c _d_", 12, "2024-01-02T03:04:05", "error", [["a b"]])


def test_names(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(N.exam_label(F.lit("<b>110年 考試</b> 本考試所有測 驗題標準答案 x"))) == "110年 考試"
    assert tuple(one(N.level_and_name(F.lit("高考_醫事_x")))) == ("高考", "醫事_x") and tuple(one(N.level_and_name(F.lit("plain")))) == ("", "plain")
    assert one(N.has_collision_suffix(F.lit("a/b_E12345_ANS.pdf"))) and not one(N.has_collision_suffix(F.lit("a_E12345.pdf/b.pdf")))
    assert [one(N.is_safe_path(F.lit(p))) for p in ("a/b", "/a", "a/../b", "..", "", "a..b")] == [True, False, False, False, False, True]
    assert one(N.relative_to(F.lit("/root/x/y"), "/root")) == "x/y" and one(N.relative_to(F.lit("/rooted/x"), "/root")) == "/rooted/x"
    assert one(N.markup_payload(F.lit("H2O")))["needs_review"] is False and one(N.markup_payload(F.lit("x^2")))["needs_review"] is True and one(N.markup_payload(F.lit("plain"))) is None


def test_first_and_last(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 3, "c"), (2, 9, "z")], "k int, seq int, v string")
    assert sorted((r.k, r.v) for r in R.first_wins(df, ["k"], "seq").collect()) == [(1, "a"), (2, "z")]
    assert sorted((r.k, r.v) for r in R.last_wins(df, ["k"], "seq").collect()) == [(1, "c"), (2, "z")]


def test_review_rules(spark):
    df = spark.createDataFrame([("A|B", None, None, [("A", "x"), ("B", "y")], [("b", "new"), ("c", "z"), ("", "no")], [("p", None, 3), ("q", False, 3), ("", True, 1), ("r", True, 0)])],
        f"parsed string, reviewed string, corrected string, options {OPTIONS}, corrections {OPTIONS}, refs array<struct<path:string,exists:boolean,bytes:bigint>>")
    r = df.select(
        V.resolved_answer(F.col("corrected"), F.col("reviewed"), F.col("parsed")).alias("answer"), V.answer_hint(F.col("parsed"), F.lit("A"), F.lit(False)).alias("hint"), V.merged_options(F.col("options"), F.col("corrections")).alias("options"),
        V.usable_assets(F.col("refs")).alias("refs"), V.asset_kind(F.lit("Question PDF"), F.lit(None)).alias("kind"), G.apply_correction({"a": F.lit("old"), "b": F.array(F.lit(1))}, {"a": F.lit("new"), "b": F.array(F.lit(2))}, ["b"])["b"].alias("both"),
    ).first()
    assert r.answer == "A" and r.hint.severity == "warning" and r.hint.flags == ["several", "differs_from_review"]
    assert [tuple(o) for o in r.options] == [("A", "x"), ("B", "new"), ("C", "z")] and [x.path for x in r.refs] == ["p"] and r.kind == "pdf" and r.both == [1, 2]


def test_resets(spark):
    latest = spark.createDataFrame([(1, "accept", "n"), (2, "block", None)], "k int, action string, notes string")
    got = V.reset_events(latest, spark.createDataFrame([(2,), (2,), (3,)], "k int"), "k", "again").collect()
    assert [tuple(r) for r in got] == [(2, "reset_review", "block", None, "again")]


def test_statuses_by_rules(spark):
    df = spark.createDataFrame([(1, 5), (2, 50), (3, 500)], "k int, n int")
    rules = [("small", "info", F.col("n") < 10), ("middle", "warning", F.col("n") >= 50), ("large", "blocked", F.col("n") > 100)]
    got = G.status_by_rules(df, ["k"], rules)
    assert sorted(map(tuple, got.collect())) == [(1, 1, "pass"), (2, 1, "needs_review"), (3, 2, "blocked")]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.md").write_bytes(b"one \xff two")
    (tmp_path / "a" / "x.txt").write_text("t")
    found = readers.files(spark, str(tmp_path), "*.md").collect()
    assert [r.path.rsplit("/", 1)[1] for r in found] == ["x.md"] and found[0].length == 9
    assert readers.markdown_documents(spark, str(tmp_path)).first().text.startswith("one ")
    stems = spark.createDataFrame([("d/x.a.pdf", 1), ("e/x.a.md", 2), ("y.pdf", 3)], "path string, seq int")
    assert sorted((r.stem, r.path) for r in readers.index_by_stem(stems, "path", "seq").collect()) == [("x.a", "e/x.a.md"), ("y", "y.pdf")]


def test_json_lines_keep_nulls_and_order(spark, tmp_path):
    df = spark.createDataFrame([("é", None, ("q", None))], "b string, a string, n struct<z:string,c:string>")
    sinks.write_jsonl(df, f"{tmp_path}/out")
    assert [r.value for r in spark.read.text(f"{tmp_path}/out").collect()] == ['{"a":null,"b":"é","n":{"c":null,"z":"q"}}']


def test_deliveries_and_counts(spark):
    events = S.event_stream(spark, "/root/testdata/sf0.001")
    assert S.replayed(spark, S.first_deliveries(events).select("event_id"), "append").count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()


def test_group_names(spark):
    from sluice.functions import names

    rows = spark.createDataFrame([("牙醫師（一）",), (" 藥師 (二)",), ("護理師",), (None,)], "c string").select(names.group_name(F.col("c")).alias("g")).collect()
    assert [r.g for r in rows] == ["牙醫師", "藥師", "護理師", ""]
