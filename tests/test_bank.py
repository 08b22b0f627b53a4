"""Rules of the question bank on small cases, and operators against plain Python."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluice.operators import bank as B
from sluice.operators import logs
from sluice.operators import relational as R
from sluice.sources import readers


def test_corrected_actions_replay(spark):
    rng = random.Random(1)
    actions = ["accept", "block", "comment", "reset_review", "odd"]
    rows = [(k, i, rng.choice(actions), rng.random() < 0.4) for k in range(12) for i in range(rng.randint(1, 12))]
    want, state = {}, {}
    for k, i, action, corrects in rows:
        if corrects:
            action = state.get(k) if state.get(k) in logs.KEPT_ACTIONS else "reviewed"
        want[k, i] = action
        state[k] = None if action == "reset_review" else action
    e = spark.createDataFrame(rows, "k int, i int, action string, corrects boolean")
    got = logs.corrected_actions(e, "k", ["i"], "action", F.col("corrects"), "reset_review")
    assert {(r.k, r.i): r.action for r in got.collect()} == want


def test_gaps_and_sheets_take_stray_numbers(spark):
    rows = [(1, 5, "a", 0), (1, 5, "b", 1), (1, 2_000_000_000, "c", 2), (2, 3, "d", 3), (2, 4, "e", 4), (3, None, "f", 5)]
    df = spark.createDataFrame(rows, "k int, n long, v string, seq int")
    assert [(r.k, r.missing) for r in R.gaps(df, "k", "n").collect()] == [(1, list(range(6, 56)))]
    sheet = R.filled_sheet(df.filter("n < 1000"), "k", "n", ["seq"], ["v"], first=1)
    got = sorted((r.k, r.n, r.v, r.placeholder) for r in sheet.collect())
    assert got == [(1, i, None, True) for i in range(1, 5)] + [(1, 5, "b", False), (2, 1, None, True), (2, 2, None, True), (2, 3, "d", False), (2, 4, "e", False)]
    long = R.filled_sheet(spark.createDataFrame([(1, 9000, "x", 0)], "k int, n long, v string, seq int"), "k", "n", ["seq"], ["v"])
    assert long.count() == 9001 and long.filter("placeholder").agg(F.max("n")).first()[0] == 8999


def test_repeated_keys(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "x", 1), (3, "z", 3), (3, "y", 2)], "k int, v string, seq int")
    kept = R.insert_ignore(old, new, ["k"], [F.asc("seq")]).select("k", "v")
    assert sorted(map(tuple, kept.collect())) == [(1, "a"), (2, "b"), (3, "y")]
    with pytest.raises(PySparkException, match="repeated key"):
        R.upsert(old, new.drop("seq"), ["k"]).collect()
    assert sorted(map(tuple, R.upsert(old, new.filter("seq < 3").drop("seq"), ["k"]).collect())) == [(1, "a"), (2, "x"), (3, "y")]


def test_numbered_spreads_over_partitions(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("x"), (F.col("id") % 3).alias("y"))
    got = R.numbered(df, [F.desc("x")], "n")
    assert [(r.x, r.n) for r in got.orderBy("n").collect()] == [(999 - i, i + 1) for i in range(1000)]


def test_csv_header_and_last_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\ufeffid,v\n1,a\n1,b\n2,c\n1,d\n", encoding="utf-8")
    schema = "id int, v string"
    with pytest.raises(ValueError, match="zz"):
        readers.read_csv(spark, str(tmp_path), ["id", "zz"], spark.createDataFrame([], schema).schema)
    df = readers.read_csv(spark, str(tmp_path), ["id", "v"], spark.createDataFrame([], schema).schema)
    assert {r.id: r.v for r in readers.last_row_by_path(df, "id").collect()} == {1: "d", 2: "c"}
    listing = spark.createDataFrame([("file:/x/a+b/c.pdf",), ("/y/c.pdf",)], "path string")
    assert sorted(r.relative for r in readers.relative_paths(listing, "/x/a+b").collect()) == ["/y/c.pdf", "c.pdf"]


def test_answer_tables(spark):
    page = (
        "<table><tr><td>題序</td><td>第1題</td><td></td><td>第2題</td><td>3</td></tr><tr><td>答案</td><td>A</td><td>#</td><td> </td></tr></table>"
        "<TABLE border=1><tr><td>題號</td><td>2</td></tr><tr><td>答案</td><td><b>D</b></td></tr></TABLE><table><tr><td>題號</td><td>9</td></tr></table> 第2題答A或B者均給分"
    )
    got = B.answer_rows(spark.createDataFrame([(1, page), (2, "none"), (3, None)], "d int, page string"), ["d"], "page")
    assert sorted((r.d, r.number, r.answer, r.raw_answer, r.special) for r in got.collect()) == [(1, 1, "A", "A", False), (1, 2, "D", "D", False)]
    one = B.answer_rows(spark.createDataFrame([(1, page.split("<TABLE")[0] + page[-15:])], "d int, page string"), ["d"], "page")
    assert sorted((r.number, r.answer, r.accepted, r.special) for r in one.collect()) == [(1, "A", ["A"], False), (2, "A|B", ["A", "B"], True)]


def test_issue_codes(spark):
    option = lambda k, t, i, image=None: (k, t, image, i)
    rows = [
        (1, "", [], None, None), (2, "short", [option(k, "x", i) for i, k in enumerate("BACD")], "A", []), (3, "這個問題見附圖 \\alpha □", [option(k, "", i) for i, k in enumerate("AABCD")], "x1", None),
        (4, "題目問 縮胺酸（Valine）的代謝如何", [option(k, "y", i) for i, k in enumerate("ABCD")], "A#", [("p", False, None), ("q", True, 0), ("r", True, 5)]),
    ]
    df = spark.createDataFrame(rows, f"id int, stem string, options array<{B.OPTION}>, answer string, image_refs array<{B.REF}>")
    got = {}
    for r in B.candidate_issues(df, ["id"]).collect():
        got.setdefault(r.id, []).append(r.issue_code)
    assert sorted(got[1]) == ["empty_stem", "missing_answer", "too_few_options"]
    assert sorted(got[2]) == ["option_order_unusual", "short_stem"]
    assert sorted(got[3]) == ["duplicate_option_label", *["empty_option"] * 5, "image_hint_without_asset", "markup_needs_review", "option_order_unusual", "suspicious_ocr_chars", "unexpected_answer_value"]
    assert sorted(got[4]) == ["amino_acid_translation_suspect", "empty_image_asset", "missing_image_asset"]


def test_formal_gate(spark):
    schema = "id int, quality_status string, question_action string, question_reset boolean, answer_action string, answer_reset boolean, open_codes array<string>, settled_codes array<string>, group_hint boolean, group_ref string, visual_hint boolean, has_asset boolean, markup_hint boolean, has_markup boolean"
    rows = [
        (1, "pass", "accept", False, "accept", False, [], [], False, None, False, False, False, False),
        (2, "blocked", "unblock", False, "accept", False, [], ["too_few_options"], True, "", True, False, True, False),
        (3, None, None, True, "block", False, ["b", "a", "a"], ["c"], True, None, True, False, False, False),
        (4, "pass", "exclude", False, None, True, [], [], True, "q1", True, True, False, False),
    ]
    got = {r.id: (r.status, r.reasons, r.warnings) for r in B.formal_gate(spark.createDataFrame(rows, schema)).collect()}
    assert got[1] == ("ready", "", "")
    assert got[2][:2] == ("ready", "") and got[2][2].split(";") == [
        "candidate_quality_resolved_by_human_review=blocked", "blocking_parse_issues_resolved_by_human_correction=too_few_options", "group_hint_without_group_ref_confirmed_by_human_review",
        "visual_hint_without_asset_confirmed_by_human_review", "markup_or_table_fragment_without_markup_json",
    ]
    assert got[3][1].split(";") == ["candidate_quality_status=missing", "question_review_reset_pending", "answer_review_not_ready=block", "blocking_parse_issues=a,b,c", "group_hint_without_group_ref", "visual_hint_without_asset"]
    assert got[4][1].split(";") == ["question_review_not_ready=exclude", "answer_review_reset_pending"]


def test_corrections_by_presence(spark):
    rows = [(1, '{"answer":null,"image_refs":["b"]}'), (2, '{"stem":"new"}'), (3, None), (4, "not json")]
    df = spark.createDataFrame(rows, "id int, c string").withColumns({"stem": F.lit("old"), "answer": F.lit("A"), "image_refs": F.array(F.lit("a"))})
    got = {r.id: (r.stem, r.answer, r.image_refs) for r in B.corrected(df, "c").collect()}
    assert got == {1: ("old", None, ["a", "b"]), 2: ("new", "A", ["a"]), 3: ("old", "A", ["a"]), 4: ("old", "A", ["a"])}


def test_answers_of_one_page():
    """The last pair of a number and the last note of it count, found in one look at the page."""
    table = lambda numbers, answers: "<table><tr><td>題號</td>" + "".join(f"<td>{n}</td>" for n in numbers) + "</tr>\n<TR a=1><td>答案</td>" + "".join(f"<td>{a}</td>" for a in answers) + "</tr></table>"
    page = table(["第1題", "x", "2", "3"], ["A", "B", "#", "<b>\tC </b>"]) + table([2, 1], ["#"]) + "第2題答A均給分，第2題答B、C均給分，第9題答D"
    assert sorted(B.page_answers(page)) == [(0, 1, "A", None), (2, 3, "C", None), (3, 2, "#", ["B", "C"])]
    assert B.page_answers("第1題答A") == [] and B.page_answers(table([], [])) == []
