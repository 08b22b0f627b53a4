"""Markdown to candidates in one plan, and the run of options against its definition."""

import random
import time

from pyspark.sql import functions as F
from test_questions import BODIES, model

from sluice.functions import questions as Q
from sluice.operators import bank as B
from sluice.operators.parse import parsed_candidates, question_blocks


def by_definition(labels, kinds):
    best, score = [], (-1, -1, -1)
    for start in range(len(labels)):
        taken = []
        for i in range(start, len(labels)):
            if kinds[i] == Q.ORGANISM:
                continue
            if labels[i] in {labels[j] for j in taken}:
                if kinds[i] == Q.WITHIN:
                    continue
                break
            taken.append(i)
        letters = [labels[i] for i in taken]
        now = (all(x in letters for x in "ABCD"), letters[:1] == ["A"], len(taken))
        if now > score:
            best, score = taken, now
    return best


def test_run_of():
    rng = random.Random(9)
    for _ in range(4000):
        n = rng.randint(0, 12)
        labels, kinds = "".join(rng.choice("ABCDE") for _ in range(n)), "".join(rng.choice("owppp") for _ in range(n))
        assert Q.run_of(labels, kinds) == by_definition(labels, kinds), (labels, kinds)


def test_many_marks_cost_their_number(spark):
    began = time.time()
    assert len(Q.run_of("A" * 100_000, "w" * 100_000)) == 1 and Q.run_of("ABCDE" * 20_000, "p" * 100_000) == [0, 1, 2, 3, 4]
    assert time.time() - began < 5
    body = "stem " + "A、 x " * 100_000 + "\nA. a B. b C. c D. d"
    got = Q.with_question(spark.createDataFrame([(1, body)], "n int, body string"), "n", "body").select(F.transform("options", lambda o: o["key"]).alias("k"), F.length("stem").alias("l")).first()
    assert got.k == list("ABCD")


def test_with_question_is_question(spark):
    rng = random.Random(8)
    words = ["(A) a", "B. b", "C、c", "D. d", "E. coli", "E. e", "A-type", "\nA. x", "\nB. y", "text", "\n(C) z", "(D) w", "\n"]
    bodies = BODIES + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 14))) for _ in range(120)]
    rows = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    for r in Q.with_question(rows.withColumn("q", Q.question(F.lit(4), F.col("body"))).withColumn("n", F.lit(4)), "n", "body").collect():
        assert (r.stem, r.options, r.group_ref, r.question_type) == (r.q.stem, r.q.options, r.q.group_ref, r.q.question_type), bodies[r.i]
        if (want := model(bodies[r.i])) is not None:
            assert (r.stem, [tuple(o) for o in r.options]) == want


PAPER = """類科名稱：x 科目名稱：y 考試時間：1
1. 第1至2題為題組，下列何者正確？
(A) $\\alpha$ Fy a
(B) two
(C) three
(D) four
2、如圖所示，這是什麼？
![](img/a.png)
A. one B. two C. three
4. 下列圖形何者正確？
A. ![](img/a.png)
B. ![](img/b.png)
C. ![](img/none.png)
D. ![](img/empty.png)
4. short?
A. a
B. b
C. c
D. d
which is next？
A. e
B. f
C. g
D. h
"""
ANSWERS = "第 4 題答 A或B 者均給分 <table><tr><td>題號</td><td>1</td><td>2</td><td>4</td></tr><tr><td>答案</td><td>A</td><td>x</td><td>#</td></tr></table>"


def test_paper(spark):
    docs = spark.createDataFrame([("s1", PAPER, ANSWERS, "110", "c"), ("s2", None, ANSWERS, "110", "c"), ("s3", "no questions", ANSWERS, None, "c"), ("s4", PAPER, None, "110", "c")], "src string, md string, ans string, year string, stem string")
    assets = spark.createDataFrame([("img/a.png", 10), ("img/a.png", 3), ("img/b.png", 7), ("img/empty.png", 0)], "path string, bytes long")
    rows = {r.candidate_key: r for r in parsed_candidates(docs, "src", "md", "ans", F.col("year"), assets).collect()}
    assert sorted(rows) == ["s1:q001", "s1:q002", "s1:q004", "s1:q004:dup02", "s1:q005"]
    codes = {k: sorted(i.issue_code for i in r.issues) for k, r in rows.items()}
    one, two, four = rows["s1:q001"], rows["s1:q002"], rows["s1:q004"]
    assert [(o.key, o.text) for o in one.options] == [("A", "α Fyᵃ"), ("B", "two"), ("C", "three"), ("D", "four")]
    assert one.group_ref == "q001-q002" and one.answer == "A" and one.quality_status == "needs_review" and codes["s1:q001"] == ["question_number_gap"]
    assert two.stem == "如圖所示，這是什麼？" and [r.path for r in two.image_refs] == ["img/a.png"] and two.image_refs[0].bytes == 10
    assert codes["s1:q002"] == ["too_few_options", "unexpected_answer_value"] and two.quality_status == "blocked"
    assert [o.image for o in four.options] == ["img/a.png", "img/b.png", "img/none.png", "img/empty.png"] and four.answer == "A|B" and four.special
    assert codes["s1:q004"] == ["duplicate_question_number", "empty_image_asset", "missing_image_asset"]
    assert codes["s1:q004:dup02"] == ["duplicate_question_number", "short_stem"] and codes["s1:q005"] == ["missing_answer"]
    failed = {(r.src, r.issue_code) for r in B.document_failures(docs, question_blocks(docs, "src", "md", F.col("year")), "src", "md", "ans").collect()}
    assert failed == {("s2", "missing_question_markdown"), ("s3", "no_questions_parsed"), ("s4", "missing_answer_markdown")}
    assert parsed_candidates(docs.limit(0), "src", "md", "ans", F.col("year")).collect() == []


def test_numbers_that_come_again_need_no_stored_copy(spark):
    """Repeated and lacking numbers are told from one plan: nothing is written on the way."""
    docs = spark.createDataFrame([(1, "1. a?\n(A) x\n(B) y\n2. b?\n2. c?\n4. d?", ""), (2, "3. e?\n4. f?", "")], "k int, m string, a string")
    found = parsed_candidates(docs, "k", "m", "a", F.lit("110"))
    assert "Relation" not in found._jdf.queryExecution().optimizedPlan().toString().replace("LocalRelation", "").replace("LogicalRDD", "")
    codes = {r.candidate_key: {x.issue_code for x in r.issues} & {"duplicate_question_number", "question_number_gap"} for r in found.collect()}
    again = {"duplicate_question_number"}
    assert codes == {"1:q001": {"question_number_gap"}, "1:q002": again, "1:q002:dup02": again, "1:q004": set(), "2:q003": set(), "2:q004": set()}
