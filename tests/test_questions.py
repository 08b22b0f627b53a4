"""Blocks taken apart, against a plain Python model of the run rule."""

import random
import re

from pyspark.sql import functions as F

from sluice.functions import questions as Q

MARK = re.compile(Q.MARK)


def model(body):
    marks = list(MARK.finditer(body))
    letter = lambda m: m[1] or m[2] or m[3]
    best, score = [], (-1, -1, -1)
    for s in range(len(marks)):
        seen, run = [], []
        for m in marks[s:]:
            if letter(m) == "E" and re.match(r"\s*coli\b", body[m.end() :], re.I):
                continue
            if letter(m) in seen:
                if re.fullmatch(r"[A-E](-|、)", m[0].strip()):
                    continue
                break
            seen.append(letter(m))
            run.append(m)
        now = (all(x in seen for x in "ABCD"), seen[:1] == ["A"], len(run))
        if now > score:
            best, score = run, now
    if len(best) < 2:
        return None
    ends = [m.start() for m in best[1:]] + [len(body)]
    return body[: best[0].start()].strip(), sorted((letter(m), i + 1, body[m.end() : e].strip()) for i, (m, e) in enumerate(zip(best, ends)))


BODIES = [
    "stem text\n(A) one (B) two (C) three (D) four", "E. coli grows where?\nA. x\nB. y\nC. E. coli\nD. z", "stem A、 in list\nA. a B. b C. c D. d", "which\nA. a A-type cells\nB. b\nC. c\nD. d\nA. again",
    "B. second A. first D. fourth C. third", "$ \\mathrm{A}. x$\nB. y\nC. z\nD. w", "no options at all", "第3至5題為題組 下列何者\n(A)a\n(B)b\n(C)c\n(D)d",
]


def test_runs(spark):
    rng = random.Random(6)
    words = ["(A) a", "B. b", "C、c", "D. d", "E. coli", "E. e", "A-type", "\nA. x", "\nB. y", "text", "\n(C) z", "(D) w", "\n"]
    bodies = BODIES + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 14))) for _ in range(150)]
    rows = spark.createDataFrame(list(enumerate(bodies)), "i int, body string").select("i", Q.question(F.lit(4), F.col("body")).alias("q")).collect()
    checked = 0
    for r in rows:
        if (want := model(bodies[r.i])) is not None:
            checked += 1
            assert (r.q.stem, [tuple(o) for o in r.q.options]) == want, bodies[r.i]
    assert checked > 80
    by = {r.i: r.q for r in rows}
    assert by[6].question_type == "unknown" and by[6].options == [] and by[6].stem == "no options at all"
    assert by[7].group_ref == "q003-q005" and [o.text for o in by[7].options] == list("abcd")
    assert [o.key for o in by[1].options] == list("ABCD") and by[1].stem == "E. coli grows where?"


def test_a_made_body_is_made_once(spark, tmp_path):
    """question_parse makes each block once, however often its text is looked at."""
    from sluice import registry

    spark.createDataFrame([(1, 1, 5), (1, 2, 6), (1, 2, 4), (2, 9, 1)], "l_orderkey bigint, l_linenumber int, l_partkey bigint").write.parquet(str(tmp_path / "lineitem.parquet"))
    found = registry.queries()["question_parse"](spark, str(tmp_path))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("第1至9題") == 1
    assert [tuple(r) for r in found.collect()] == [(1, "第1至9題 order 1", 2, "A=part 5 E. coli;B=part 4 E. coli", "q001-q009")]
