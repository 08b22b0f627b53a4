from pyspark.sql import functions as F

from sluice.functions import markup
from sluice.functions import text as T


def one(spark, f, *values):
    row = spark.createDataFrame([values], ", ".join(f"c{i} {'int' if isinstance(v, int) else 'string'}" for i, v in enumerate(values)))
    return row.select(f(*(F.col(c) for c in row.columns)).alias("x")).first().x


def test_answers(spark):
    assert one(spark, T.accepted_answers, "A| C ") == ["A", "C"]
    assert one(spark, T.accepted_answers, "A+C") == ["A+C"]
    assert one(spark, T.accepted_answers, "  ") == []
    assert one(spark, T.answer_letters, "b, a B e") == ["B", "A"]


def test_group_ranges(spark):
    assert one(spark, T.group_ref, "第61至63題為題組", 62) == "q061-q063"
    assert one(spark, T.group_ref, "第61至63題為題組", 64) is None


def test_blocks_and_options(spark):
    blocks = one(spark, T.question_blocks, "head\n1. first\nline\n1.7 3.4 no start\n2、second")
    assert [(b.number, b.body) for b in blocks] == [(1, "first\nline\n1.7 3.4 no start"), (2, "second")]
    options = one(spark, T.option_texts, "stem (B) two (A) one\nC. three D. four")
    assert [(o.key, o.text) for o in options] == [("A", "one"), ("B", "two"), ("C", "three"), ("D", "four")]


def test_notes_and_prefix(spark):
    notes = one(spark, T.correction_notes, "第2題答A或B者均給分。第10題答 C 給分")
    assert [(n.number, n.accepted) for n in notes] == [(2, ["A", "B"]), (10, ["C"])]
    assert one(spark, T.common_prefix, "abcd", "abxd") == 2
    assert one(spark, T.common_prefix, "", "a") == 0
    assert one(spark, T.status_family, "error:IO:x") == "error"


def test_tables_images_names(spark):
    assert one(spark, T.table_rows, "<table><tr><th>a</th><td> b <i>c</i></td></tr><tr><td>d</td></tr></table>") == [["a", "b c"], ["d"]]
    assert one(spark, T.image_refs, "x ![a](i/1.png) <IMG class=q src='2.jpg'>") == ["i/1.png", "2.jpg"]
    assert one(spark, T.normal_name, " a　b ") == "ab"
    assert one(spark, T.unescape_basic, "&lt;a&gt; &amp;lt;") == "<a> &lt;"


def test_science(spark):
    assert one(spark, markup.science, r"$\alpha$ and \beta at 37 ^{\circ} C") == "α and β at 37℃"
    assert one(spark, markup.science, r"Ca^{2+} H_2O x^{10} a_{12} \mathrm{mg} 5 \leq 6") == "Ca²⁺ H₂O x¹⁰ a₁₂ mg 5 ≤ 6"
