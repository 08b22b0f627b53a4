"""Notation: every step alone, steps in order without their tests of literals, and the audit's rules."""

import random

import pytest
from pyspark.sql import functions as F

from sluice import registry
from sluice.functions import notation as N
from sluice.operators.notation import audited_notation

SCIENCE = [
    (r"5 $\mu$ g", "5 μg"), (r"\mu m", "μm"), (r"$\beta$ _{2} x", "β2 x"), (r"\alpha 1", "α1"), (r"$\zeta$", "ζ"), (r"\varepsilon", "ε"), (r"\mathrm{Na}", "Na"), (r"\triangle\%", "△%"), (r"4^{\mathrm{th}}", "4ᵗʰ"), ("2^{nd}", "2ⁿᵈ"),
    (r"37 ^{\circ} \mathrm{C}", "37℃"), ("-5 ° C", "-5℃"), (r"^{\circ}C", "℃"), ("°C", "℃"), (r"90^{\circ}", "90°"), ("2 - 8℃", "2-8℃"), (r"a\rightarrow b\to c", "a→ b→ c"), (r"\uparrow\downarrow", "↑↓"), (r"\left(x\right)", "(x)"), (r"2\times3\cdot4", "2×3·4"),
    (r"\log x", "log x"), (r"\sim∼", "～～"), (r"\geq\leq", "≥≤"), ("T_{1/2} t_{1/2}", "T₁/₂ t₁/₂"), (r"V_{\max} V_{max}", "Vmax Vmax"), ("Ca^{2 +}", "Ca²⁺"), ("H_{2}O", "H₂O"), ("x^{-3}", "x⁻³"), ("a_1 b^2", "a₁ b²"), ("2₂S R₄S 4₁S 10X", "2₂s R₄s 4₁s 10ₓ"), ("V_{Na}", "VNa"),
    ("5\\ mg", "5 mg"), ("$x$ y$", "x y"), ("end }", "end "), ("α - helix", "α-helix"), ("( β - x", "(β-x"), ("γ 球", "γ球"), ("H ₂", "H₂"), ("（ a ）", "（a）"), ("H₂ O", "H₂O"), ("5 μ g", "5 μg"), ("μ m", "μm"), ("5   mL", "5 mL"), ("mg / dL", "mg/dL"), ("MΩ / cm", "MΩ/cm"),
    ("pCO2", "pCO₂"), ("P O₂", "PO₂"), ("p CO₂", "pCO₂"), ("dl co", "DLCO"), ("SO ₂", "SO₂"), ("FEV ₁.₀ / FVC", "FEV₁/FVC"), ("FEV ₁ %x", "FEV₁%x"), ("a  ，b", "a，b"), ("a\t\tb", "a b"), ("5 ~ mmHg", "5 mmHg"), (r"1\~2", "1～2"), ("", ""), ("plain text.", "plain text."),
]
BLOOD = [
    ("anti- Fy a", "Anti-Fyᵃ"), ("Jk b", "Jkᵇ"), ("JKa", "Jkᵃ"), ("ANTI-Le a", "Anti-Leᵃ"), ("C w", "Cʷ"), ("Fyab", "Fyab"), ("xFy a", "xFy a"), ("anti - P ₁", "Anti-P₁"), ("Anti-PP₁P k", "Anti-PP₁Pᵏ"), ("Weak D ( D u )", "weak D (Dᵘ)"), ("D u", "Dᵘ"), ("rh null", "Rh_{null}"),
    ("O _ h", "Oₕ"), ("A1 cells", "A₁ cells"), ("A 2 亞型", "A₂ 亞型"), ("A1 b", "A1 b"), ("A el", "A_{el}"), ("B_{end}x", "B_{end}x"), ("B_{end}", "B_{end}}"), ("b m", "Bₘ"), ("O h", "Oₕ"), ("CFU E", "CFU_{E}"), ("BFUE", "BFU_{E}"), (r"Factor V_{\text{Leiden}}", "Factor V_{Leiden}"), ("PFA-100 ^{®}", "PFA-100®"), ("Se w1", "Seʷ1"),
]


@pytest.mark.parametrize(("text", "want"), SCIENCE)
def test_science(text, want):
    assert N.rewriter((*N.SCIENCE, *N.AFTERWARDS))(text) == want


@pytest.mark.parametrize(("text", "want"), BLOOD)
def test_blood_groups(text, want):
    assert N.rewriter(N.BLOOD_GROUPS)(text) == want


def test_literals_only_spare_work():
    """Steps that are skipped for want of a literal would have changed nothing, whatever came before them."""
    rng = random.Random(4)
    bits = [x for pair in (*SCIENCE, *BLOOD) for x in pair] + list(" \t\n$\\{}^_-0123456789ABOabchmuw₁₂°℃~，")
    bare = tuple(s._replace(needs=()) for s in N.CANDIDATE)
    guarded, plain = N.rewriter(N.CANDIDATE), N.rewriter(bare)
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 12)))
        assert guarded(text) == plain(text), text


def test_long_texts_cost_their_length():
    of = N.rewriter(N.CANDIDATE)
    assert of(" " * 200_000 + "x") == " x" and of("a" * 200_000) == "a" * 200_000 and len(of("word " * 100_000)) == 500_000


def test_columns(spark):
    rows = spark.createDataFrame([(1, r"$\alpha$ Fy a", ["A el", None]), (2, None, None), (3, "", [])], "i int, t string, l array<string>")
    got = {r.i: (r.a, r.b) for r in rows.select("i", N.candidate_notation(F.col("t")).alias("a"), N.candidate_notation_all(F.col("l")).alias("b")).collect()}
    assert got == {1: ("α Fyᵃ", ["A_{el}}", None]), 2: (None, None), 3: ("", [])}


FOUR = [("A", "one"), ("B", "two"), ("C", "three"), ("D", "four")]
CASES = {
    "clean": (("plain?", FOUR, 1, False), None),
    "stem": (("Fy a is", FOUR, 1, False), ("needs_review", ["hematology_notation_normalized", "hematology_symbol_suspect"], ["blood_group_symbol_suspect", "needs_human_review", "science_notation_suspect"], "human_review_text")),
    "changed only": ((r"5 $\times$ 3", FOUR, 1, False), ("needs_review", ["hematology_notation_normalized"], ["needs_human_review", "science_notation_suspect"], "human_review_text")),
    "three options": (("plain?", FOUR[:3], 1, False), ("block", ["option_structure_suspect"], ["block_likely", "needs_human_review", "option_parse_suspect"], "fix_parser_rule")),
    "twice A": (("plain?", [*FOUR[:3], ("A", "x")], 1, False), ("block", ["option_structure_suspect"], ["block_likely", "needs_human_review", "option_parse_suspect"], "fix_parser_rule")),
    "blank option": (("plain?", [*FOUR[:3], ("D", " 　")], 1, False), ("block", ["empty_option_text"], ["block_likely", "needs_human_review", "option_parse_suspect"], "fix_parser_rule")),
    "next question": (("plain?\n 13. Another one", FOUR, 12, False), ("block", ["next_question_inside_candidate"], ["block_likely", "needs_human_review", "parser_boundary_suspect"], "fix_parser_rule")),
    "no number": (("plain?\n 1. Another one", FOUR, None, False), None),
    "table": (("plain <TABLE>", FOUR, 1, False), ("needs_review", ["structured_table_needs_visual_review"], ["needs_human_review", "table_or_image_suspect"], "add_manual_asset")),
    "table and image": (("plain <table>", FOUR, 1, True), ("needs_review", ["structured_table_needs_visual_review"], ["needs_human_review", "table_or_image_suspect"], "human_review_pdf_visual")),
    "nothing": ((None, None, None, None), ("block", ["option_structure_suspect"], ["block_likely", "needs_human_review", "option_parse_suspect"], "fix_parser_rule")),
}


def test_audit(spark):
    rows = [(name, *row, "clash") for name, (row, _) in CASES.items()]
    frame = spark.createDataFrame(rows, "name string, stem string, options array<struct<key:string,text:string>>, question_number int, has_image boolean, audit_note string")
    got = {r.name: r.audit for r in audited_notation(frame).collect()}
    for name, (_, want) in CASES.items():
        assert (name in got) == (want is not None), name
        if want:
            a = got[name]
            assert (a.status, [f.code for f in a.findings], a.labels, a.recommended_action) == want, name
    assert got["stem"].correction.stem == "Fyᵃ is" and got["stem"].correction.options is None and got["stem"].confidence == 0.82
    assert [f.evidence for f in got["stem"].findings] == ["stem", "Fy a"]
    assert got["next question"].findings[0].evidence == "\n 13. Another one"
    assert got["twice A"].findings[0].evidence == '["A","B","C","A"]'


def test_queries(spark):
    sf = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    full = N.rewriter(N.FULL)
    got = dict(registry.queries()["science_notation"](spark, sf).collect())
    assert got == {i: None if t is None else full(t) for i, t in texts.items()}


def test_steps_are_passed_only_where_they_cannot_match():
    """What a step names as needed is in all that it matches: the same results as without any of it."""
    words = "Fy a Jk b Anti-C Rh null weak D ( Du ) RHNULL late bfu e BFU E A 1 cells O2 subgroup el B_{end} Gy FC Y receptor dl co DL CO \\mu m $x^{2}$ 10X ^{\\circ}C ° C α β 中 文 g mol mL  \t 5 μ / dL CO2 pO₂ H_{2}O → ， - （ ） } ^ ~ mmHg FEV ₁ % R₄S Se w1 ſ K null".split(" ")
    rng = random.Random(3)
    texts = [rng.choice([" ", "", " "]).join(rng.choice(words) for _ in range(rng.randint(1, 8))) for _ in range(3000)]
    for steps in (N.FULL, N.CANDIDATE):
        gated, plain = N.rewriter(steps), N.rewriter(tuple(s._replace(needs=()) for s in steps))
        assert [gated(t) for t in texts] == [plain(t) for t in texts]


def test_texts_are_python_objects_a_few_at_a_time(monkeypatch):
    """A batch of long texts is not whole as Python objects, and the results that are remembered are bounded."""
    import pyarrow as pa

    seen, real = [], pa.array
    monkeypatch.setattr(N.pa, "array", lambda x, kind: seen.append(len(x)) or real(x, kind))
    column = pa.chunked_array([real(["x  y", None] * 500)]).combine_chunks()
    out = N._by_rows(column, pa.string(), N._remembered(N.rewriter(N.FULL)))
    assert out.to_pylist() == ["x y", None] * 500 and max(seen) <= N.ROWS
    one = N._remembered(str.upper)
    assert [one(f"x{i}") for i in range(N.KNOWN + 5)][-1] == f"X{N.KNOWN + 4}" and one("y" * 5000) == "Y" * 5000
    known = next(c.cell_contents for c in one.__closure__ if isinstance(c.cell_contents, dict))
    assert len(known) <= N.KNOWN and "y" * 5000 not in known
