import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluice.llm import tokencount

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
OURS = tokencount.PrefixCounter(PATH)


def library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


CASES = [
    "", " ", "  ", "The cat's 12 éÉ ñ", "we'll we're I've we'llama 'l 'll 're", "a<|endoftext|>B  <|endoftext|>  <|endoftext|>x",
    "x.. <|endoftext|>", "y'<|endoftext|>'ll", "a   b \n\n c\n\nd\t\te   ", "a\x1c\x1cb\x85\x85c　　d", "日本語 テスト 😀👍🏽", "======== ---- ....!!", "aaaaaaaaaaaaaaaaab" * 3,
    "<|endoftext", "  x", "naïve  façade 's  's",
]


def test_every_prefix_of_cases():
    for text in CASES:
        assert OURS.prefix_counts(text).tolist() == [library(text[:p]) for p in range(len(text) + 1)], text
        assert OURS.count(text) == library(text)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(alphabet=st.characters(codec="utf-8"), max_size=40), st.text(alphabet="' letrsvdm\n\t.-<|end>é0", max_size=60), st.lists(st.sampled_from(["<|endoftext|>", " ", "  ", "'ll", "the", ".", "<|", "é"]), max_size=12).map("".join)))
def test_every_prefix_of_random_texts(text):
    assert OURS.prefix_counts(text).tolist() == [library(text[:p]) for p in range(len(text) + 1)]
    assert OURS.count(text) == library(text)
    counts = OURS.prefix_counts(text)
    for limit in range(0, int(counts.max()) + 2):
        assert OURS.measure(text, limit) == (counts[-1], max(p for p, n in enumerate(counts) if n <= limit))


def test_runs_of_every_code_point():
    real = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(real), 128):
        text = " ".join(f"a{c}1{c} {c}{c}." for c in real[i : i + 128])
        said = LIBRARY.pre_tokenizer.pre_tokenize_str(text)
        assert [len(r.encode()) for r in OURS.runs(text)] == [len(letters) for letters, _ in said], hex(ord(text[1]))


def test_long_runs():
    for text in ("x" * 100_000, "ab" * 50_000, " " * 100_000, "=" * 99_999, "é" * 50_000, "\n" * 50_001 + "x"):
        assert OURS.count(text) == OURS.prefix_counts(text)[-1] == library(text)


def test_rows(spark):
    texts = [*CASES, None, CASES[4], "word " * 300, "x" * 10_000]
    docs = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(texts)], "doc_id long, text string, counts string")
    got = {r.doc_id: r for r in tokencount.token_counts(docs, PATH, limit=9).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        t = t or ""
        assert got[i].n_tokens == library(t)
        if len(t) < 400:
            assert got[i].fit_chars == max(p for p in range(len(t) + 1) if library(t[:p]) <= 9)
    assert tokencount.token_counts(docs.limit(0), PATH).collect() == []


def test_questions_answered_from_the_index(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*CASES, None])], "doc_id long, text string")
    index = tokencount.prefix_index(docs, PATH, keep=("doc_id", "text"))
    for budget in (-1, 0, 1, 5, 1000):
        c, b = F.col("counts"), F.lit(budget)
        for r in index.select("text", tokencount.longest_within(c, b).alias("n"), tokencount.truncated(F.col("text"), c, b).alias("cut"), tokencount.tokens_before(c, b).alias("before")).collect():
            t = r.text or ""
            assert r.n == max((p for p in range(len(t) + 1) if library(t[:p]) <= budget), default=None)
            assert r.cut == (None if r.n is None or r.text is None else t[: r.n])
            assert r.before == library(t[: max(0, budget)])
