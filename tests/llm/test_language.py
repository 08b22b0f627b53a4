import itertools
import math
import random

from pyspark.sql import functions as F

from sluice.llm import bpe, language
from sluice.llm.bpe import default_vocabulary
from sluice.llm.common import Remembered, kept

PATH = default_vocabulary()


def brute(word, pieces, p, rest, i):
    raw = word.encode()
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(raw) - 1):
        places = [0, *(k + 1 for k, c in enumerate(cuts) if c), len(raw)]
        prob = 1.0
        for a, b in zip(places, places[1:]):
            piece = (pieces.final if b == len(raw) else pieces.inner).get(raw[a:b])
            prob *= 0.0 if piece is None else p.get(piece, rest)[i]
        total += prob
    return math.log(total)


def test_forward_sums_all_segmentations():
    pieces = language.pieces(PATH)
    p = {i: (0.001 + i % 7 / 1000, 0.002 + i % 5 / 900) for i in range(0, pieces.size, 3)}
    rest = (1e-4, 2e-4)
    for word in ("a", "the", "rest", "été", "nation"):
        got = language.log_probabilities(word, pieces, p, rest)
        for i in range(2):
            assert math.isclose(got[i], brute(word, pieces, p, rest, i), rel_tol=1e-9)


def test_long_words_are_one_sum():
    pieces = language.pieces(PATH)
    rng = random.Random(2)
    p = {i: (rng.random() / 500, rng.random() / 900) for i in range(0, pieces.size, 3)}
    rest = (1e-7, 2e-7)
    word = "".join(rng.choice("abcdeéßñ語") for _ in range(10_000))
    got = language.log_probabilities(word, pieces, p, rest)
    for i in range(2):  # the same sum in exact logarithms
        logs = [0.0]
        for arcs in pieces.lattice(word.encode()):
            terms = [logs[a] + math.log(p.get(x, rest)[i]) for a, x in arcs]
            logs.append(max(terms) + math.log(sum(math.exp(t - max(terms)) for t in terms)))
        assert math.isclose(got[i], logs[-1], rel_tol=1e-9)


def test_expected_counts_against_brute_force():
    pieces = language.pieces(PATH)
    p = {i: 0.001 + i % 7 / 1000 for i in range(0, pieces.size, 3)}
    for word in ("a", "the", "rest", "été", "nation"):
        got, want, total = {}, {}, 0.0
        language.expected_counts(word, 2.0, pieces, p, 1e-4, got)
        raw = word.encode()
        for cuts in itertools.product([0, 1], repeat=len(raw) - 1):
            places = [0, *(k + 1 for k, c in enumerate(cuts) if c), len(raw)]
            found = [(pieces.final if b == len(raw) else pieces.inner).get(raw[a:b]) for a, b in zip(places, places[1:])]
            if None not in found:
                prob = math.prod(p.get(x, 1e-4) for x in found)
                total += prob
                for x in found:
                    want[x] = want.get(x, 0.0) + prob
        assert got.keys() == want.keys() and all(math.isclose(got[x], 2.0 * want[x] / total, rel_tol=1e-9) for x in want)
    long, n = {}, 3000
    language.expected_counts("e" * n, 1.0, pieces, p, 1e-4, long)
    lengths = {i: len(raw) for known in (pieces.inner, pieces.final) for raw, i in known.items()}
    assert math.isclose(sum(lengths[x] * v for x, v in long.items()), n, rel_tol=1e-6)  # every byte is covered once


def test_kept_columns_give_way(spark):
    docs = spark.createDataFrame([(1, "the cat", "en", "x", 2)], "doc_id long, text string, lang string, score string, lang_pred int")
    model = language.fit(docs, PATH)
    got = language.identify(docs, model, PATH, keep=tuple(docs.columns))
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"] and got.first().lang_pred == "en"


def test_rows(spark):
    texts = {"en": "the cat and the dog are in the house with them", "de": "der hund und die katze sind nicht mit ihnen im haus", "es": "el perro y los gatos no son de la casa para ellos"}
    rows = [(10 * i + k, f"{t} {i}", g, "x") for i in range(30) for k, (g, t) in enumerate(texts.items())]
    rows += [(900, None, "en", "x"), (901, "", None, "x"), (902, "12 34 !?", "de", "x"), (903, "y" * 9000, "es", "x"), (None, "the house", None, "x"), (0, "the cat and the house", "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = language.fit(docs.filter(language.is_training(F.col("doc_id"))), PATH)
    got = [tuple(r) for r in language.identify(docs, model, PATH).collect()]
    assert len(got) == len(rows)
    said = {k: (g, s) for k, g, s in got if k is not None and k != 0}
    for i in range(1, 30):
        for k, g in enumerate(texts):
            assert said[10 * i + k][0] == g
    assert said[900][0] == said[901][0] == said[902][0] == "und"
    assert all(0 <= s <= 1 for _, _, s in got)
    none = language.fit(docs.filter(F.lit(False)), PATH)
    assert {r.lang_pred for r in language.identify(docs, none, PATH).collect()} == {"und"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.query(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.filter("lang = lang_pred").count() / got.count() > 0.97


def test_texts_are_sent_once(spark):
    docs = spark.createDataFrame([(1, "the cat", "en"), (2, None, "de")], "doc_id long, text string, lang string")
    model = language.Model(["en", "de"], {}, language.pieces(PATH).size)
    got = language.identify(docs, model, PATH, keep=("text", "doc_id"))
    assert "__text" not in got._jdf.queryExecution().analyzed().toString()  # each row's text once in the batches sent to Python
    want = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, model, PATH).collect()}
    rows = got.collect()
    assert {(r.doc_id, r.text) for r in rows} == {(1, "the cat"), (2, None)} and all(want[r.doc_id] == (r.lang_pred, r.score) for r in rows)


def test_what_a_worker_remembers_is_bounded():
    found = Remembered(10)
    for i in range(100):
        found.put(i, str(i))
        assert len(found) <= 10 and found.get(i) == str(i) and (i < 1 or found.get(i - 1) == str(i - 1))
    assert found.get(3) is None
    first = bpe.tokenizer(PATH)
    assert bpe.tokenizer(PATH) is first
    assert kept(("language", "x"), dict) is kept(("language", "x"), list)
    assert bpe.tokenizer(PATH) is not first  # the table of one operator goes before another's comes
