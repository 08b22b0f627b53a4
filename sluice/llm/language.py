"""Language ID by unigrams over a fixed public vocabulary, summed over all segmentations.

Each language has a probability for every vocabulary piece. The probability of a word is the sum over all
ways to cut it into pieces of the product of their probabilities (forward algorithm); a text's score is
the product over its words. Words are maximal runs of letters (and of
numerals other than digits, such as fractions) in lower case, as UTF-8 bytes; the last
piece of a word comes from the pieces that end words. All single bytes are pieces, so every word has a
segmentation. Words of any length are summed in one forward pass, rescaled as it goes.

Piece probabilities are fitted by expectation maximisation on a bounded sample of labelled rows: about
TRAINING documents of each language, those whose hash falls under a rate set by the language's row count.
Every document is scored, whole. A null text or one without a letter is `und` with score 0; so is every
text if nothing was learned. Of languages that score alike the first in order wins. Repeated rows each get their
row; an empty table gives none. A null doc_id is neither held out nor learned from. In
identify(), a kept column called lang_pred or score gives way to the result's.
"""

from __future__ import annotations

import json
import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import byte_letters, default_vocabulary
from .common import Remembered, kept, table

NAME = "op3_language_id"
TRAINING = 250
ROUNDS = 2
SMOOTHING = 0.05
RESCALE = 16  # bytes: probabilities of all ways over this stretch stay well within a double
REMEMBERED = 400_000
SHORT = 48  # letters of the longest words that are remembered
LETTERS = re.compile(r"[^\W\d_]+")


class Pieces:
    """The vocabulary as byte strings: pieces inside words and pieces that end words."""

    def __init__(self, path: str):
        model = json.loads(open(path, encoding="utf-8").read())["model"]
        suffix = model["end_of_word_suffix"]
        byte = {c: b for b, c in enumerate(byte_letters())}
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for token, i in model["vocab"].items():
            ends = token.endswith(suffix)
            raw = bytes(byte[c] for c in token.removesuffix(suffix))
            (self.final if ends else self.inner)[raw] = i
        self.size = len(model["vocab"])
        self.longest = max(map(len, [*self.inner, *self.final]))

    def lattice(self, word: bytes) -> list[list[tuple[int, int]]]:
        """For each end place, the (start, piece) that may end there."""
        n, out = len(word), []
        for end in range(1, n + 1):
            known = self.final if end == n else self.inner
            out.append([(a, p) for a in range(max(0, end - self.longest), end) if (p := known.get(word[a:end])) is not None])
        return out


_pieces: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


def text_words(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def log_probabilities(word: str, vocabulary: Pieces, p: dict[int, tuple[float, ...]], rest: tuple[float, ...]) -> tuple[float, ...]:
    """log P(word) in each language: the forward sum over all segmentations."""
    k = len(rest)
    some = range(k)
    forward, total = [[1.0] * k], [0.0] * k
    longest = vocabulary.longest
    raw = word.encode("utf-8", "surrogatepass")
    for end, arcs in enumerate(vocabulary.lattice(raw), 1):
        here = [0.0] * k
        for a, piece in arcs:
            prob, before = p.get(piece, rest), forward[a]
            for i in some:
                here[i] += before[i] * prob[i]
        forward.append(here)
        if end % RESCALE == 0:  # what later places look back to is brought near 1
            for i in some:
                top = max(f[i] for f in forward[max(0, end - longest) :])
                total[i] += math.log(top)
                for f in forward[max(0, end - longest) :]:
                    f[i] /= top
    return tuple(total[i] + math.log(forward[-1][i]) for i in some)


def expected_counts(word: str, weight: float, vocabulary: Pieces, p: dict[int, float], rest: float, out: dict[int, float]) -> None:
    """Add the expected number of times each piece is used in the word's segmentations (forward-backward, each place with its own scale)."""
    lattice = vocabulary.lattice(word.encode("utf-8", "surrogatepass"))
    n = len(lattice)
    forward, scale = [1.0] + [0.0] * n, [0.0] * (n + 1)  # the sum at a place is forward * e**scale
    for end, arcs in enumerate(lattice, 1):
        high = scale[end - 1]
        got = sum(forward[a] * math.exp(scale[a] - high) * p.get(x, rest) for a, x in arcs)
        forward[end], scale[end] = 1.0, high + math.log(got)
    backward = [-math.inf] * n + [0.0]  # in logarithms: a place's sum over what may follow
    for end in range(n, 0, -1):
        for a, x in lattice[end - 1]:
            one, two = backward[a], backward[end] + math.log(p.get(x, rest))
            top = max(one, two)
            backward[a] = top + math.log(math.exp(one - top) + math.exp(two - top))
    for end, arcs in enumerate(lattice, 1):
        for a, x in arcs:
            share = p.get(x, rest) * math.exp(scale[a] + backward[end] - scale[n])
            out[x] = out.get(x, 0.0) + weight * share


class Model:
    """Languages in order, and for each seen piece its probability in every language."""

    def __init__(self, languages: list[str], counts: dict[tuple[str, int], float], size: int):
        self.languages = languages
        total = {g: SMOOTHING * size + sum(n for (h, _), n in counts.items() if h == g) for g in languages}
        self.rest = tuple(SMOOTHING / total[g] for g in languages)
        seen = {x for _, x in counts}
        self.p = {x: tuple((SMOOTHING + counts.get((g, x), 0.0)) / total[g] for g in languages) for x in seen}


def is_training(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 4 != 2


def sample(docs: DataFrame, most: int) -> DataFrame:
    """About `most` labelled rows of each language: those whose hash is under most / rows of the language."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each language
    if not sizes:
        return labelled.limit(0)
    rate = F.create_map(*(x for r in sizes for x in (F.lit(r.lang), F.lit(most / r.n))))[F.col("lang")]
    return labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003.0) < rate)


def fit(training: DataFrame, path: str, most: int = TRAINING, rounds: int = ROUNDS) -> Model:
    """Piece probabilities of each language from (doc_id, text, lang) rows."""
    rows = sample(training, most).select("lang", "text")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for w, n in Counter(text_words(text)).items():
                    found[lang, w] += n
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(list(found.values()), pa.int64())], ["lang", "word", "n"])

    spark = training.sparkSession
    counts = rows.mapInArrow(tally, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).persist()
    languages = sorted(r.lang for r in counts.select("lang").distinct().collect())
    model = Model(languages, {}, pieces(path).size)
    for _ in range(rounds if languages else 0):
        shared = spark.sparkContext.broadcast((model.languages, model.p, model.rest))  # vocabulary x languages

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, p, rest = shared.value
            by_language = {g: ({x: v[i] for x, v in p.items()}, rest[i], {}) for i, g in enumerate(names)}
            for batch in batches:
                for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    expected_counts(word, n, pieces(path), *by_language[lang])
            rows = [(g, x, v) for g, (_, _, out) in by_language.items() for x, v in out.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.float64())], ["lang", "piece", "n"])

        sums = counts.mapInArrow(expect, "lang string, piece long, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()
        # sums of doubles depend on their order in the last bits; rounding keeps runs alike
        model = Model(languages, {(r.lang, r.piece): round(r.n, 4) for r in sums if r.n >= 5e-5}, pieces(path).size)
    counts.unpersist()
    return model


class Scorer:
    def __init__(self, path: str, languages: list[str], p: dict, rest: tuple):
        self.vocabulary, self.languages, self.p, self.rest = pieces(path), languages, p, rest
        self.known = Remembered(REMEMBERED)

    def of(self, word: str) -> tuple[float, ...]:
        if (got := self.known.get(word)) is None:
            got = log_probabilities(word, self.vocabulary, self.p, self.rest)
            if len(word) <= SHORT:
                self.known.put(word, got)
        return got

    def predict(self, text: str | None) -> tuple[str, float]:
        found = text_words(text)
        if not self.languages or not any(map(str.isalpha, found)) and not any(map(str.isalpha, text or "")):
            return "und", 0.0
        known, of = self.known.newer.get, self.of
        totals = [sum(scores) for scores in zip(*[known(w) or of(w) for w in found], strict=True)]
        best = max(range(len(totals)), key=lambda i: (totals[i], -i))
        return self.languages[best], 1.0 / sum(math.exp(max(-700.0, t - totals[best])) for t in totals)


def identify(docs: DataFrame, model: Model, path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """lang_pred and score of every row's text, beside the columns in `keep`."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.p, model.rest))
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    keep = tuple(k for k in keep if k not in ("lang_pred", "score"))
    schema = ", ".join([*(f"`{k}` {fields[k]}" for k in keep), "lang_pred string", "score double"])
    sent = [docs[k] for k in keep] if text in keep else [*(docs[k] for k in keep), docs[text].alias("__text")]  # texts are large: once
    place = keep.index(text) if text in keep else len(keep)
    fitted = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept(("language", fitted), lambda: Scorer(path, *shared.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                said = [scorer.predict(x) for x in part.column(place).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array([x[0] for x in said], pa.string()), pa.array([x[1] for x in said], pa.float64())], [*keep, "lang_pred", "score"])

    return docs.select(*sent).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), default_vocabulary()
    model = fit(docs.filter(is_training(F.col("doc_id"))), path)
    found = identify(docs, model, path)
    return found.select("doc_id", F.coalesce(~is_training(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
