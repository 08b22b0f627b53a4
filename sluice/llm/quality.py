"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Word unigrams and bigrams are hashed to a fixed number of buckets. Two multinomials over the buckets are
counted: one over all documents (raw), one over trusted documents (labelled of good quality and not toxic).
A document's score is the mean over its n-grams of log p_target / p_raw; it is kept if the score reaches a
threshold. Surface rules (too few words, too many repeated eight-word windows) come first.

A trusted document is scored with its own n-grams taken out of the target, so that its score is that of a
document without a label. So of two rows with one text, one trusted and one without a label, the latter can score higher, as the
other's n-grams count for it, and the two can be judged apart. The threshold comes from a histogram of the scores of all labelled documents that pass
the rules: the share of trusted ones lost and the share of toxic ones kept have the least sum (the middle, if
many do). Without toxic rows it is the LOST quantile of the trusted scores.

All labelled rows and all documents are counted. Nulls and empty texts have no words and fail the rules. Labels
whose doc_id is null or unknown are ignored; repeated labels count once, the worst of them; without trusted rows
every score is 0. A score that equals the threshold is kept. Texts of any length are taken whole; repeated rows each get
their row; an empty table gives none. Columns other than doc_id and text are left out, so names never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import IS_SPACE, Prefix, chunks, inside, mix, rolling, stored, table, words

NAME = "op7_quality_rules"
BUCKETS = 1 << 16
LOST = 0.01
BINS = 1 << 16
SMOOTHING = 0.5
WINDOW = 8

IS_SYMBOL = np.zeros(256, dtype=bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of flags within each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def grams(buf: np.ndarray, offsets: np.ndarray, prefix: Prefix) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple]:
    """Buckets of all unigrams and bigrams with the text each is in; word hashes and word places."""
    starts, ends, firsts = words(buf, offsets)
    hashes = prefix.of(starts, ends)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
    pairs = inside(firsts, 2, len(hashes))
    buckets = np.concatenate([hashes, rolling(hashes, 2)[pairs]]) % np.uint64(BUCKETS)
    owners = np.concatenate([owner, owner[: len(pairs)][pairs]])
    return buckets.astype(np.int64), owners, hashes, (starts, ends, firsts)


def bucket_counts(texts: DataFrame) -> DataFrame:
    """Counts of hashed n-grams over all rows of `texts`, summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, buf, offsets in chunks(batch.column(0)):
                total += np.bincount(grams(buf, offsets, Prefix(buf))[0], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def summed(counts: DataFrame) -> np.ndarray:
    """The smoothed count of each bucket (BUCKETS numbers, whatever the input)."""
    c = np.full(BUCKETS, SMOOTHING)
    for bucket, n in counts.collect():
        c[bucket] += n
    return c


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log p_target - log p_raw of each bucket."""
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def without_own(buckets: np.ndarray, owners: np.ndarray, n_grams: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a text's score gains when its own n-grams leave the target (never below SMOOTHING a bucket)."""
    _, place, times = np.unique(owners * BUCKETS + buckets, return_index=True, return_counts=True)
    had = target[buckets[place]]
    change = times * np.log(np.maximum(had - times, SMOOTHING) / had)
    total = target.sum()
    left = np.maximum(total - n_grams, SMOOTHING)
    return np.bincount(owners[place], weights=change, minlength=len(n_grams)) / np.maximum(n_grams, 1) - np.log(left / total)


def features(buf: np.ndarray, offsets: np.ndarray, ratio: np.ndarray, target: np.ndarray | None = None) -> dict[str, np.ndarray]:
    n = len(offsets) - 1
    prefix = Prefix(buf)
    buckets, owners, hashes, (starts, ends, firsts) = grams(buf, offsets, prefix)
    n_words = np.diff(firsts)
    n_grams = np.bincount(owners, minlength=n)
    score = np.bincount(owners, weights=ratio[buckets], minlength=n) / np.maximum(n_grams, 1)

    repeated = np.zeros(n, np.int64)
    windows = np.flatnonzero(inside(firsts, WINDOW, len(hashes)))
    if len(windows):
        owner = owners[: len(hashes)]
        keys = mix(rolling(hashes, WINDOW)[windows] ^ mix(owner[windows].astype(np.uint64)))
        _, back, times = np.unique(keys, return_inverse=True, return_counts=True)
        again = windows[times[back] > 1]
        cover = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(cover, again, 1)
        np.add.at(cover, again + WINDOW, -1)
        repeated = per_text(np.cumsum(cover[:-1]) > 0, firsts)

    duplicates = np.zeros(n, np.int64)
    if len(buf):
        breaks = np.flatnonzero(buf == 10)
        begins = np.unique(np.concatenate([offsets[:-1][offsets[:-1] < len(buf)], breaks + 1]))
        begins = begins[begins < len(buf)]
        line_owner = np.searchsorted(offsets, begins, "right") - 1
        stop = np.minimum(np.concatenate([begins[1:], [len(buf)]]), offsets[line_owner + 1])
        stop = np.where((stop > begins) & (buf[np.maximum(stop - 1, 0)] == 10), stop - 1, stop)
        has_word = np.searchsorted(starts, stop) > np.searchsorted(starts, begins)
        begins, stop, line_owner = begins[has_word], stop[has_word], line_owner[has_word]
        keys = mix(prefix.of(begins, stop) ^ mix(line_owner.astype(np.uint64)))
        first = np.zeros(len(keys), bool)
        first[np.unique(keys, return_index=True)[1]] = True
        duplicates = np.bincount(line_owner[~first], minlength=n)

    return {
        "n_words": n_words,
        "word_chars": per_text(~IS_SPACE[buf] & ((buf & 0xC0) != 0x80), offsets),
        "n_symbols": per_text(IS_SYMBOL[buf], offsets),
        "n_dup_lines": duplicates,
        "n_repeat_words": repeated,
        "score": score,
        "own_out": score if target is None else score + np.where(n_grams > 0, without_own(buckets, owners, n_grams, target), 0.0),
    }


COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double, own_out double"


def scored(docs: DataFrame, ratio: np.ndarray, target: np.ndarray | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Features of every row; own_out is the score of a row that is in the target, without its own n-grams."""
    shared = docs.sparkSession.sparkContext.broadcast((ratio, target))  # BUCKETS numbers each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, offsets in chunks(batch.column(1)):
                found = features(buf, offsets, *shared.value)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(v) for v in found.values())], [key, *found])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(docs[key].alias(key), docs[text].alias("text")).mapInArrow(run, f"`{key}` {kind}, {COLUMNS}")


def verdicts(labels: DataFrame) -> DataFrame:
    """doc_id, trusted and toxic of each labelled document."""
    bad = (F.coalesce("quality", F.lit(0)) < 1) | (F.coalesce("toxic", F.lit(1)) > 0)
    ids = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id")
    return ids.agg((~F.max(bad)).alias("trusted"), F.max(F.coalesce("toxic", F.lit(0)) > 0).alias("toxic"))


def threshold_of(passed: DataFrame) -> float | None:
    """The threshold from rows (score, trusted, toxic), by counts of at most BINS bins; None without trusted rows."""
    low, high = passed.filter("trusted or toxic").agg(F.min("score"), F.max("score")).first()
    if low is None:
        return None
    width = max((high - low) / (BINS - 1), 1e-12)
    place = F.floor((F.col("score") - F.lit(low)) / F.lit(width)).cast("int")
    good, toxic = np.zeros(BINS + 2, np.int64), np.zeros(BINS + 2, np.int64)
    for at, a, b in passed.filter("trusted or toxic").groupBy(place.alias("at")).agg(F.count_if("trusted"), F.count_if("toxic")).collect():  # BINS rows at most
        good[at + 1] += a
        toxic[at + 1] += b
    lost, caught = np.cumsum(good)[:-1], np.cumsum(toxic)[:-1]  # below the lower edge of each bin
    if not good.sum():
        return None
    if toxic.sum():
        cost = lost * int(toxic.sum()) + (int(toxic.sum()) - caught) * int(good.sum())
        first = int(cost.argmin())
        run = np.flatnonzero(cost[first:] != cost[first])
        edge = first + ((run[0] if len(run) else len(cost) - first) - 1) // 2
    else:
        edge = int(np.flatnonzero(lost <= int(LOST * good.sum()))[-1])
    return float(low + edge * width)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Features, score, threshold and verdict of every row of docs (doc_id, text)."""
    said = verdicts(labels)
    trusted = docs.select("doc_id", "text").join(said.filter("trusted").hint("merge"), "doc_id", "left_semi")  # ids grow with the input
    target, raw = (summed(bucket_counts(d.select("text"))) for d in (trusted, docs))
    rows = scored(docs, log_ratio(target, raw), target).join(said.hint("merge"), "doc_id", "left")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    score = F.when(F.col("trusted"), F.col("own_out")).otherwise(F.col("score"))
    rows = stored(rows.withColumn("score", score).withColumn("base_failed", failed).drop("own_out"))  # a few numbers for each document
    threshold = threshold_of(rows.filter("not base_failed"))
    if threshold is None:
        rows, threshold = rows.withColumn("score", F.lit(0.0)), 0.0
    return rows.drop("trusted", "toxic").withColumn("threshold", F.lit(threshold)).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(threshold)))


def kept_of_labels(judged: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents and kept ones among trusted, toxic and other labelled documents: what the threshold costs."""
    kind = F.when(F.col("trusted"), "trusted").when(F.col("toxic"), "toxic").otherwise("other")
    return judged.join(verdicts(labels), "doc_id").groupBy(kind.alias("label")).agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("base_failed")).alias("passed_rules"), F.count_if("kept").alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("score", 6).alias("score"))
