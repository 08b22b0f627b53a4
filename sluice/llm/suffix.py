"""Suffix-array dedup: byte strings of a fixed length that start twice are removed.

Bucket-pointer refinement over a sparse set of suffixes. Every window of `length` bytes contains an anchor:
a place whose q-gram has the least hash of the window. Anchors depend on the window's bytes alone, so equal
windows have their anchors at equal offsets, and only anchored suffixes need sorting into buckets. The initial
bucket of an anchor is its q-gram. A bucket is refined by identifiers (hashes) of what lies at earlier and
later offsets, from the widest context to the narrowest: if the context of all windows around an anchor occurs
twice, all of them are found; if what a range of windows has in common occurs once, none of them is; otherwise
the range is split and its parts are refined in turn, reusing what is known. Buckets of one suffix, and ranges
that are settled, drop out at every step (but for one witness of each settled class that still open suffixes
are held against), so that the work follows the repeated text and its edges.

Buckets are counted and joined back, never gathered: a bucket may hold any share of all suffixes. Texts are
UTF-8 bytes; null is empty; texts shorter than `length` have no window. Rows equal in doc_id and text are
separate occurrences with the same verdict. Identifiers are 64-bit hashes compared within one bucket.
Texts of any length are taken whole; of equal windows all go, so there are no ties to break. Only doc_id and text are
read, so other columns never clash; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Prefix, chunks, discard, mix, release, stored, table

NAME = "op2_suffix_dedup"
LENGTH = 200
Q = 64


def sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """Best of each run of `width` values, by doubling."""
    if len(values) < width:
        return values[:0]
    have, out = 1, values
    while 2 * have <= width:
        out = best(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return best(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(buf: np.ndarray, offsets: np.ndarray, length: int, q: int) -> tuple[np.ndarray, ...]:
    """Text, place, least and greatest window offset, q-gram and context identifiers of every anchor."""
    none = np.zeros(0, np.int64)
    width = length - q + 1
    n = len(buf)
    if n < length:
        return none, none, none, none, none, none
    prefix = Prefix(buf)
    grams = prefix.runs(q) | np.uint64(1)  # 0 marks windows that leave their text
    least = sliding(grams, width, np.minimum)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = owner[: len(least)] == owner[length - 1 : length - 1 + len(least)]
    least = np.where(whole, least, np.uint64(0))
    pad = np.zeros(width - 1, np.uint64)
    most = sliding(np.concatenate([pad, least, pad]), width, np.maximum)
    at = np.flatnonzero(most[: len(grams)] == grams)
    text = owner[at]
    a = at - offsets[text]
    size = np.diff(offsets)[text]
    low, high = np.maximum(0, a + length - size), np.minimum(width - 1, a)
    context = mix(prefix.of(at - high, at - low + length) ^ (low * 65536 + high).astype(np.uint64))
    return text, a, low, high, grams[at].view(np.int64), context.view(np.int64)


def keyed_docs(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(11), "text", "doc_id").alias("k2"), "text")


def level_ranges(width: int) -> list[int]:
    """Widths of the ranges of each level: two splits, then single offsets."""
    side = max(2, round(width ** (1 / 3)))
    return [-(-width // side), -(-width // side**2), 1]


def ranges(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Of a column of arrays of pairs of ints (null: none): the first pair of each row (and one past), and both numbers of all pairs."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    a, b = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in column.flatten().flatten())
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), a, b


def split(first: np.ndarray, lo: np.ndarray, hi: np.ndarray, step: int, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, least and greatest offset of the parts of `step` offsets of each row's ranges that reach into its low to high."""
    n = -(-(hi + 1 - lo) // step)
    of = np.repeat(np.arange(len(lo)), n)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))[of]
    x = lo[of] + step * (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n))
    y = np.minimum(x + step - 1, hi[of])
    some = (x <= high[row]) & (y >= low[row])
    return row[some], x[some], y[some]


def repeated_spans(docs: DataFrame, length: int = LENGTH, q: int = Q) -> DataFrame:
    """(k1, k2, s, e): spans of bytes all of whose windows start elsewhere too; k1, k2 from keyed_docs."""
    spark = docs.sparkSession
    rows = keyed_docs(docs)
    width = length - q + 1

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, buf, offsets in chunks(batch.column(2)):
                text, a, low, high, gram, context = anchors(buf, offsets, length, q)
                if len(text):
                    keys = [c.slice(first, last - first).take(pa.array(text)) for c in batch.columns[:2]]
                    yield pa.RecordBatch.from_arrays([*keys, *(pa.array(x) for x in (gram, context)), *(pa.array(x.astype(np.int32)) for x in (a, low, high))], ["k1", "k2", "gram", "context", "a", "low", "high"])

    schema = "k1 long, k2 long, gram long, context long, a int, low int, high int"
    found = stored(rows.select("k1", "k2", "text").mapInArrow(find, schema))
    often = stored(found.groupBy("gram").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("gram"))
    release(spark)
    live = stored(found.join(often.hint("merge"), "gram", "left_semi"))
    discard(found, often)
    same = ["gram", "context", "low", "high"]
    wide = live.groupBy(*same).agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select(*same, F.lit(True).alias("whole"))
    first = stored(live.join(wide.hint("merge"), same, "left"))
    discard(live)
    spans = stored(first.filter("whole").select("k1", "k2", (F.col("a") - F.col("high")).alias("s"), (F.col("a") - F.col("low") + length).alias("e")))

    # the contexts of what is open yet, and of one witness of each settled class in the same buckets
    still = first.filter("whole is null").select("k1", "k2", "gram", "a", "low", "high")
    witness = first.filter("whole").groupBy(*same).agg(F.min(F.struct("k1", "k2", "a")).alias("x")).select("x.k1", "x.k2", "gram", "x.a", "low", "high")
    witness = witness.join(still.select("gram").distinct().hint("merge"), "gram", "left_semi")  # classes, not the rows of a hot gram
    wanted = still.unionByName(witness.select(*still.columns)).groupBy("k1", "k2").agg(F.collect_set(F.struct("gram", "a", "low", "high")).alias("open"))  # of one text
    cut = rows.select("k1", "k2", "text").join(wanted, ["k1", "k2"]).select("k1", "k2", F.encode("text", "utf-8").alias("raw"), F.explode("open").alias("x"))
    context = F.substring("raw", F.col("x.a") - F.col("x.high") + 1, F.col("x.high") - F.col("x.low") + length)
    edges = stored(cut.select("k1", "k2", "x.*", context.alias("bytes")))
    discard(first)

    def refine(step: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                first, los, his = ranges(batch.column(7))
                low_of, high_of = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (4, 5))
                for begin, end, buf, offsets in chunks(batch.column(6)):
                    some = slice(first[begin], first[end])
                    row, lo, hi = split(first[begin : end + 1], los[some], his[some], step, low_of[begin:end], high_of[begin:end])
                    if not len(row):
                        continue
                    row += begin
                    prefix, base = Prefix(buf), offsets[row - begin] + high_of[row]
                    core = prefix.of(base - lo, base - hi + length)
                    full = (lo >= low_of[row]) & (hi <= high_of[row])
                    clip_hi, clip_lo = np.minimum(hi, high_of[row]), np.maximum(lo, low_of[row])
                    whole = prefix.of(base - clip_hi, base - clip_lo + length)
                    keys = [c.take(pa.array(row)) for c in batch.columns[:4]]
                    yield pa.RecordBatch.from_arrays([*keys, *(pa.array(x.astype(np.int32)) for x in (lo, hi)), pa.array(core.view(np.int64)), pa.array(whole.view(np.int64), mask=~full)], ["k1", "k2", "gram", "a", "lo", "hi", "core", "whole"])

        return run

    todo = edges.withColumn("parents", F.array(F.struct(F.lit(0).alias("lo"), F.lit(width - 1).alias("hi"))))
    for step in level_ranges(width):
        parts = stored(todo.select("k1", "k2", "gram", "a", "low", "high", "bytes", "parents").mapInArrow(refine(step), "k1 long, k2 long, gram long, a int, lo int, hi int, core long, whole long"))
        release(spark)
        cores = parts.groupBy("gram", "lo", "core").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("gram", "lo", "core")
        able = parts.join(cores.hint("merge"), ["gram", "lo", "core"], "left_semi")
        if step == 1:  # what one window has in common is the window
            spans = spans.unionByName(stored(able.select("k1", "k2", (F.col("a") - F.col("hi")).alias("s"), (F.col("a") - F.col("lo") + length).alias("e"))))
            discard(parts, edges)
            break
        able = stored(able)
        discard(parts)
        wholes = able.filter("whole is not null").groupBy("gram", "lo", "whole").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("gram", "lo", "whole", F.lit(True).alias("found"))
        settled = stored(able.join(wholes.hint("merge"), ["gram", "lo", "whole"], "left").select("k1", "k2", "gram", "a", "lo", "hi", "whole", "found"))
        discard(able)
        spans = spans.unionByName(stored(settled.filter("found").select("k1", "k2", (F.col("a") - F.col("hi")).alias("s"), (F.col("a") - F.col("lo") + length).alias("e"))))
        still = settled.filter("found is null").select("k1", "k2", "gram", "a", "lo", "hi")
        open_nodes = still.select("gram", "lo").distinct().hint("merge")
        witness = settled.filter("found").groupBy("gram", "lo", "whole").agg(F.min(F.struct("k1", "k2", "a", "hi")).alias("x")).select("x.k1", "x.k2", "gram", "x.a", "lo", "x.hi")
        witness = witness.join(open_nodes, ["gram", "lo"], "left_semi")
        below = stored(still.unionByName(witness.select(*still.columns)).groupBy("k1", "k2", "a").agg(F.collect_set(F.struct("lo", "hi")).alias("parents")))  # ranges of one anchor
        discard(settled)
        todo = edges.join(below, ["k1", "k2", "a"])
    return spans


def with_spans(docs: DataFrame, length: int = LENGTH, q: int = Q) -> DataFrame:
    """doc_id, text and its repeated spans (array of structs s, e; null if none) of every row."""
    spans = repeated_spans(docs, length, q).groupBy("k1", "k2").agg(F.collect_set(F.struct("s", "e")).alias("spans"))  # of one text
    return keyed_docs(docs).join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans")


def merged(row: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, start and end of the maximal runs of spans of one buffer; those of one row lie within its text, and no run leaves it."""
    order = np.lexsort((s, row))
    row, s, e = row[order], s[order], e[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] > np.maximum.accumulate(e)[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    return row[first], s[first], np.maximum.reduceat(e, first) if len(first) else e


def dedup(docs: DataFrame, length: int = LENGTH, q: int = Q) -> DataFrame:
    """doc_id, n_bytes, n_removed, removed (maximal runs of bytes), kept (the other bytes) and its SHA-256."""
    rows = with_spans(docs, length, q)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, s, e = ranges(batch.column(2))
            for begin, end, buf, offsets in chunks(batch.column(1)):
                some, n = slice(spans[begin], spans[end]), end - begin
                row = np.repeat(np.arange(n), np.diff(spans[begin : end + 1]))
                row, starts, ends = merged(row, s[some] + offsets[row], e[some] + offsets[row])
                edges = np.concatenate([[0], np.stack([starts, ends], 1).ravel(), [len(buf)]])
                kept = buf[np.repeat(np.arange(len(edges) - 1) % 2 == 0, np.diff(edges))]
                gone = np.bincount(row, weights=ends - starts, minlength=n).astype(np.int64)
                bounds = offsets - np.concatenate([[0], np.cumsum(gone)])
                raw, places = memoryview(kept), bounds.tolist()
                digests = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(places, places[1:])]
                pairs = pa.StructArray.from_arrays([pa.array((x - offsets[row]).astype(np.int32)) for x in (starts, ends)], ["s", "e"])
                runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32)), pairs)
                bytes_ = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(kept)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, n), pa.array(np.diff(offsets)), pa.array(gone), runs, bytes_, pa.array(digests, pa.string())], ["doc_id", "n_bytes", "n_removed", "removed", "kept", "kept_sha256"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, removed array<struct<s:int,e:int>>, kept binary, kept_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, p, md5(substr(h, 2 * p + 1, {2 * LENGTH})) AS m FROM d, unnest(range(0, length(h) // 2 - {LENGTH - 1})) AS u(p)),
dup AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY m) AS c FROM w) WHERE c > 1),
marked AS (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p) AS island
  FROM (SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + {LENGTH} THEN 0 ELSE 1 END AS new FROM dup)),
runs AS (SELECT r, min(p) AS s, max(p) + {LENGTH} AS e FROM marked GROUP BY r, island),
gaps AS (SELECT r, s AS b, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS a FROM runs
  UNION ALL SELECT d.r, length(h) // 2, coalesce(max(e), 0) FROM d LEFT JOIN runs USING (r) GROUP BY d.r, h),
kept AS (SELECT g.r, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS k FROM gaps g JOIN d USING (r) GROUP BY g.r)
SELECT doc_id, length(h) // 2 AS n_bytes, (length(h) - length(k)) // 2 AS n_removed, coalesce(n, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (r) LEFT JOIN (SELECT r, count(*) AS n FROM runs GROUP BY r) USING (r)
"""
