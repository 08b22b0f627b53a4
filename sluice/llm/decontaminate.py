"""Benchmark decontamination by pigeonhole edit matching.

A test item of m words may appear in a document with up to e word edits (a share of m). Cut into e + 1
pieces, at least one piece of such an appearance is unchanged; so pieces are looked up exactly, and around
each hit the whole item is aligned with Myers' bit-parallel edit distance, over words.

Words are runs of ASCII letters, digits and bytes of 0x80 and above; A-Z count as a-z. What counts as a match has
two parameters: `share`, and `piece`, the least words of a piece, which bounds e for short items (items of fewer
than 2 * piece words must appear unchanged; with piece = 1 the share alone counts). Items without words never
match. Null and empty texts match nothing; texts of any length are taken whole. Each matching (row, item) gives a
row; repeated rows and items each count, and of several places the least distance. Items of equal words are looked
up once. Items are matched in blocks of about ITEMS items and ITEM_BYTES bytes, so that what is broadcast has a
bound; every block is held against all rows. Without items, or rows, nothing matches. Columns other than those kept
are not read; a kept one that is named item_id, distance or n_item_words is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import common
from .common import LOWER_VALUE, Prefix, chunks, rolling, table

NAME = "op1_benchmark_leaks"
SHARE = 0.2
PIECE = 4
ITEMS, ITEM_BYTES = 20_000, 64 << 20

IS_BREAK = np.ones(256, dtype=bool)
IS_BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def word_hashes(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, firsts = common.words(buf, offsets, IS_BREAK)
    return Prefix(buf, LOWER_VALUE).of(starts, ends), firsts


def text_hashes(text: str) -> list[int]:
    raw = np.frombuffer(text.encode(), np.uint8)
    return word_hashes(raw, np.array([0, len(raw)]))[0].tolist()


def budget(m: int, share: float = SHARE, piece: int = PIECE) -> int:
    """Edits that an item of m words may have; all its pieces then have `piece` words or more."""
    return max(0, min(int(share * m), m // piece - 1))


def edit_distance(pattern: dict[int, int], m: int, text: list[int], most: int) -> tuple[int, int]:
    """Least edits that turn the pattern into a part of text, and where that part ends (Myers 1999).

    pattern maps each word to the bits of its places among the m words. Stops early at distance 0.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, where = full, 0, m, m, 0
    for j, word in enumerate(text):
        eq = pattern.get(word, 0)
        vertical = eq | down
        horizontal = (((eq & up) + up) ^ up) | eq
        plus = down | (full & ~(horizontal | up))
        minus = up & horizontal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up = minus | (full & ~(vertical | plus))
        down = plus & vertical
        if score < best:
            best, where = score, j + 1
            if not best:
                break
    return (best, where) if best <= most else (most + 1, 0)


class PieceIndex:
    """Pieces of a block of items, by the hash of their first words; items of equal words are one."""

    def __init__(self, items: list[tuple], share: float = SHARE, piece: int = PIECE):
        self.items = []
        entries: dict[int, list[tuple[int, int, int]]] = {}
        alike: dict[tuple, list] = {}
        for item_id, text in items:
            alike.setdefault(tuple(text_hashes(text or "")), []).append(item_id)
        for words, ids in alike.items():
            hashes, m = list(words), len(words)
            if not m:
                continue
            e = budget(m, share, piece)
            bits: dict[int, int] = {}
            for i, h in enumerate(hashes):
                bits[h] = bits.get(h, 0) | 1 << i
            cuts = [m * i // (e + 1) for i in range(e + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                width = min(piece, b - a)
                key = int(rolling(np.array(hashes[a : a + width], np.uint64), width)[0])
                entries.setdefault(width, []).append((key, len(self.items), a, b))
            self.items.append((ids, hashes, m, e, bits))
        self.by_width = {}
        for width, rows in entries.items():
            rows.sort()
            keys = np.array([r[0] for r in rows], np.uint64)
            self.by_width[width] = (keys, [r[1:] for r in rows])

    def matches(self, buf: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, item's place in the block, distance) of every item within its budget in a row's text."""
        hashes, firsts = word_hashes(buf, offsets)
        best: dict[tuple[int, int], int] = {}
        tried = set()
        for width, (keys, places) in self.by_width.items():
            runs = rolling(hashes, width)
            if not len(runs):
                continue
            at = np.searchsorted(keys, runs)
            hits = np.flatnonzero(keys[np.minimum(at, len(keys) - 1)] == runs)
            owners = np.searchsorted(firsts, hits, "right") - 1
            for p, k, doc in zip(hits.tolist(), at[hits].tolist(), owners.tolist(), strict=True):
                first, last = int(firsts[doc]), int(firsts[doc + 1])
                if p + width > last:
                    continue
                key = keys[k]
                while k < len(keys) and keys[k] == key:
                    item, a, b = places[k]
                    k += 1
                    _, words, m, e, bits = self.items[item]
                    if (doc, item, p - a) in tried or best.get((doc, item), m) == 0:
                        continue
                    if p + b - a > last or hashes[p : p + b - a].tolist() != words[a:b]:
                        continue
                    tried.add((doc, item, p - a))
                    window = hashes[max(first, p - a - e) : min(last, p - a + m + e)].tolist()
                    d, _ = edit_distance(bits, m, window, e)
                    if d <= e and d < best.get((doc, item), m + 1):
                        best[doc, item] = d
        return sorted((doc, item, d) for (doc, item), d in best.items())


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", most: int = ITEMS, most_bytes: int = ITEM_BYTES) -> Iterator[list[tuple]]:
    """The items in blocks of about `most` items and `most_bytes` bytes, each collected alone."""
    n, size = benchmark.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    parts = max(1, -(-n // most), -(-size // most_bytes))
    for i in range(parts):
        part = benchmark.select(item, text)
        part = part if parts == 1 else part.filter(F.pmod(F.xxhash64(text, item), F.lit(parts)) == i)
        yield [tuple(r) for r in part.collect()]


def find(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", share: float = SHARE, piece: int = PIECE, most: int = ITEMS) -> DataFrame:
    """A row (columns in keep, item_id, distance, n_item_words) for each item that appears in a row of docs."""
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    item_type = benchmark.schema["item_id"].dataType
    schema = ", ".join([*(f"`{k}` {fields[k]}" for k in keep), f"item_id {item_type.simpleString()}, distance int, n_item_words int"])
    arrow_type = to_arrow_type(item_type)
    out = None
    for block in blocks(benchmark, most=most):
        shared = docs.sparkSession.sparkContext.broadcast(PieceIndex(block, share, piece))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for a, b, buf, offsets in chunks(batch.column(len(keep))):
                    if found := index.matches(buf, offsets):
                        each = [(a + row, i, d, index.items[at][2]) for row, at, d in found for i in index.items[at][0]]
                        kept = [c.take(pa.array([x[0] for x in each])) for c in batch.columns[: len(keep)]]
                        yield pa.RecordBatch.from_arrays([*kept, pa.array([x[1] for x in each], arrow_type), pa.array([x[2] for x in each], pa.int32()), pa.array([x[3] for x in each], pa.int32())], [*keep, "item_id", "distance", "n_item_words"])

        part = docs.select(*(docs[k] for k in keep), docs[text].alias("__text")).mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", share: float = SHARE, piece: int = PIECE) -> DataFrame:
    """The rows of docs in which no item appears, all columns."""
    place = docs.columns.index(text)
    for block in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(PieceIndex(block, share, piece))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = np.ones(batch.num_rows, bool)
                for a, _, buf, offsets in chunks(batch.column(place)):
                    good[[a + r[0] for r in shared.value.matches(buf, offsets)]] = False
                yield batch.filter(pa.array(good))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
