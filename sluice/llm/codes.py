"""Product codes of vectors: one codebook for each part of a vector, trained by Yinyang Lloyd rounds.

Components become integers, so distances are exact and equal on every machine. Each part of a vector has a codebook whose
entries are put into GROUPS groups by their first places. A vector's part keeps one lower bound for each group: no entry of
the group, its own entry aside, is nearer than that. After a round the bound falls by the farthest move within the group. The
distance to the own entry is taken anew; only groups whose bound does not exceed it are scanned. Bounds are floats that are
rounded down; every decision is between integer distances, a tie going to the lower index, and a group whose bound just
reaches the own distance is scanned, as an entry of lower index may tie.

A round is one pass over the stored state (integers, codes, bounds) that writes the next state; each batch adds one row
of its sums and counts, which are a few hundred numbers, and those rows are summed by Spark. Only codebooks reach the
driver (ENTRIES x length integers). Rows are never moved by key, so equal vectors, however many, stay where they are.

Rows whose vector is null or empty, or holds null, NaN, an infinite number or one of MOST or more (where integer distances
could overflow for 128 components) are dropped, and so are those whose length is not that of the vector of smallest id. Fewer than ENTRIES
vectors give as many entries. A null id comes after all others; among rows of one id the least vector is first. Lengths
that PARTS does not divide are cut as evenly as can be. Repeated rows each yield a row; an empty table gives none. Other
columns are left out, so their names never clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, delete, stored, table

NAME = "op12_vector_codes"
PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
GROUPS = 4
MOST = 32768
FAR = np.iinfo(np.int64).max
#: Up to so many labels, their sums are broadcast; beyond, rows and sums meet by label and one of SALTS numbers.
BROADCAST_LABELS, SALTS = 100_000, 64

Codebooks = list[np.ndarray]  # of each part: entries x length


def cuts(length: int, parts: int = PARTS) -> list[int]:
    return [p * length // parts for p in range(parts + 1)]


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null for a vector that is dropped."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= MOST)
    made = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("int"))
    return F.when((F.size(vector) > 0) & ~F.exists(vector, bad), made)


def grouped(entries: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """A group for each entry: a few Lloyd rounds over the entries themselves. Which one it is never changes a result."""
    n = len(entries)
    centres = entries[np.linspace(0, n - 1, min(groups, n)).astype(int)].astype(float)
    for _ in range(5):
        near = ((entries[:, None, :] - centres[None]) ** 2).sum(2).argmin(1)
        for g in range(len(centres)):
            if (near == g).any():
                centres[g] = entries[near == g].mean(0)
    return near


def assign(x: np.ndarray, own: np.ndarray, bounds: np.ndarray, book: np.ndarray, before: np.ndarray | None, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry, bounds and exact squared distance of each row of one part.

    own: the entries of the last round, found in the codebook `before` (None in the first round, when all groups are scanned).
    """
    groups = [np.flatnonzero(of == g) for g in range(bounds.shape[1])]
    best = ((x - book[own]) ** 2).sum(1)
    if before is None:
        scan = np.ones(bounds.shape, bool)
    else:
        moved = np.sqrt(((book - before) ** 2).sum(1).astype(float))
        drift = np.array([moved[g].max() if len(g) else 0.0 for g in groups])
        bounds = bounds - drift * (1 + 1e-9) - 1e-6
        scan = bounds <= np.sqrt(best.astype(float))[:, None] * (1 + 1e-9) + 1e-6
    least, second = np.full(bounds.shape, FAR), np.full(bounds.shape, FAR)
    entry = np.full(bounds.shape, -1)
    now, nearest = own.copy(), best.copy()
    for g, members in enumerate(groups):
        which = np.flatnonzero(scan[:, g]) if len(members) else []
        if not len(which):
            continue
        far = ((x[which][:, None, :] - book[members][None]) ** 2).sum(2)
        at, rows = far.argmin(1), np.arange(len(which))  # members ascend: of equal distances the lower index
        least[which, g], entry[which, g] = far[rows, at], members[at]
        far[rows, at] = FAR
        second[which, g] = far.min(1)
        better = (least[:, g] < nearest) | ((least[:, g] == nearest) & (entry[:, g] < now) & (entry[:, g] >= 0))
        now, nearest = np.where(better, entry[:, g], now), np.where(better, least[:, g], nearest)
    # a bound leaves the own entry out: in its group, which it leads, the second counts
    bounds = np.where(scan, np.sqrt(np.where(entry == now[:, None], second, least).astype(float)), bounds)
    left = np.flatnonzero(now != own)  # and the entry of the last round is in again
    bounds[left, of[own[left]]] = np.minimum(bounds[left, of[own[left]]], np.sqrt(best[left].astype(float)))
    return now, bounds, nearest


#: Beside id and label. `sums` is set in the rows of batches, and in them alone.
STATE = "x array<int>, codes binary, bounds array<float>, error long, sums array<long>"


def _lists(values: np.ndarray, size: int, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, size), pa.int32()), pa.array(values, kind))


def _round(state: DataFrame, books: Codebooks, before: Codebooks | None, of: list[np.ndarray]) -> DataFrame:
    """The next state; one row of each batch has `sums` alone: of each part and entry the count and the sum of each component."""
    edges = np.concatenate([[0], np.cumsum([b.shape[1] for b in books])])
    parts, entries = len(books), len(books[0])
    kinds = {"codes": pa.binary(), "bounds": pa.list_(pa.float32()), "error": pa.int64(), "sums": pa.list_(pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            schema = pa.schema([(f.name, kinds.get(f.name, f.type)) for f in batch.schema])
            x = batch.column("x").flatten().to_numpy().reshape(n, edges[-1]).astype(np.int64)
            if before is None:
                codes, bounds = np.zeros((n, parts), np.int64), np.zeros((n, parts, GROUPS))
            else:
                codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
                bounds = batch.column("bounds").flatten().to_numpy().reshape(n, parts, GROUPS).astype(float)
            error, sums = np.zeros(n, np.int64), []
            for p in range(parts):
                part = x[:, edges[p] : edges[p + 1]]
                codes[:, p], bounds[:, p], distance = assign(part, codes[:, p], bounds[:, p], books[p], before[p] if before else None, of[p])
                error += distance
                total = np.zeros((entries, part.shape[1]), np.int64)
                np.add.at(total, codes[:, p], part)
                sums.append(np.column_stack([np.bincount(codes[:, p], minlength=entries), total]).ravel())
            low = np.nextafter(bounds.astype(np.float32), np.float32(-np.inf)).ravel()
            made = {"codes": pa.array([c.tobytes() for c in codes.astype(np.uint8)], pa.binary()), "bounds": _lists(low, parts * GROUPS, pa.float32()), "error": pa.array(error), "sums": pa.nulls(n, kinds["sums"])}
            yield pa.RecordBatch.from_arrays([made.get(f.name, batch.column(f.name)) for f in schema], schema=schema)
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(sums)], f.type) if f.name == "sums" else pa.nulls(1, f.type) for f in schema], schema=schema)

    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in state.schema if f.name in ("id", "label")]
    return state.mapInArrow(run, ", ".join([*own, STATE]))


def _updated(state: DataFrame, books: Codebooks) -> Codebooks:
    """Componentwise floor(sum / count) of the parts of each entry; unused entries stay."""
    numbers = state.filter("sums is not null").select(F.posexplode("sums").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(sum(b.size + len(b) for b in books), np.int64)
    for r in numbers:
        flat[r["at"]] = r["v"]
    out, at = [], 0
    for b in books:
        block = flat[at : at + b.size + len(b)].reshape(len(b), -1)
        at += block.size
        used = block[:, :1] > 0
        out.append(np.where(used, block[:, 1:] // np.maximum(block[:, :1], 1), b))
    return out


def digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(int(v)) for b in books for v in b.ravel()).encode()).hexdigest()


def train(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str | None = "label", rounds: int = ROUNDS, entries: int = ENTRIES, parts: int = PARTS) -> tuple[DataFrame, Codebooks]:
    """(key, label, code, error) of every kept row, stored; and the codebooks (None if no row is kept)."""
    spark = vectors.sparkSession
    other = F.col(label) if label else F.lit(None).cast("int")
    rows = vectors.select(F.col(key).alias("id"), other.alias("label"), whole_numbers(F.col(vector)).alias("x")).filter("x is not null")
    first = rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(1).select(F.size("x")).collect()
    if not first:
        none = rows.select(F.col("id").alias(key), F.col("label").alias("label"), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return none, []
    rows = rows.filter(F.size("x") == first[0][0])
    start = np.array([r["x"] for r in rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).select("x").collect()], np.int64)
    edges = cuts(first[0][0], parts)
    books = [start[:, a:b] for a, b in zip(edges, edges[1:], strict=False)]
    of = [grouped(b) for b in books]
    null = {"codes": "binary", "bounds": "array<float>", "error": "long", "sums": "array<long>"}
    state, before = rows.withColumns({c: F.lit(None).cast(t) for c, t in null.items()}), None
    for r in range(rounds + 1):
        now = stored(_round(state, books, before, of))
        if r:
            delete(state)
        if r < rounds:
            before, books = books, _updated(now, books)
        state = now.filter("sums is null")
        state.stored_at = now.stored_at
    with Scratch(spark) as work:
        work.frames.append(state)
        out = stored(state.select(F.col("id").alias(key), "label", F.lower(F.hex("codes")).alias("code"), "error"))
    return out, books


def label_sums(coded: DataFrame) -> DataFrame:
    """coded with label_error: the errors of all rows of its label, nulls together. A hot label's rows stay spread."""
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    same = F.col("label").eqNullSafe(F.col("__label"))
    named = sums.withColumnRenamed("label", "__label")
    if sums.count() <= BROADCAST_LABELS:
        return coded.join(F.broadcast(named), same).drop("__label")
    salted = named.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = coded.withColumn("__own", F.pmod(F.xxhash64("code", "error"), F.lit(SALTS)).cast("int"))
    return own.join(salted, same & (F.col("__own") == F.col("__salt"))).drop("__label", "__salt", "__own")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = train(table(spark, sf_dir, "embeddings"))
    found = label_sums(coded)
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The rounds as DuckDB SQL over rows of one component each; `best` holds a distance and its entry in one number."""
    k = ENTRIES
    steps = [
        f"""WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS row, vec_id, label, v FROM (
          SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
          WHERE len(embedding) > 0 AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0)),
        parts AS MATERIALIZED (SELECT row, (i - 1) // (len(v) // {PARTS}) AS part, (i - 1) % (len(v) // {PARTS}) AS place, v[i] AS x FROM kept, unnest(range(1, len(v) + 1)) AS u(i)),
        book0 AS MATERIALIZED (SELECT part, row - 1 AS entry, place, x FROM parts WHERE row <= {k})"""
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"""near{r} AS MATERIALIZED (SELECT row, part, min(d * {k} + entry) % {k} AS entry, min(d * {k} + entry) // {k} AS d
          FROM (SELECT p.row, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS d FROM parts p JOIN book{r} b USING (part, place) GROUP BY ALL) GROUP BY ALL)""")
        if r < ROUNDS:
            steps.append(f"""sum{r} AS MATERIALIZED (SELECT part, entry, place, sum(x) AS s, count(*) AS c FROM parts JOIN near{r} USING (row, part) GROUP BY ALL),
        book{r + 1} AS MATERIALIZED (SELECT part, entry, place, CASE WHEN c IS NULL THEN x ELSE CAST((s - (s % c + c) % c) // c AS BIGINT) END AS x
          FROM book{r} LEFT JOIN sum{r} USING (part, entry, place))""")
    steps.append(f"""said AS (SELECT row, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY row),
        books AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) AS h FROM book{ROUNDS})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
        FROM said JOIN kept USING (row), books""")
    return ",\n".join(steps)


SQL = _sql()
