import hashlib
import math

import duckdb
import numpy as np
import pytest

from sluice.llm import codes


def brute(rows):
    """(vec_id, label, vector) rows by the definition, in Python integers; {(id, vector): (code, error)}, digest."""
    kept = [(i, lab, [math.floor(4096 * x) for x in v]) for i, lab, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], None
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    n = len(kept[0][2])
    edges = [p * n // 8 for p in range(9)]
    cut = lambda v: [v[a:b] for a, b in zip(edges, edges[1:])]
    books = [[cut(v)[p] for _, _, v in kept[:16]] for p in range(8)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for turn in range(7):
        near = [[min((far(part, e), k) for k, e in enumerate(books[p])) for p, part in enumerate(cut(v))] for _, _, v in kept]
        if turn == 6:
            break
        for p in range(8):
            for k in range(len(books[p])):
                mine = [cut(v)[p] for (_, _, v), at in zip(kept, near) if at[p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    said = [(i, lab, "".join(f"{k:02x}" for _, k in at), sum(d for d, _ in at)) for (i, lab, _), at in zip(kept, near)]
    return said, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def rows_of(rng, n, dims, spread):
    centres = rng.normal(size=(5, dims))
    return [(i, int(rng.integers(3)) or None, np.float32(centres[rng.integers(5)] * spread + rng.normal(size=dims) * 0.1).tolist()) for i in range(n)]


@pytest.mark.parametrize(("n", "dims", "spread"), [(300, 16, 1.0), (120, 64, 0.0), (40, 11, 3.0), (7, 8, 1.0)])
def test_against_brute_force(spark, n, dims, spread):
    rng = np.random.default_rng(n)
    rows = rows_of(rng, n, dims, spread)
    bad = [None, [], [None] * dims, [float("nan")] * dims, [1.0] * (dims - 1) + [float("inf")]]
    rows += [(900 + i, 1, v) for i, v in enumerate(bad)] + [rows[3]] * 5 + [(None, None, rows[4][2]), (None, 2, rows[5][2]), (3, 1, rows[6][2])]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, label int, embedding array<float>, code string").repartition(3)
    coded, books = codes.train(docs)
    said, digest = brute(rows)
    assert codes.digest(books) == digest
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, coded.collect()), key=key) == sorted(said, key=key)
    totals = {}
    for _, lab, _, e in said:
        totals[lab] = totals.get(lab, 0) + e
    assert all(r.label_error == totals[r.label] for r in codes.label_sums(coded).collect())


def test_many_labels_meet_by_salt(spark, monkeypatch):
    monkeypatch.setattr(codes, "BROADCAST_LABELS", 1)
    coded, _ = codes.train(spark.createDataFrame(rows_of(np.random.default_rng(1), 50, 8, 1.0), "vec_id long, label int, embedding array<float>"))
    totals = {}
    for r in coded.collect():
        totals[r.label] = totals.get(r.label, 0) + r.error
    found = codes.label_sums(coded).collect()
    assert len(found) == 50 and all(r.label_error == totals[r.label] for r in found)


def test_ties_and_equal_entries():
    """Equal entries, and parts half way between two: the lower index, in every round and for any grouping."""
    rng = np.random.default_rng(5)
    x = rng.integers(-3, 4, size=(500, 2))
    for _ in range(30):
        book = rng.integers(-3, 4, size=(16, 2))
        of, own, bounds, before = rng.integers(0, 4, 16), np.zeros(len(x), int), np.zeros((len(x), 4)), None
        for _ in range(6):
            far = ((x[:, None] - book[None]) ** 2).sum(2)
            own, bounds, best = codes.assign(x, own, bounds, book, before, of)
            assert (own == far.argmin(1)).all() and (best == far.min(1)).all()
            others = np.where(np.arange(16)[None] == own[:, None], np.inf, np.sqrt(far))
            for g in range(4):
                if (of == g).any():
                    assert (bounds[:, g] <= others[:, of == g].min(1) + 1e-9).all()
            before, book = book, book + rng.integers(-1, 2, size=book.shape)


def test_bounds_spare_scans():
    rng = np.random.default_rng(2)
    book = rng.integers(-1000, 1000, size=(16, 8))
    x = book[rng.integers(16, size=2000)] + rng.integers(-20, 20, size=(2000, 8))
    of = codes.grouped(book)
    own, bounds, _ = codes.assign(x, np.zeros(2000, int), np.zeros((2000, 4)), book, None, of)
    best = np.sqrt(((x - book[own]) ** 2).sum(1))
    assert (bounds > best[:, None]).mean() > 0.9


def test_empty_and_sql(spark):
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    coded, books = codes.train(empty)
    assert coded.collect() == [] and codes.label_sums(coded).collect() == [] and codes.digest(books)
    sf = "/root/testdata/sf0.001"
    duckdb.sql(f"create or replace view embeddings as select * from '{sf}/embeddings.parquet'")
    theirs = duckdb.sql(codes.SQL)
    ours = codes.query(spark, sf).select(*theirs.columns).collect()
    assert sorted(map(tuple, ours)) == sorted(theirs.fetchall())
