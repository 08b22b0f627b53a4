"""Reconciliation by sorted neighbours, against every pair."""

import os
import random

import pytest

from sluice.operators import reconcile as R


def brute(errors, outputs, key):
    want = {}
    for folder, name, k in errors:
        found = {}
        for f, other, o in outputs:
            if folder is None or f != folder or not name or not other or (key and o == k):
                continue
            n = len(os.path.commonprefix([name, other]))
            if n >= min(24, len(name), len(other)):
                found[o if key else other] = n
        top = max(found.values(), default=None)
        ids = [o for o, n in found.items() if n == top]
        want[folder, k if key else name] = (top, "unmatched" if not ids else "ambiguous" if len(ids) > 1 else "matched", ids[0] if len(ids) == 1 else None)
    return want


def names(rng, n):
    starts = ["", "a" * 24, "a" * 23, "b" * 40, "é" * 30, "ab"]
    return [rng.choice(starts) + "".join(rng.choice("ab日") for _ in range(rng.randint(0, 6))) + rng.choice(["", "", "x" * 50]) for _ in range(n)] + [None, "", "a", "ab", "ab"]


@pytest.mark.parametrize("seed", range(2))
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["f", "g", "g", "日", None]), n, i) for i, n in enumerate(names(rng, 150))]
    more = [(rng.choice(["f", "g", "h"]), n, 1000 + i) for i, n in enumerate(names(rng, 40))]
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(rng.choice([5, 23])))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        frame = lambda x: spark.createDataFrame(x, "folder string, name string, k long")
        both, some = frame(rows), frame(more)
        for errors, outputs, e, o in ((both, both, rows, rows), (some, both, more, rows), (both, some.union(frame(rows[:30])), rows, more + rows[:30])):
            got = {(r.folder, r.wanted): (r.score, r.status, r.found) for r in R.reconciled(errors, outputs, key="k").collect()}
            assert got == brute(e, o, True)
        got = {(r.folder, r.wanted): (r.score, r.status, r.found) for r in R.reconciled(some, both).collect()}
        assert got == brute(more, rows, False)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])


def test_one_start_shared_by_all(spark):
    """Many rows of one folder and one start: neighbours only, in several ranges."""
    rows = [("f", "s" * 2000 + f"{i * 7919 % 20011:06d}", i) for i in range(6000)] + [("f", "s" * 2000 + "zz", 9000 + i) for i in range(3000)]
    frame = spark.createDataFrame(rows, "folder string, name string, k long").repartition(5)
    got = {r.wanted: (r.score, r.status, r.found) for r in R.reconciled(frame, frame, key="k").collect()}
    assert len(got) == 9000 and all(got[9000 + i] == (2002, "ambiguous", None) for i in range(0, 3000, 500))
    texts = sorted((t, i) for _, t, i in rows if i < 9000)
    for at in range(1, 5999, 271):
        (a, _), (t, i), (b, _) = texts[at - 1 : at + 2]
        assert got[i][0] == max(len(os.path.commonprefix([t, x])) for x in (a, b))


def test_empty(spark):
    none = spark.createDataFrame([], "folder string, name string, k long")
    assert R.reconciled(none, none, key="k").collect() == []
