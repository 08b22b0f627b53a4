"""Folds, ordinals and upserts against plain Python models and hand-made cases."""

import random

from pyspark.sql import functions as F

from sluice.operators import logs, relational as R


def fold(events):
    latest, resets = {}, {}
    for key, action, has, value in events:
        if action == "reset":
            latest.pop(key, None)
            resets[key] = action
            continue
        old = latest.get(key)
        carried = value if has else (old[1] if old and old[1] else None)
        latest[key] = (action, carried)
        resets.pop(key, None)
    return latest, resets


def test_fold_equals_the_sequential_model(spark):
    rng = random.Random(6)
    events = [(rng.randrange(300), rng.choice(["accept", "comment", "block", "reset"]), rng.random() < 0.4, rng.choice([None, 1, 2])) for _ in range(3000)]
    rows = spark.createDataFrame([(i, *e) for i, e in enumerate(events)], "seq long, key long, action string, has boolean, value int")
    got = logs.fold_with_reset(rows, "key", ["seq"], "action", "reset", ("value", F.col("has"))).collect()
    latest, resets = fold(events)
    assert {r.key: (r.action, r.carried) for r in got if r.state == "latest"} == latest
    assert {r.key for r in got if r.state == "reset"} == set(resets)


def test_ordinals(spark):
    rng = random.Random(3)
    rows = [(y, c, rng.choice([None, None, rng.randrange(1, 9)])) for y in range(40) for c in range(rng.randint(1, 7))]
    want, last = {}, {}
    for y, c, e in rows:
        n = last.get(y, 0) + 1
        last[y] = want[y, c] = e if e is not None and e >= n else n
    got = logs.ordinals(spark.createDataFrame(rows, "y int, c int, e int"), "y", ["c"], "e").collect()
    assert {(r.y, r.c): r.ordinal for r in got} == want


def test_upsert_overwrites_with_null(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, n int")
    source = spark.createDataFrame([(2, None, 5), (3, "c", None)], "k int, v string, n int")
    assert sorted(map(tuple, R.upsert(target, source, ["k"]).collect())) == [(1, "a", 1), (2, None, 5), (3, "c", None)]
    assert sorted(map(tuple, R.insert_ignore(target, source, ["k"]).collect()))[:2] == [(1, "a", 1), (2, "b", 2)]


def test_guarded_int_and_limits(spark):
    rows = spark.createDataFrame([("12",), (" +12 ",), ("",), (None,), ("1a",)], "x string")
    assert [r[0] for r in rows.select(R.guarded_int(F.col("x"))).collect()] == [12, 0, 0, 0, 0]
    assert [R.clamp_limit(x) for x in (None, "x", 0, -3, 5000, "7")] == [500, 500, 500, 1, 1000, 7]


def test_search_is_literal(spark):
    rows = spark.createDataFrame([("100% sure",), ("sure",)], "t string")
    assert [r.t for r in rows.filter(R.contains_text("%", "t")).collect()] == ["100% sure"]
