"""Merges into stored tables against their DataFrame forms; running values in ranges against a plain loop."""

import os
import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import relational as R
from sluice.operators.logs import corrected_actions, ordinals
from sluice.operators.running import running
from sluice.sources.merge import StoredTable

SCHEMA = "grp string, id long, value string"


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def old_rows():
    return [(f"g{i % 7}" if i % 11 else None, i, f"v{i}") for i in range(300)]


@pytest.fixture
def table(spark, tmp_path):
    def made(by, name):
        return StoredTable(spark, str(tmp_path / name), by, buckets=16).create(spark.createDataFrame(old_rows(), SCHEMA))

    return made


def test_upsert_and_ignore_leave_other_buckets_alone(spark, table):
    source = spark.createDataFrame([("new", 5, None), ("new", 17, "x"), (None, 900, "y")], SCHEMA)
    for name, form, call in (("u", lambda t: R.upsert(t, source, ["id"]), lambda t: t.upsert(source, ["id"])), ("i", lambda t: R.insert_ignore(t, source, ["id"]), lambda t: t.insert_ignore(source, ["id"]))):
        t = table(["id"], name)
        before, want = files(t.path), rows(form(spark.createDataFrame(old_rows(), SCHEMA)))
        touched = call(t)
        assert 1 <= len(touched) <= 3 and rows(t.read()) == want
        after = files(t.path)
        same = [f for f in before if not any(f"__bucket_of_16={b}/" in f for b in touched)]
        assert len(same) >= 10 and all(after[f] == before[f] for f in same)
        assert not any(f in after for f in before if f not in same)


def test_scoped_replace_and_mirror(spark, table):
    scope = spark.createDataFrame([("g1",), ("g2",), ("none",)], "grp string")
    new = spark.createDataFrame([("g1", 1000, "n")], SCHEMA)
    t = table(["grp"], "s")
    want = rows(R.replace_scope(spark.createDataFrame(old_rows(), SCHEMA), scope, new, ["grp"]))
    t.replace_scope(scope, new, ["grp"])
    assert rows(t.read()) == want
    loaded = spark.createDataFrame([("g3", 3, "a"), ("g3", 10, "b")], SCHEMA)
    t = table(["grp"], "m")
    want = rows(R.mirror_delete(spark.createDataFrame(old_rows(), SCHEMA), loaded, "grp", ["id"]))
    t.mirror_delete(loaded, "grp", ["id"])
    assert rows(t.read()) == want


def test_a_bucket_that_ends_empty_goes(spark, tmp_path):
    t = StoredTable(spark, str(tmp_path / "e"), ["grp"], 8).create(spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], SCHEMA))
    t.replace_scope(spark.createDataFrame([("a",)], "grp string"), spark.createDataFrame([], SCHEMA), ["grp"])
    assert rows(t.read()) == [("b", 2, "y")] and len(files(t.path)) == 1
    assert t.upsert(spark.createDataFrame([], SCHEMA), ["grp"]) == []
    with pytest.raises(ValueError, match="share a bucket"):
        t.upsert(spark.createDataFrame([("a", 1, "z")], SCHEMA), ["id"])


def test_running_values(spark):
    rng = random.Random(2)
    data = [("hot" if i % 2 else rng.choice(["a", "b", None]), rng.randint(0, 400), rng.choice([None, 1, 2, 3]), i) for i in range(900)]
    frame = spark.createDataFrame(data, "k string, o int, v int, i int").repartition(5)
    for before in (False, True):
        got = {r.i: r for r in running(frame, ["k"], [F.col("o"), F.col("i")], counts=["n"], greatest={"top": F.col("v")}, last={"now": F.col("v")}, before=before).collect()}
        state = {}
        for k, o, v, i in sorted(data, key=lambda r: (r[1], r[3])):
            n, top, now = state.get(k, (0, None, None))
            after = (n + 1, v if top is None else top if v is None else max(top, v), now if v is None else v)
            want = (after[0], top, now) if before else after
            assert (got[i].n, got[i].top, got[i].now) == want
            state[k] = after
    plan = running(frame, ["k"], [F.col("o")], counts=["n"])
    assert plan.count() == 900 and running(frame.limit(0), ["k"], [F.col("o")], counts=["n"]).collect() == []


def test_ordinals_and_actions_of_a_hot_key(spark):
    rng = random.Random(5)
    data = [("hot" if i % 3 else f"k{i % 10}", i, rng.choice([None, None, rng.randint(1, 60)])) for i in range(400)]
    got = {r.c: r.ordinal for r in ordinals(spark.createDataFrame(data, "g string, c int, e int"), "g", ["c"], "e").collect()}
    used = {}
    for g, c, e in data:
        n = used.get(g, 0) + 1
        used[g] = e if e is not None and e >= n else n
        assert got[c] == used[g]
    events = [("hot", i, rng.choice(["accept", "block", "reset", "comment", "fix", "fix"])) for i in range(300)]
    frame = spark.createDataFrame(events, "k string, t int, action string")
    got = {r.t: r.action for r in corrected_actions(frame, "k", ["t"], "action", F.col("action") == "fix", "reset").collect()}
    now = None
    for _, t, a in events:
        assert got[t] == ((now if now in ("accept", "block", "comment") else "reviewed") if a == "fix" else a)
        now = now if a == "fix" else a


def test_paths_under_folders(spark):
    left = spark.createDataFrame([(1, "a/b/c"), (2, "a/bc/d"), (3, "a/b"), (4, "/".join("deep" for _ in range(40))), (5, None), (6, ""), (7, "a/b/"), (8, "x_y/z")], "i int, path string")
    right = spark.createDataFrame([(1, "a/b", None), (2, None, "a/b"), (3, None, "/".join(["deep"] * 39)), (4, "", ""), (5, "a/b", "a"), (6, None, "x%y"), (7, None, "x.y")], "j int, exact string, folder string")
    got = sorted(map(tuple, R.path_join(left, right, "path", "exact", "folder", ["i", "j"]).collect()))
    assert got == [(1, 2), (1, 5), (2, 5), (3, 1), (3, 5), (4, 3), (6, 4), (7, 2), (7, 5)]
    plan = R.path_join(left, right, "path", "exact", "folder", ["i", "j"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_paths_under_a_folder_that_many_lists_name(spark):
    """Pairs of keys with one row each are not moved to be made distinct; keys with several rows still give each pair once."""
    files = [(i, f"top/{i % 7}/{i}") for i in range(2300)] + [(5, "top/x/5"), (None, "top/x/none"), (None, "top/y")]
    lists = [(j, f"top/0/{j}" if j % 2 else None, "top" if j % 3 == 0 else "top/0" if j % 3 == 1 else None) for j in range(3200)] + [(3, "top/3/3", "top/3"), (None, None, "top/x")]
    left, right = spark.createDataFrame(files, "i int, path string"), spark.createDataFrame(lists, "j int, exact string, folder string")
    got = R.path_join(left, right, "path", "exact", "folder", ["i", "j"])
    counts = got.groupBy("i").count().collect()
    known = {}
    for j, exact, folder in lists:
        for name in (exact and "=" + exact, folder and "/" + folder):
            known.setdefault(name, set()).add(j)
    want = {}
    for i, path in files:
        parts = path.split("/")
        names = ["=" + path, *("/" + "/".join(parts[:n]) for n in range(1, len(parts)))]
        want.setdefault(i, set()).update(*(known.get(n, ()) for n in names))
    assert sorted(map(tuple, counts), key=str) == sorted(((i, len(js)) for i, js in want.items() if js), key=str)
    some = [0, 5, 7, 700]
    assert {i: sorted(r.j for r in got.filter(F.col("i") == i).select("j").collect() if r.j is not None) for i in some} == {i: sorted(j for j in want[i] if j is not None) for i in some}
    assert got._jdf.queryExecution().optimizedPlan().toString().startswith("Union")
