"""Snapshots of logs that take in changed files alone."""

import json
import os
import random
import time

from sluice.sources.refresh import FoldedLog


def write(path, rows, mode="w"):
    with open(path, mode) as f:
        for k, at, action in rows:
            f.write(json.dumps({"k": k, "at": at, "action": action, "more": 1}) + "\n")
    stamp = time.time() + random.Random(os.path.getsize(path)).random()
    os.utime(path, (stamp, stamp))


def test_refresh(spark, tmp_path):
    logs = tmp_path / "logs"
    (logs / "deep").mkdir(parents=True)
    rows = {f: [(f"k{(i * 7) % 9}", i + 100 * n, f"{f}{i}") for i in range(20)] for n, f in enumerate(["a", "b", "c"])}
    files = {f: str(logs / ("deep" if f == "c" else "") / f"{f}.jsonl") for f in rows}
    for f, r in rows.items():
        write(files[f], r)
    log = FoldedLog(spark, str(logs), str(tmp_path / "snap"), "k string, at long, action string", ["k"], ["at"], ["action"])

    def state():
        want = {}
        for r in rows.values():
            for k, at, action in r:
                if k not in want or at > want[k][0]:
                    want[k] = (at, action)
        assert {r.k: (r.at, r.action) for r in log.read().collect()} == want

    short = lambda paths: sorted(p.rsplit("/", 1)[1] for p in paths)
    assert log.current() is None and log.is_stale()
    assert short(log.refresh()) == ["a.jsonl", "b.jsonl", "c.jsonl"]
    state()
    first = log.current()
    assert not log.is_stale() and log.refresh() == [] and log.current() == first

    more = [("k1", 999, "later"), ("new", 1, "n")]
    write(files["b"], more, "a")
    rows["b"] += more
    rows["d"] = [("k2", 5, "old news")]
    write(str(logs / "d.jsonl"), rows["d"])
    old = {r.k for r in log.read().collect()}
    assert log.is_stale() and short(log.refresh()) == ["b.jsonl", "d.jsonl"]
    state()
    assert "new" not in old and log.current() != first
    assert {r.k for r in spark.read.parquet(f"{first}/state").collect()} == old  # readers of the old version keep it

    rows["b"] = rows["b"][:3]
    write(files["b"], rows["b"])
    assert short(log.refresh()) == ["a.jsonl", "b.jsonl", "c.jsonl", "d.jsonl"]
    state()
    os.remove(files["a"])
    del rows["a"]
    assert short(log.refresh()) == ["b.jsonl", "c.jsonl", "d.jsonl"]
    state()
