import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from sluice.llm import suffix


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[p : p + length] for r in raws for p in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = [False] * len(r)
        for p in range(len(r) - length + 1):
            if seen[r[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_against_brute_force(spark):
    rng = random.Random(1)
    make = lambda n: "".join(rng.choice("abcé ") for _ in range(n))
    shared = [make(n) for n in (18, 20, 21, 25, 40, 90)]
    texts = [make(rng.randint(0, 60)) + rng.choice(shared)[rng.randint(0, 6) :][: rng.randint(10, 90)] + make(rng.randint(0, 30)) + rng.choice(["", rng.choice(shared)]) for _ in range(300)]
    texts += [None, "", "x" * 19, "y" * 20, "z" * 500, shared[5], shared[5], make(9000), "é" * 60 + shared[4], shared[4] + "z" * 21]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(0, texts[0], 1), (None, shared[3] + "tail", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, s int")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_removed, len(r.removed), r.kept_sha256) for r in suffix.dedup(docs, 20, 8).collect())
    want = sorted(((r[0] if r[0] is not None else -1), *b) for r, b in zip(rows, brute([r[1] for r in rows], 20)))
    assert got == want
    assert suffix.dedup(docs.limit(0), 20, 8).collect() == []


def test_runs_of_spans():
    """All spans of a buffer at once: runs that touch are one, but none goes on into the next text."""
    row, s, e = suffix.merged(np.array([1, 0, 0, 0, 2, 0]), np.array([30, 5, 0, 12, 60, 22]), np.array([60, 12, 6, 20, 61, 30]))
    assert list(zip(row.tolist(), s.tolist(), e.tolist())) == [(0, 0, 20), (0, 22, 30), (1, 30, 60), (2, 60, 61)]
    assert all(len(x) == 0 for x in suffix.merged(*[np.zeros(0, np.int64)] * 3))


def test_parts_of_ranges():
    pairs = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
    rows = [[{"lo": 0, "hi": 136}], None, [], [{"lo": 3, "hi": 9}, {"lo": 20, "hi": 22}], [{"lo": 7, "hi": 7}]]
    for column, kept in ((pa.array(rows, pairs), rows), (pa.array(rows, pairs).slice(2), rows[2:])):
        first, lo, hi = suffix.ranges(column)
        low, high = np.arange(len(kept)), np.array([21, 136, 136, 21, 136])[-len(kept) :]
        for step in (28, 6, 1):
            want = []
            for r, parents in enumerate(kept):
                for p in parents or ():
                    for x in range(p["lo"], p["hi"] + 1, step):
                        y = min(x + step, p["hi"] + 1) - 1
                        if x <= high[r] and y >= low[r]:
                            want.append((r, x, y))
            assert list(zip(*(x.tolist() for x in suffix.split(first, lo, hi, step, low, high)))) == want
