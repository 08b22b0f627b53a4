import random
import re

import numpy as np

from sluice.llm import graph, similar


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            k = len(a & sets[j])
            if k and 100 * k >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def make(rng, longest):
    base = [[f"w{rng.randrange(30)}" for _ in range(rng.randint(1, longest))] for _ in range(25)]
    rows = []
    for d in range(220):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            k = rng.randrange(len(w))
            w[k : k + 1] = rng.choice([["n%d" % rng.randrange(3)], [w[k], "m"], [w[k]]])
        if rng.random() < 0.3:
            w += "a shared passage that many of the documents hold at their end without being alike".split()
        rows.append((d, (" ".join(w)).upper() if d % 7 == 0 else "\n ".join(w)))
    return rows


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, c string")
    key = lambda x: tuple((v is None, v) for v in x)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in similar.similar_components(docs).collect()), key=key)
    assert got == sorted(brute(rows), key=key)
    return docs


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    rows = make(rng, 90) + make(rng, 13) + [(500, None), (501, ""), (502, " \n"), (0, "w1"), (None, "w1"), (503, " ".join(f"z{i}" for i in range(9000))), (504, " ".join(f"z{i}" for i in range(9100)))]
    rows = [(i if d not in (0, None) and i > 3 else d, t) for i, (d, t) in enumerate(rows)]
    docs = check(spark, rows)
    kept = similar.keep_one(docs)
    assert kept.columns == docs.columns
    want = {(c if c is not None else ("null", d)) if n else ("empty", d) for d, n, c in brute(rows)}
    assert kept.count() == len(want)


def test_every_boundary(spark, monkeypatch):
    rows = make(random.Random(2), 12)
    for most in (0, 7, 10):
        monkeypatch.setattr(similar, "boundary", lambda sizes, most=most: most)
        check(spark, rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 99), (99, 98), (7, 7), (200, 300), (300, 201)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 98, 99: 98, 98: 98, 200: 200, 300: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_empty_table(spark):
    assert similar.similar_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_one_passage_in_thousands_of_components(spark, monkeypatch):
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(14))
    rows = [(d, f"{passage} u{d} v{d} x{d}") for d in range(1200)]
    rows += [(1200 + d, f"{passage} u{k} v{k} {rng.choice(['x', 'y'])}{k}") for d, k in enumerate(rng.choices(range(1200), k=200))]
    monkeypatch.setattr(similar, "PART", 100)
    monkeypatch.setattr(similar, "LOT", 64)
    check(spark, rows)


def test_sketches():
    rng = np.random.default_rng(3)
    for n, m, common in ((5, 5, 4), (300, 250, 240), (3000, 4000, 2900), (40000, 30000, 29000), (700, 700, 0)):
        draw = np.unique(rng.integers(0, 1 << 63, n + m, dtype=np.uint64))
        a, b = draw[:n], np.concatenate([draw[:common], draw[n : n + m - common]])
        whole, edges, folded = similar.sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        one, two = (whole[edges[i] : edges[i + 1]].tobytes() for i in (0, 1))
        apart = len(a) + len(b) - 2 * common
        assert similar.far(one, two) == similar.far(two, one) <= apart
        assert sum(int(np.bitwise_count(f.view(np.uint64)[0] ^ f.view(np.uint64)[1])) for f in folded) <= apart
        if not common:
            assert similar.far(one, two) > 0.5 * apart
