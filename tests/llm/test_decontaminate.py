import random
import re

import pytest

from sluice.llm import decontaminate as D


def levenshtein_in(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def split(t):
    return [w.lower() for w in re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", t or "")]


def test_distance():
    rng = random.Random(5)
    for _ in range(300):
        p = [rng.randrange(4) for _ in range(rng.randint(1, 90))]
        t = [rng.randrange(4) for _ in range(rng.randint(0, 120))]
        bits = {}
        for i, x in enumerate(p):
            bits[x] = bits.get(x, 0) | 1 << i
        assert D.edit_distance(bits, len(p), t, len(p))[0] == levenshtein_in(p, t)


@pytest.mark.parametrize("piece, most", [(D.PIECE, D.ITEMS), (1, D.ITEMS), (2, 3)])
def test_against_brute_force(spark, piece, most):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["Été", "naïve", "X"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([1, 3, 4, 7, 8, 12, 20, 35, 70, 130])] + [(90, None), (91, ""), (92, "!!"), (5, "w1 w2")]
    items.append((93, items[6][1].upper()))
    docs = []
    for d in range(120):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        if d % 2:
            item = split(rng.choice(items[3:10])[1])
            for _ in range(rng.randint(0, 8)):
                k = rng.randrange(len(item))
                item[k : k + 1] = rng.choice([[], ["new"], [item[k], "more"]]) if len(item) > 5 else [item[k]]
            w[len(w) // 2 : len(w) // 2] = item
        docs.append((d, (", " if d % 3 else "\n").join(w).upper() if d % 5 else " ".join(w), 7))
    docs += [(500, None, 7), (501, "", 7), (0, docs[0][1], 7), (502, " ".join(vocabulary * 300) + " " + items[8][1], 7)]
    want = []
    for d, t, _ in docs:
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        words = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", t)
        for i, x in items:
            p = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
            if p and (n := levenshtein_in(p, words)) <= D.budget(len(p), piece=piece):
                want.append((d, i, n, len(p)))
    frame = spark.createDataFrame(docs, "doc_id long, text string, item_id long")
    bench = spark.createDataFrame(items, f"item_id {'long' if piece > 1 else 'int'}, text string")
    got = sorted(tuple(r) for r in D.find(frame, bench, piece=piece, most=most).collect())
    assert got == sorted(want) and len(got) > 60
    kept = D.clean(frame, bench, piece=piece)
    assert kept.columns == frame.columns
    bad = {x[0] for x in want}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _, _ in docs if d not in bad)
    assert D.find(frame.limit(0), bench).collect() == [] and D.find(frame, bench.limit(0)).collect() == []
