import random

from sluice.llm import lines


def split(line):
    return [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", line.lower()) if w]


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or min(len(a), len(b)) < lines.LEAST:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(rows):
    """Expected (text, n_lines, n_dropped) of rows in order of doc_id."""
    seen, out = [], []
    for _, text in rows:
        if text is None:
            out.append((None, 0, 0))
            continue
        kept, dropped = [], 0
        for line in text.split("\n"):
            w = split(line)
            hit = bool(w) and any(w == s or one_edit(w, s) for s in seen)
            dropped += hit
            if not hit:
                kept.append(line)
            if w:
                seen.append(w)
        out.append(("\n".join(kept), len(text.split("\n")), dropped))
    return out


def make(rng):
    base = [[f"w{rng.randrange(60)}" for _ in range(rng.randint(1, 16))] for _ in range(40)]
    rows = []
    for d in range(120):
        body = []
        for _ in range(rng.randint(0, 6)):
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 1, 2])):
                k = rng.randrange(len(w))
                w[k : k + 1] = rng.choice([["new%d" % rng.randrange(3)], [w[k], "more"], []])
                w = w or ["x"]
            body.append(rng.choice([" ", "  ", "\t"]).join(w).upper() if rng.random() < 0.2 else " ".join(w))
        rows.append((d, "\n".join(body)))
    return [*rows, (200, None), (201, ""), (202, "\n\n \t\n"), (203, " ".join(f"z{i}" for i in range(9000))), (204, " ".join(f"z{i}" for i in range(8999))), (205, " ".join(f"z{i}" if i != 4000 else "q" for i in range(9000)))]


def test_against_brute_force(spark):
    rows = make(random.Random(4))
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_lines int")
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in lines.dedup(docs.select("doc_id", "text")).collect()}
    assert [got[d] for d, _ in rows] == brute(rows)
    assert sum(x[2] for x in got.values()) > 60
    assert lines.dedup(docs.limit(0)).collect() == []


def test_long_and_short_variants_meet(spark, monkeypatch):
    monkeypatch.setattr(lines, "DIRECT", 10)
    monkeypatch.setattr(lines.variants, "__defaults__", (10,))
    rows = make(random.Random(9))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in lines.dedup(docs).collect()}
    assert [got[d] for d, _ in rows] == brute(rows)


def test_repeated_and_null_rows(spark):
    long = "one two three four five six seven eight nine"
    docs = spark.createDataFrame([(1, long), (1, long), (None, long + " ten"), (2, long + " ten\nkept")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text, r.n_dropped) for r in lines.dedup(docs).collect())
    assert got == [(0, long + " ten", 0), (1, "", 1), (1, "", 1), (2, "kept", 1)]
