import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sluice.llm import lm
from sluice.llm.common import Scratch, chunks

PATH = lm.default_vocabulary()


def tiny_model():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 5, lm.VOCABULARY)
    model = lm.Model(counts, counts // 2, 40, rng)
    model.p["near"] = rng.standard_normal(lm.STRIDE).astype(np.float32)
    return model


def slow_score(model, ids, starts):
    """One id at a time, straight from the definition."""
    p, total = model.p, 0.0
    before = [lm.END, *ids[:-1]]
    x = p["e"][model.cell[before]].astype(np.float64)
    for t, goal in enumerate(ids):
        if not starts[t]:
            continue
        low = max(0, t - lm.STRIDE + 1, (t // lm.STRIDE - 1) * lm.STRIDE)
        s = np.array([x[t] @ p["q"] @ (x[j] @ p["k"]) + p["near"][t - j] for j in range(low, t + 1)])
        a = np.exp(s - s.max())
        a /= a.sum()
        h = sum(w * (x[j] @ p["v"]) for w, j in zip(a, range(low, t + 1)))
        logits = np.concatenate([x[t], h]) @ p["u"] + p["c"]
        total += logits[model.classes[goal]] - np.log(np.exp(logits - logits.max()).sum()) - logits.max()
    return total


def part_of(texts):
    return [lm.Block(buf, offsets, PATH) for _, _, buf, offsets in chunks(pa.array(texts, pa.string()))][0]


def test_windows_score_each_token_once():
    rng = np.random.default_rng(1)
    part = part_of([" ".join(rng.choice(["the", "unbelievable", "cat", "zqxj"], n)) for n in (0, 1, 7, 15, 16, 40, 200)])
    ids, starts, first = part.sequence()
    for scale in (1, 40):  # large parameters give whole numbers too
        model = tiny_model()
        model.p = {k: v * scale for k, v in model.p.items()}
        want = [slow_score(model, ids[a:b].tolist(), starts[a:b]) for a, b in zip(first, first[1:])]
        for most in (2, 3, 512):
            got = model.class_scores(part, model.tables(), most)
            assert np.isfinite(got).all() and np.allclose(got, want, rtol=1e-2 if scale > 1 else 1e-3, atol=1e-2)


def test_gradients():
    rng = np.random.default_rng(2)
    model = tiny_model()
    before, target = rng.integers(0, 50, (3, lm.STRIDE)), rng.integers(-1, 50, (3, lm.STRIDE))
    target[2, 9:] = -1
    fresh = np.array([True, False, True])
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    _, g = model.gradients(before, target, fresh)
    dense = np.zeros_like(model.p["e"])
    np.add.at(dense, g["e"][0], g["e"][1])
    for name, grad in {**g, "e": dense}.items():
        flat = model.p[name].reshape(-1)
        for i in rng.choice(len(flat) if name != "e" else 50 * lm.SIZE, 5, replace=False):
            old, eps = flat[i], 1e-5
            flat[i] = old + eps
            up = model.gradients(before, target, fresh)[0]
            flat[i] = old - eps
            down = model.gradients(before, target, fresh)[0]
            flat[i] = old
            assert math.isclose((up - down) / (2 * eps), grad.reshape(-1)[i], rel_tol=1e-2, abs_tol=1e-5), name


def test_keys_and_values_are_not_copied():
    rng = np.random.default_rng(4)
    model = tiny_model()
    qkv = rng.standard_normal((4, lm.STRIDE, 3 * lm.SIZE)).astype(np.float32)
    qkv[0] = 0
    at = np.array([0, 5, lm.STRIDE, 2 * lm.STRIDE + 3])
    h, w, keys, values, _ = model.attended(qkv, np.array([True, False, True]), at, model.bias())
    assert np.shares_memory(keys, qkv) and np.shares_memory(values, qkv)
    flat = qkv[1:].reshape(-1, 3 * lm.SIZE)
    for i, t in enumerate(at):
        low = 2 * lm.STRIDE if t >= 2 * lm.STRIDE else max(0, t - lm.STRIDE + 1)  # the last row begins a text
        s = np.array([flat[t, : lm.SIZE] @ flat[j, lm.SIZE : 2 * lm.SIZE] + model.p["near"][t - j] for j in range(low, t + 1)], np.float64)
        a = np.exp(s - s.max())
        assert np.allclose(h[i], a @ flat[low : t + 1, 2 * lm.SIZE :] / a.sum(), rtol=1e-3, atol=1e-3)


def test_probabilities_sum_to_one():
    counts = np.array([5, 1, 1, 3, 2, 0])
    firsts = np.zeros(lm.VOCABULARY, np.int64)
    firsts[[3, 7, 9, lm.END]] = 5 + 1, 1 + 3, 0, 2
    model = lm.Model(firsts, firsts, 2, np.random.default_rng(0))
    classes = model.classes[[3, 3, 7, 7, lm.END, 9]]
    p = np.exp(model.within(classes, counts))
    assert math.isclose(p[0] + p[1] + model.unknown, 1) and math.isclose(p[2] + p[3] + model.unknown, 1) and math.isclose(p[4] + model.unknown, 1)
    assert p[5] == 1  # nothing is known of this class


def test_learners_are_averaged_in_groups(spark, monkeypatch):
    monkeypatch.setattr(lm, "FAN", 2)
    rows = spark.createDataFrame([(i, float(i + 1), [float(i), 1.0]) for i in range(5)], "learner long, weight double, p array<float>")
    with Scratch(spark) as work:
        got = lm.average(rows, 5, work)
    assert np.allclose(got, [sum(i * (i + 1) for i in range(5)) / 15, 1.0])


def test_held_out_score_beats_the_base(spark):
    got = lm.query(spark, "/root/testdata/sf0.01").groupBy("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens"), F.sum("n_known")).collect()
    for r in got:
        print(r)
        assert r[1] > r[2] + 0.1 * r[3]  # a tenth of a digit for each token


def test_rows(spark):
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text, 1.0) for r in source] + [(9000, None, 1.0), (9001, "", 1.0), (9002, "THE the\vThe", 1.0), (source[0].doc_id, source[0].text, 1.0), (None, "the", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    got = lm.score(docs).collect()
    assert len(got) == len(rows)
    import re
    import zlib

    word = re.compile(r"[^\x20\x09-\x0D]+")
    split = lambda t: [*word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), ""]
    training = lambda d: d is None or zlib.crc32(str(d).encode()) % 5 != 1
    counts = Counter(w for d, t, _ in rows if training(d) for w in split(t))
    total, distinct = sum(counts.values()), len(counts)
    want = {}
    for d, t, _ in rows:
        w = split(t)
        want[d] = (training(d), len(w), sum(counts[x] > 0 for x in w), total, sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w))
    for r in got:
        assert (r.training, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert math.isclose(r.base_score, want[r.doc_id][4], rel_tol=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
    assert lm.score(docs.limit(0)).collect() == []


def test_texts_are_cut_once(spark):
    """What is counted, learned and scored comes from the stored ids alone."""
    texts = ["THE the\vThe", "", None, "é ÉA\x0cB\tc 日本 語", "  a  b ", "x" * 300 + " y", "no\xa0break"]
    rows, _ = lm.dealt(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    frame = lm.coded(rows, PATH).orderBy("doc_id").toArrow()
    assert "text" not in frame.column_names and frame.column("doc_id").to_pylist() == list(range(len(texts)))
    coded = [lm.Coded(buf, offsets, PATH) for _, _, buf, offsets in chunks(frame.column("ids"))][0]
    part = part_of(texts)
    assert all((a == b).all() for a, b in zip(coded.sequence(), part.sequence(), strict=True))
    hashes, lead, owner = coded.words()
    assert len(set(hashes.tolist())) == len(part.hashes) and (np.bincount(owner, minlength=len(texts)) == np.diff(part.firsts)).all()
    assert len(set(zip(hashes.tolist(), part.of.tolist(), strict=True))) == len(part.hashes)
    assert (lead == part.ids[part.begin[:-1]][part.of]).all()


def test_bytes_that_are_not_utf8_are_cut_alike():
    found = [b"ab", b"\xff\xfe", b"unbelievable", b"ab"]
    piece, _ = lm.encoder(PATH)
    assert lm.cut(found, PATH) == [np.array(piece(b" " + w), np.uint16).tobytes() for w in found]


def test_gradients_by_embeddings_are_those_by_places(monkeypatch):
    rng = np.random.default_rng(5)
    model = tiny_model()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    for cells, goals in ((40, 0.5), (900, 0.9), (40, 0.0)):
        before = rng.integers(0, cells, (40, lm.STRIDE))
        goal = np.where(rng.random(before.shape) < goals, rng.integers(0, lm.CLASSES, before.shape), -1)
        fresh = rng.random(40) < 0.3
        fresh[0] = True
        found = []
        for few in (lm.CELLS, 0):
            monkeypatch.setattr(lm, "FEW", few)
            found.append(model.gradients(before, goal, fresh))
        (loss, g), (loss2, g2) = found
        assert math.isclose(loss, loss2) and (g["e"][0] == g2["e"][0]).all() and np.allclose(g["e"][1], g2["e"][1])
        assert (np.diff(g["e"][0]) > 0).all()  # each embedding once
        assert all(np.allclose(g[k], g2[k]) for k in g if k != "e")


def test_words_are_cut_together():
    raw = "the unbelievable zqxj 日本 a".encode()
    starts, ends, _ = lm.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert lm.listed(raw, starts, ends) == b" " + raw
    assert lm.listed(raw, starts[[3, 0]], ends[[3, 0]]) == " 日本 the".encode()
    assert lm.listed(raw, starts[:0], ends[:0]) == b""
    texts = [b"ab \xff\xfe ab", b"unbelievable cat", b""]
    buf, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = lm.Block(buf, offsets, PATH).sequence()[0].tolist()  # bytes that are not UTF-8
    piece, _ = lm.encoder(PATH)
    assert got == [x for t in texts for w in t.split() + [None] for x in (piece(b" " + w) if w else [lm.END])]


def test_blocks_count_their_own_words(spark, monkeypatch):
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    exact = lambda: {r.doc_id: (r.n_known, r.base_score) for r in lm.score(source).collect()}
    whole = exact()
    monkeypatch.setattr(lm, "BLOCK_BYTES", 20_000)
    assert lm.dealt(source)[1] > 3
    for k, (known, base) in exact().items():
        assert known == whole[k][0] and math.isclose(base, whole[k][1], rel_tol=1e-9)
