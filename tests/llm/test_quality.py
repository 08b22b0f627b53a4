import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from sluice.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    hit = {j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


TEXTS = ["", None, " \n\t ", "a b c d e f g h a b c d e f g h i", "x\nx\n\nx y\r\nx\n", "é# ñ|*\n é#", "one " * 40, "\n\n", "日本 語\v日本", "end\n", "a\nb\na"]


def test_features():
    import pyarrow as pa

    texts = [*TEXTS, *(" ".join(np.random.default_rng(i).choice(["u", "v", "w"], 60)) + "\n" * (i % 3) for i in range(20))]
    from sluice.llm.common import chunks

    for most in (1, 40, 1 << 20):
        got = []
        for _, _, buf, offsets in chunks(pa.array(texts), most):
            f = quality.features(buf, offsets, np.zeros(quality.BUCKETS))
            got += list(zip(*(f[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))))
        assert got == [brute(t) for t in texts]


def test_verdicts(spark):
    good = "the rain in spain falls mainly on the plain and then it stops for a while before it rains again today"
    bad = " ".join(f"zz{i} !!" for i in range(20))
    docs = spark.createDataFrame([(i, good + f" w{i % 5}", "x") for i in range(60)] + [(100 + i, bad + f" q{i}", "x") for i in range(5)] + [(200, None, "x"), (None, good, "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(100, 0, 0), (None, 1, 0), (999, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    assert len(got) == 67
    assert not any(got[100 + i].kept for i in range(5)) and not got[200].kept and got[200].base_failed
    assert sum(got[i].kept for i in range(60)) >= 58
    assert all(r.kept or r.base_failed for r in quality.judge(docs, labels.filter(F.lit(False))).collect())
    assert quality.judge(docs.limit(0), labels).collect() == []


def test_threshold_weighs_toxic_rows(spark):
    rng = np.random.default_rng(3)
    word = np.array([f"w{i}" for i in range(400)])
    text = lambda n, slurs: " ".join(rng.permutation([*rng.choice(word, n - slurs), *rng.choice(["idiot", "moron", "scum"], slurs)]))
    rows = [(i, text(120, 0)) for i in range(600)] + [(1000 + i, text(120, 6)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)] + [(1000 + i, 1, 1) for i in range(150)], "doc_id long, quality int, toxic int")
    judged = quality.judge(docs, labels).cache()
    kept = {r.doc_id for r in judged.filter("kept").collect()}
    share = lambda ids: sum(i in kept for i in ids) / len(ids)
    assert share(range(1000, 1150)) < 0.1 and share(range(1150, 1300)) < 0.1
    # labelled and unlabelled documents of one kind fare alike: no document vouches for itself
    assert share(range(300)) > 0.85 and abs(share(range(300)) - share(range(300, 600))) < 0.1
    found = {r.label: r for r in quality.kept_of_labels(judged, labels).collect()}
    assert (found["trusted"].n, found["toxic"].n) == (300, 150)


def test_threshold_is_the_least_sum_of_both_errors(spark):
    rows = [(x / 10, True, False) for x in (1, 5, 6, 7, 8)] + [(x / 10, False, True) for x in (0, 2, 3, 6)] + [(9.0, False, False)]
    passed = spark.createDataFrame(rows, "score double, trusted boolean, toxic boolean")
    assert 0.3 < quality.threshold_of(passed) <= 0.5
    assert quality.threshold_of(passed.filter("not toxic")) <= 0.1
    assert quality.threshold_of(passed.filter("not trusted")) is None


def test_scores_and_verdicts_against_brute_force(spark):
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(rng.choice([f"w{k}" for k in range(60)], rng.integers(1, 90)))) for i in range(90)] + [(90, None), (91, ""), (92, "x " * 30), (93, "long " + " ".join(f"v{k}" for k in range(30000))), (0, "w1 w2")]
    labels = [(i, int(i % 3 > 0), int(i % 7 == 0)) for i in range(0, 60)]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, score int")
    got = quality.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows)

    def buckets(text):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        return quality.grams(raw, np.array([0, len(raw)]), quality.Prefix(raw))[0].tolist() if len(raw) else []

    trusted = {d for d, q, t in labels if q == 1 and t == 0}
    raw, target = Counter(), Counter()
    for d, t in rows:
        raw.update(buckets(t))
        target.update(buckets(t) if d in trusted else [])
    half, all_raw, all_target = quality.SMOOTHING, sum(raw.values()) + quality.SMOOTHING * quality.BUCKETS, sum(target.values()) + quality.SMOOTHING * quality.BUCKETS
    want = []
    for d, t in rows:
        b, own, left = buckets(t), Counter(), all_target
        if d in trusted:
            own, left = Counter(b), all_target - len(b)
        score = sum(math.log(max(target[x] + half - own[x], half) / left) - math.log((raw[x] + half) / all_raw) for x in b) / max(1, len(b))
        n, *_, repeats = brute(t) if (t or "").count(" ") < 1000 else (30001, 0)
        failed = n < 20 or 100 * repeats > 30 * n
        want.append((d, round(score, 6), failed, not failed and score >= got[0].threshold))
    assert sorted((r.doc_id, round(r.score, 6), r.base_failed, r.kept) for r in got) == sorted(want)
    assert any(r.kept for r in got) and any(not r.kept and not r.base_failed for r in got)
