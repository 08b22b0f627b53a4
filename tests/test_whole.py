"""Queries over whole tables and whole texts, against brute force."""

import os
import re
from collections import Counter

from pyspark.sql import functions as F

from sluice import registry
from sluice.functions import text as T

SF = "/root/testdata/sf0.001"
QUERIES = registry.queries()


def test_reconcile_documents(spark, tmp_path):
    stem = "s" * 130
    rows = [(1, stem + "abc", "en", "x"), (2, stem + "abd", "en", "x"), (3, stem + "q", "en", "x"), (13, stem + "abd", "de", "x"), (4, "short", "en", "x"), (5, "short name", "en", "x"), (6, "alone", "en", "x"), (7, None, "en", "x"), (8, "same text, twenty-four and more", "fr", "x"), (9, "same text, twenty-four and more", "fr", "x"), (10, "same text, twenty-four and more", "fr", "x")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    real = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    for path, docs in ((str(tmp_path), rows), (SF, real)):
        want = {}
        for i, t, *folder in docs:
            scores = []
            for j, u, *other in docs:
                if i != j and folder == other and t and u:
                    n = len(os.path.commonprefix([t, u]))
                    if n >= min(24, len(t), len(u)):
                        scores.append((n, j))
            top = max(scores, default=(None, None))[0]
            ids = [j for n, j in scores if n == top]
            want[i] = (top, "unmatched" if not ids else "ambiguous" if len(ids) > 1 else "matched", ids[0] if len(ids) == 1 else None)
        assert {r.doc_id: (r.score, r.status, r.best) for r in QUERIES["reconcile_documents"](spark, path).collect()} == want
    assert want


def test_common_prefix_of_long_texts(spark):
    rows = [("x" * 90_000 + "a", "x" * 90_000 + "b"), ("", "a"), (None, "a"), ("ab", "ab"), ("abc", "ab"), ("b", "a")]
    got = spark.createDataFrame(rows, "a string, b string").select(T.common_prefix(F.col("a"), F.col("b")).alias("n")).collect()
    assert [r.n for r in got] == [90_000, 0, 0, 2, 2, 0]


def test_letters_and_options_of_whole_texts(spark, tmp_path):
    far = "x" * 300
    texts = {1: far + " d then a", 2: far + "\n(C) late\n(E) last " + far, 3: "", 4: "\n".join(f"(A) {i}" for i in range(1500)), 5: None}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.letters for r in QUERIES["answer_letters_text"](spark, str(tmp_path)).collect()}
    assert got == {i: "".join(dict.fromkeys(re.findall("[A-D]", (t or "").upper()))) for i, t in texts.items()}
    found = {r.doc_id: (r.n_options, r.first) for r in QUERIES["option_parse"](spark, str(tmp_path)).collect()}
    real = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    more = {r.doc_id: (r.n_options, r.first) for r in QUERIES["option_parse"](spark, SF).collect()}
    for docs, options in ((texts, found), (real, more)):
        for i, t in docs.items():
            if t is None:
                continue
            block = f"stem\n(A) {t}\n(B) w\n(C) x\n(D) y"
            parts = re.split(r"(?m)(?:^|[ \t\n\x0B\f\r])\(?([A-E])[).．、][ \t\n\x0B\f\r]*", block)
            pairs = sorted(zip(parts[1::2], (x.strip() for x in parts[2::2])))
            assert options[i] == (len(pairs), pairs[0][1]), i
    assert found[2][0] == 6 and found[4][0] == 1503


def test_totals_beside_every_event(spark, tmp_path):
    kinds = ["purchase", "click", "view"]
    rows = [(i, 500 if i % 2 else i % 30, kinds[i % 3]) for i in range(400)] + [(1000, None, "purchase"), (1001, None, "view")]
    frame = spark.createDataFrame(rows, "event_id long, user_id long, event_type string").selectExpr("event_id", "timestamp_ntz '2026-01-01' as ts", "user_id", "event_type", "0.5D as value", "'{}' as props")
    frame.write.parquet(f"{tmp_path}/events.parquet")
    n, accepts = Counter(u for _, u, _ in rows), Counter(u for _, u, k in rows if k == "purchase")
    got = sorted((r.id, r.candidate_key, r.n, r.accepts) for r in QUERIES["total_over_table"](spark, str(tmp_path)).collect())
    assert got == [(i, u, n[u], accepts[u]) for i, u, _ in rows]


def test_sheets_and_gaps_of_whole_conversations(spark, tmp_path):
    turns = {1: [0, 1, 2, 3, 4], 2: [0, 3, 4, 7], 3: [2, 2, 5, 10], 4: [1]}
    spark.createDataFrame([(c, t, "user", "x") for c, ts in turns.items() for t in ts], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r.conv_id, r.turn): r.placeholder for r in QUERIES["answer_sheet_whole"](spark, str(tmp_path)).collect()}
    assert got == {(c, t): t not in ts for c, ts in turns.items() for t in range(max(ts) + 1)}
    gaps = {r.conv_id: r.missing for r in QUERIES["document_gaps_whole"](spark, str(tmp_path)).collect()}
    assert gaps == {2: "1,2,5,6", 3: "3,4,6,7,8,9"}


def test_every_part_is_read(spark):
    keys = {r.p_partkey for r in spark.read.parquet(f"{SF}/part.parquet").select("p_partkey").collect()}
    for name in ("upsert_whole", "insert_ignore_whole", "scoped_replace_whole"):
        assert {r.p_partkey for r in QUERIES[name](spark, SF).collect()} == keys, name
    assert sum(r.n for r in QUERIES["full_outer_diff_whole"](spark, SF).collect()) == len(keys)
