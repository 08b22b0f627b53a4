import hashlib
import random
import re

from pyspark.sql import functions as F

from sluice.llm import secrets

ASSIGN = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KINDS = [("assign", ASSIGN, lambda m: len(m[2]) >= 6), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]


def brute(text):
    spans = [(m.start(), i, m.end(), k) for i, (k, p, ok) in enumerate(KINDS) for m in p.finditer(text or "") if ok(m)]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))


def texts():
    rng = random.Random(3)
    bits = ["password", "PassWd", "token=", "secret: ", "api_key", "apikey='", "=", ":", '"', " ", "abcdef", "deadbeef" * 3, "AKIA" + "Q" * 16, "AKIAAKIA", "é日", "\n", "abc", "0123", "tokentoken", "x" * 7, "=token:abcdefg"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(400)]


def test_against_brute_force(spark):
    rows = [(i, t, "x") for i, t in enumerate([*texts(), "", "token=token:abcdefg", "f" * 200_000])] + [(900, None, "x"), (0, texts()[0], "x"), (None, "secret=abcdef", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, blob string")
    got = secrets.scan_documents(docs).select("doc_id", secrets.render(F.col("base_spans")).alias("b")).collect()
    key = lambda r: (r[0] is None, r[0], r[1])
    assert sorted(((r.doc_id, r.b) for r in got), key=key) == sorted(((d, brute(t)) for d, t, _ in rows), key=key)
    assert secrets.scan_documents(docs.limit(0)).collect() == []


def test_ledger_scans_only_what_is_new(spark):
    docs = spark.createDataFrame([(1, "token=abcdef"), (2, "token=abcdef"), (3, "nothing")], "doc_id long, text string")
    first = secrets.scan(docs, secrets.empty_ledger(spark)).cache()
    assert first.count() == 2 * len(secrets.RULES)
    more = docs.union(spark.createDataFrame([(4, "AKIA" + "A" * 16)], "doc_id long, text string"))
    fresh = secrets.scan(more, first)
    assert {r.blob for r in fresh.collect()} == {hashlib.sha256(("AKIA" + "A" * 16).encode()).hexdigest()}
    newer = (*secrets.RULES[:2], secrets.Rule("hex", 2, secrets.HEX, 1, 24, True), *secrets.RULES[3:])
    again = secrets.scan(docs, first, rules=newer).collect()
    assert {(r.kind, r.version) for r in again} == {("hex", 2)} and len(again) == 2


def test_other_kinds(spark):
    text = "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 18 + " xoxb-1234567890 eyJabcdefgh.abcdefgh.abcdefgh"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    kinds = [s.kind for s in secrets.scan_documents(docs).first().all_spans]
    assert {"pem", "forge", "chat", "webtoken"} <= set(kinds)


def test_a_text_of_very_many_hits(spark):
    """In proportion to the hits: a million in seconds, where a fold that copies its result takes hours."""
    hit = "token=abcdef, "
    docs = spark.createDataFrame([(1, hit * 1_000_000), (2, hit * 600 + "x=" + "0" * 24)], "doc_id long, text string")
    spans = {r.doc_id: r.all_spans for r in secrets.scan_documents(docs).filter("doc_id = 2").collect()}[2]
    assert len(spans) == 601 and [s.start for s in spans[:3]] == [0, 14, 28] and spans[-1].start == 602 * 14 - 26
    counted = secrets.scan_documents(docs).filter("doc_id = 1").select(F.size("all_spans").alias("n"), F.element_at("all_spans", -1)["end"].alias("end")).first()
    assert (counted.n, counted.end) == (1_000_000, 14_000_000 - 2)
