"""Secret scans over an incremental blob ledger.

Every historical version of a text is addressed by the SHA-256 of its content. The ledger holds one
row for each (blob, rule version) that was ever scanned, with its findings; a scan touches only the
pairs that the ledger lacks, and findings are joined back to every path (row) that holds the blob.
DataFrame functions only.

Nulls: a null text is the empty text. Repeated rows, even under one id, each get their row. A text
without findings gets zero counts, the hash of the empty string and an empty span list. Texts of any length are scanned whole.
Of spans that start together the kinds' order decides. Only the key and text columns are read, so other names never
clash; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

NAME = "op10_secret_scan"

# Patterns of the base kinds and of well-known key formats.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"([0-9a-f]{24,})"
PEM = r"(-----BEGIN [A-Z ]*PRIVATE KEY-----)"
FORGE = r"(gh[pousr]_[A-Za-z0-9]{36,})"
CHAT = r"(xox[abprs]-[A-Za-z0-9-]{10,})"
WEB_TOKEN = r"(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})"


@dataclass(frozen=True)
class Rule:
    """kind and version name the rule in the ledger; group `measured` of a match must have `least` characters."""

    kind: str
    version: int
    pattern: str
    measured: int
    least: int
    base: bool = False


#: In the order in which kinds are listed. The runs that HEX skips (under 24 digits) are those dropped
#: after matching ``[0-9a-f]+``: leftmost greedy matches are maximal runs either way.
RULES = (
    Rule("assign", 1, ASSIGN, 2, 6, True),
    Rule("access", 1, ACCESS, 1, 20, True),
    Rule("hex", 1, HEX, 1, 24, True),
    Rule("pem", 1, PEM, 1, 1),
    Rule("forge", 1, FORGE, 1, 1),
    Rule("chat", 1, CHAT, 1, 1),
    Rule("webtoken", 1, WEB_TOKEN, 1, 1),
)
SPAN = "struct<start:int,rank:int,end:int,kind:string>"


def hits(text: Column, rule: Rule) -> Column:
    """Of each match of the rule in text, in code points: what lies before it, its length, and that of the measured group.

    The pieces between matches and the matches alternate, so a match ends at the sum of both up to it. Null without one.
    """
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x))
    whole = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), lambda x: F.length(x))
    measured = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.measured)), lambda x: F.length(x))
    return F.when(text.rlike(rule.pattern), F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), whole.alias("len"), measured.alias("m")))


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"blob string, kind string, version int, spans array<{SPAN}>")


def scan(versions: DataFrame, ledger: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger rows that are missing for these versions: one for each unseen (blob, kind, version).

    One text of each unseen blob is scanned by the rules that have not seen it.
    """
    spark = versions.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    wanted = spark.createDataFrame([(r.kind, r.version) for r in rules], "kind string, version int")
    known = ledger.join(F.broadcast(wanted), ["kind", "version"], "left_semi")
    seen = known.groupBy("blob").agg(F.collect_set("kind").alias("seen"))  # at most one entry for each rule
    blobs = versions.select(F.sha2(body, 256).alias("blob"), body.alias("text")).dropDuplicates(["blob"])
    todo = blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.expr("cast(array() as array<string>)")))
    todo = todo.filter(F.size("seen") < len(rules))
    found = [
        F.when(~F.array_contains("seen", r.kind), F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.lit(i).alias("rank"), F.lit(r.least).alias("least"), hits(F.col("text"), r).alias("hits")))
        for i, r in enumerate(rules)
    ]
    each = todo.select("blob", F.inline(F.filter(F.array(*found), lambda x: x.isNotNull())))
    # a row for each hit, so that offsets are one running sum: a fold that gathers spans copies them at each step
    single = each.select("blob", "kind", "version", "rank", "least", F.posexplode_outer("hits").alias("i", "hit"))
    so_far = Window.partitionBy("blob", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = single.withColumn("end", F.sum(F.col("hit.gap") + F.col("hit.len")).over(so_far).cast("int"))
    span = F.struct((F.col("end") - F.col("hit.len")).alias("start"), "rank", "end", "kind")
    spans = F.collect_list(F.when(F.col("hit.m") >= F.col("least"), span))  # of one text
    return placed.groupBy("blob", "kind", "version").agg(F.array_sort(spans).cast(f"array<{SPAN}>").alias("spans"))


def render(spans: Column) -> Column:
    ordered = F.array_sort(spans)
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_documents(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Findings of every row: its key, spans of the base kinds, all spans. Updates go to `ledger` + scan()."""
    spark = docs.sparkSession
    ledger = empty_ledger(spark) if ledger is None else ledger
    fresh = stored(scan(docs, ledger, text, rules))
    wanted = spark.createDataFrame([(r.kind, r.version) for r in rules], "kind string, version int")
    all_rows = ledger.join(F.broadcast(wanted), ["kind", "version"], "left_semi").unionByName(fresh)
    by_blob = all_rows.filter(F.size("spans") > 0).groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("all_spans"))
    paths = docs.select(F.col(key).alias(key), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("blob"))
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    joined = paths.join(by_blob, "blob", "left").withColumn("all_spans", F.coalesce("all_spans", none))
    base = [r.kind for r in rules if r.base]
    return joined.select(key, "blob", F.filter("all_spans", lambda s: s["kind"].isin(base)).alias("base_spans"), "all_spans")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_documents(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(render(F.col("base_spans")), 256).alias("base_sha256"),
        render(F.col("all_spans")).alias("spans"),
    )


_KEYWORD = "(" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"


def _sql_pattern(rule: Rule) -> str:
    return rule.pattern.replace("((?i:password|passwd|secret|token|api_?key))", _KEYWORD).replace("'", "''")


def _sql_kind(rule: Rule, rank: int) -> str:
    p = _sql_pattern(rule)
    return f"""SELECT row, {rank} AS rank, '{rule.kind}' AS kind, s AS start, s + w AS stop FROM (
      SELECT row, i, list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s,
             length(hits[i]) AS w, length(parts[i]) AS m
      FROM (SELECT row, string_split_regex(text, '{p}') AS gaps, regexp_extract_all(text, '{p}', 0) AS hits,
                   regexp_extract_all(text, '{p}', {rule.measured}) AS parts FROM d WHERE regexp_matches(text, '{p}')),
           unnest(range(1, len(hits) + 1)) AS u(i)) WHERE m >= {rule.least}"""


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(_sql_kind(r, i) for i, r in enumerate(RULES))}),
said AS (SELECT row, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c, count(*) FILTER (kind = 'hex') AS h,
  coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3), '') AS base,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS every FROM spans GROUP BY row)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM d LEFT JOIN said USING (row)
"""
