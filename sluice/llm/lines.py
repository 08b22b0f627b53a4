"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

A line's words are its runs of characters other than ASCII white space, in lower case. Two lines match if
their words are equal, or, from LEAST words on, if one word edit (substitution, insertion, deletion) turns
one into the other. A line is dropped if an earlier line of the corpus matches it; lines without words stay.
Earlier means: smaller doc_id (null first), then smaller hash of the row, then smaller line number. Rows
that are equal in doc_id and text count as one and get the same verdict. A null text has no lines, and stays
null; an empty text is one line without words. Columns called n_lines and n_dropped are replaced, others left alone;
an empty table gives no rows. The search joins by hashes, so ties and long lines need nothing else.

Every line of n words stands for itself and for its n variants with one word deleted. Equal variants at the
same place and length are substitutions; a variant equal to a whole line is an insertion or deletion. Two
lines one edit apart share their first or their last half, so only lines that share a half with another
line emit variants, and only for places outside the shared half. Variant keys are hashes
of word hashes; very long lines take them from prefix sums modulo two primes, so that all n take time in
proportion to n. Matches found by key are verified word by
word. Groups are reduced to their earliest line before anything is joined back: no pairs within a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, release, stored, table

NAME = "op9_line_dedup"
LEAST = 8
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1664525017)
BLOCK = 256

#: Lines of up to so many words hash each variant on its own (short arrays of word hashes); longer ones by prefix sums.
DIRECT = 4096


def lowered(text: Column) -> Column:
    """In lower case, with blanks for other white space within lines."""
    other = F.contains(text, F.lit("\t")) | F.contains(text, F.lit("\x0b")) | F.contains(text, F.lit("\x0c")) | F.contains(text, F.lit("\r"))
    return F.lower(F.when(other, F.translate(text, "\t\x0b\x0c\r", "    ")).otherwise(text))


def line_words(line: Column) -> Column:
    """Words of a lowered line; a line holds no line feed."""
    return F.array_remove(F.split(line, " "), "")


def row_keys(text: Column) -> list[Column]:
    return [F.xxhash64("doc_id", text).alias("k1"), F.xxhash64(F.lit(7), text, F.col("doc_id")).alias("k2")]


def line_rows(docs: DataFrame) -> DataFrame:
    """k1, k2, doc_id, i, words of every line with words."""
    rows = docs.select("doc_id", *row_keys(F.col("text")), F.posexplode(F.split(lowered(F.col("text")), "\n", -1)).alias("i", "line"))
    return rows.select("doc_id", "k1", "k2", "i", line_words(F.col("line")).alias("words")).filter(F.size("words") > 0)


def half_keys(words: Column, n: Column, least: int) -> Column:
    """Hashes of the first and last halves, for the line's own length and the length next to it; null below `least` words."""
    def key(side: int, length: Column) -> Column:
        part = F.slice(words, F.lit(1), length) if side == 0 else F.slice(words, n - length + 1, length)
        return F.struct(F.lit(side).alias("side"), F.xxhash64(F.lit(side), length, part).alias("key"))

    down = lambda x: F.floor(x / 2).cast("int")
    keys = F.array(key(0, down(n)), key(0, down(n - 1)), key(1, down(n + 1)), key(1, down(n)))
    return F.when(n >= least, keys)


def prefix_sums(words: Column, prime: int, base: int) -> Column:
    """Sums of hash(word j) * base**j modulo prime over the words before each place; n + 1 numbers.

    Blocks are summed on their own, so that growing the result never copies the whole of it for each word.
    """
    n = F.size(words)
    starts = F.sequence(F.lit(1), n, F.lit(BLOCK))
    kind = "struct<power:bigint,sum:bigint,out:array<bigint>>"

    def word(state: Column, w: Column) -> Column:
        total = F.pmod(state["sum"] + F.pmod(F.xxhash64(w), F.lit(prime)) * state["power"], F.lit(prime))
        return F.struct(F.pmod(state["power"] * F.lit(base), F.lit(prime)).alias("power"), total.alias("sum"), F.concat(state["out"], F.array(total)).alias("out"))

    def block(state: Column, at: Column) -> Column:
        begin = F.struct(state["power"].alias("power"), state["sum"].alias("sum"), F.expr("cast(array() as array<bigint>)").alias("out"))
        inner = F.aggregate(F.slice(words, at, F.lit(BLOCK)), begin, word)
        return F.struct(inner["power"].alias("power"), inner["sum"].alias("sum"), F.concat(state["out"], F.array(inner["out"])).alias("out"))

    first = F.struct(F.lit(1).cast("bigint").alias("power"), F.lit(0).cast("bigint").alias("sum"), F.expr("cast(array(array(0)) as array<array<bigint>>)").alias("out"))
    return F.aggregate(starts, first, block, lambda s: F.flatten(s["out"]))


def places() -> Column:
    """Places of the words to delete: those in a line's open half; and -1, for the whole line."""
    middle = F.floor(F.col("n") / 2).cast("int")
    low = F.when(F.col("tail_open") & ~F.col("head_open"), middle - 1).otherwise(0)
    high = F.when(F.col("head_open") & ~F.col("tail_open"), middle + 1).otherwise(F.col("n") - 1)
    return F.concat(F.array(F.lit(-1)), F.sequence(low, high))


def short_variants(lines: DataFrame) -> DataFrame:
    hashed = lines.withColumn("w", F.transform("words", lambda x: F.xxhash64(x)))

    def key(i: Column) -> Column:
        w, n = F.col("w"), F.col("n")
        cut = F.xxhash64(n - 1, F.concat(F.slice(w, F.lit(1), i), F.slice(w, i + 2, n)))
        return F.when(i < 0, F.xxhash64(n, w)).otherwise(cut)

    return hashed.select("h", "h2", "n", F.inline(F.transform(places(), lambda i: F.struct(i.alias("i"), key(i).alias("key")))))


def long_variants(lines: DataFrame) -> DataFrame:
    sums = lines
    for x, (prime, base) in enumerate(zip(PRIMES, BASES, strict=True)):
        sums = sums.withColumn(f"p{x}", prefix_sums(F.col("words"), prime, base))

    def value(x: int, i: Column) -> Column:
        prime, p = PRIMES[x], F.col(f"p{x}")
        back = pow(BASES[x], -1, prime)
        total = F.element_at(p, -1)
        without = F.pmod(F.get(p, i) + F.pmod(total - F.get(p, i + 1), F.lit(prime)) * F.lit(back), F.lit(prime))
        return F.when(i < 0, total).otherwise(without)

    rows = F.transform(places(), lambda i: F.struct(i.alias("i"), F.xxhash64(F.lit(1), value(0, i), value(1, i), F.col("n") - F.when(i < 0, 0).otherwise(1)).alias("key")))
    return sums.select("h", "h2", "n", F.inline(rows))


def variants(lines: DataFrame, direct: int = DIRECT) -> DataFrame:
    """h, n, i, key for each place i in a line's open half, and the line itself as i = -1.

    Lines of just `direct` words are whole lines of both kinds, so that longer ones can meet them.
    """
    spread = lines.repartition("h", "h2")
    beyond = long_variants(spread.filter(F.col("n") >= direct)).filter((F.col("n") > direct) | (F.col("i") < 0))
    return short_variants(spread.filter(F.col("n") <= direct)).unionByName(beyond)


def kept_lines(docs: DataFrame, work: Scratch, least: int = LEAST) -> DataFrame:
    """k1, k2, i of every line with words that no earlier line matches."""
    n = F.size("words")
    plain = line_rows(docs).select("doc_id", "k1", "k2", "i", F.xxhash64("words").alias("h"), F.xxhash64(F.lit(3), F.col("words")).alias("h2"), n.alias("n"), half_keys(F.col("words"), n, least).alias("halves"))
    position = F.struct("doc_id", "k1", "i", "k2")
    distinct = work.stored(plain.groupBy("h", "h2").agg(F.min(F.struct(position.alias("at"), F.col("n"), F.col("halves"))).alias("x")).select("h", "h2", "x.*"))
    release(docs.sparkSession)

    halves = distinct.filter("halves is not null").select("h", "h2", F.inline(F.array_distinct("halves")))
    shared = halves.groupBy("side", "key").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    live = halves.join(shared.hint("shuffle_merge"), ["side", "key"], "left_semi").groupBy("h", "h2").agg(F.max(F.col("side") == 0).alias("tail_open"), F.max(F.col("side") == 1).alias("head_open"))
    live = distinct.select("h", "h2", "at", "n").join(live, ["h", "h2"])
    wanted = live.groupBy(F.col("at.k1").alias("k1"), F.col("at.k2").alias("k2")).agg(F.collect_list(F.struct("at.i", "h", "h2", "at", "n", "tail_open", "head_open")).alias("lines"))  # lines of one row
    wanted = work.stored(wanted)  # before texts move, so that both are not on disk at once
    texts = docs.select(*row_keys(F.col("text")), "text").join(wanted, ["k1", "k2"])
    cut = texts.select(F.split(lowered(F.col("text")), "\n", -1).alias("all"), F.explode("lines").alias("x")).select("x.*", F.get("all", F.col("x.i")).alias("line"))
    open_lines = work.stored(cut.select("h", "h2", "at", "n", "tail_open", "head_open", line_words(F.col("line")).alias("words")).dropDuplicates(["h", "h2"]))

    release(docs.sparkSession)
    v = work.stored(variants(open_lines))
    at = open_lines.select("h", "h2", "at")
    # substitutions: variants of one length and place; each points to the earliest of its key
    often = v.filter("i >= 0").groupBy("key", "n", "i").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    groups = work.stored(v.filter("i >= 0").join(often.hint("shuffle_merge"), ["key", "n", "i"], "left_semi").join(at, ["h", "h2"]))
    earliest = groups.groupBy("key", "n", "i").agg(F.min(F.struct("at", "h", "h2")).alias("e"))
    same = groups.join(earliest, ["key", "n", "i"]).filter("e.at < at").select("h", "h2", F.col("e.h").alias("eh"), F.col("e.h2").alias("eh2"), F.lit(None).cast("int").alias("gap"), F.lit(False).alias("longer"))
    # insertions and deletions: a variant that is a whole line
    whole = v.filter("i = -1").select("key", (F.col("n") + 1).alias("n"), F.col("h").alias("wh"), F.col("h2").alias("wh2"))
    met = v.filter("i >= 0").join(whole, ["key", "n"]).select("h", "h2", "i", "wh", "wh2")
    met = met.join(at, ["h", "h2"]).join(at.select(F.col("h").alias("wh"), F.col("h2").alias("wh2"), F.col("at").alias("wat")), ["wh", "wh2"])
    later = F.col("wat") < F.col("at")
    pick = lambda a, b: F.when(later, F.col(a)).otherwise(F.col(b))
    uneven = met.select(pick("h", "wh").alias("h"), pick("h2", "wh2").alias("h2"), pick("wh", "h").alias("eh"), pick("wh2", "h2").alias("eh2"), F.col("i").alias("gap"), later.alias("longer"))
    pairs = same.unionByName(uneven).dropDuplicates(["h", "h2", "eh", "eh2"])
    # verified on the words
    body = open_lines.select("h", "h2", "words")
    checked = pairs.join(body, ["h", "h2"]).join(body.select(F.col("h").alias("eh"), F.col("h2").alias("eh2"), F.col("words").alias("others")), ["eh", "eh2"])
    long_words, short_words = F.when(F.col("longer"), F.col("words")).otherwise(F.col("others")), F.when(F.col("longer"), F.col("others")).otherwise(F.col("words"))
    cut_words = F.concat(F.slice(long_words, F.lit(1), F.col("gap")), F.slice(long_words, F.col("gap") + 2, F.size(long_words)))
    one = F.size(F.filter(F.zip_with("words", "others", lambda a, b: ~a.eqNullSafe(b)), lambda x: x)) == 1
    near = work.stored(checked.filter(F.when(F.col("gap").isNull(), one).otherwise(cut_words == short_words)).select("h", "h2").distinct())
    work.discard(v, groups, open_lines, wanted)
    return distinct.select("h", "h2", "at").join(near, ["h", "h2"], "left_anti").select("at.k1", "at.k2", "at.i")


def dedup(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """docs with `text` cut to its kept lines, and n_lines, n_dropped; other columns as they are.

    least: lines of fewer words (at least 2) match only if equal.
    """
    with Scratch(docs.sparkSession) as work:
        kept = stored(kept_lines(docs, work, least).groupBy("k1", "k2").agg(F.sort_array(F.collect_list("i")).alias("stay")))  # lines of one row
    return _cut(docs, kept)  # texts are not stored once more


def _cut(docs: DataFrame, kept: DataFrame) -> DataFrame:
    keyed = docs.select("*", *(c.alias(f"__{x}") for c, x in zip(row_keys(F.col("text")), ("k1", "k2"), strict=True)))
    joined = keyed.join(kept.select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("stay").alias("__stay")), ["__k1", "__k2"], "left").drop("__k1", "__k2")
    joined = joined.withColumn("__lines", F.split("text", "\n", -1))
    # lines without words stay too: merged by place with the kept ones
    bare = F.filter(F.sequence(F.lit(0), F.size("__lines") - 1), lambda j: ~F.get("__lines", j).rlike(r"[^\x20\x09-\x0D]"))
    joined = joined.withColumn("__stay", F.when(F.col("text").isNotNull(), F.array_sort(F.concat(F.coalesce("__stay", F.array().cast("array<int>")), bare))))
    whole = F.size("__stay") == F.size("__lines")
    text = F.when(whole, F.col("text")).otherwise(F.array_join(F.transform("__stay", lambda j: F.get("__lines", j)), "\n"))
    return joined.select(
        *(text.alias(c) if c == "text" else F.col(c) for c in docs.columns if c not in ("n_lines", "n_dropped")),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("__lines")).cast("long").alias("n_lines"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("__lines") - F.size("__stay")).cast("long").alias("n_dropped"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


#: The rows of dedup() for a table `{source}`: doc_id, text (with dropped lines gone), n_lines, n_dropped, whole. DuckDB.
ROWS_SQL = f"""
  WITH {{p}}all AS (SELECT row_number() OVER (ORDER BY doc_id, text) AS r, * FROM {{source}}),
  {{p}}lines AS (SELECT r, i, line, list_filter(string_split_regex(lower(line), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
    FROM (SELECT r, unnest(range(1, len(parts) + 1)) AS i, unnest(parts) AS line FROM (SELECT r, string_split(text, chr(10)) AS parts FROM {{p}}all WHERE text IS NOT NULL))),
  {{p}}distinct AS (SELECT words, len(words) AS n, min((r, i)) AS pos FROM {{p}}lines WHERE len(words) > 0 GROUP BY words),
  {{p}}cut AS (SELECT pos, n, j, words[1:j - 1] || words[j + 1:] AS rest FROM {{p}}distinct, unnest(range(1, n + 1)) AS u(j) WHERE n >= {LEAST}),
  {{p}}near AS (
    SELECT pos FROM (SELECT pos, min(pos) OVER (PARTITION BY rest, j) AS early FROM {{p}}cut) WHERE early < pos
    UNION SELECT greatest(c.pos, d.pos) FROM {{p}}cut c JOIN {{p}}distinct d ON c.rest = d.words WHERE d.n >= {LEAST}),
  {{p}}kept AS (SELECT l.r, l.i, l.line, len(l.words) = 0 OR ((l.r, l.i) = d.pos AND d.pos NOT IN (SELECT pos FROM {{p}}near)) AS keep
    FROM {{p}}lines l LEFT JOIN {{p}}distinct d USING (words)),
  {{p}}texts AS (SELECT r, count(*) AS n_lines, count(*) FILTER (NOT keep) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keep), '') AS text FROM {{p}}kept GROUP BY r)
  SELECT a.* EXCLUDE (r, text), CASE WHEN a.text IS NULL THEN NULL ELSE t.text END AS text, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped
  FROM {{p}}all a LEFT JOIN {{p}}texts t USING (r)
"""
SQL = f"SELECT doc_id, n_lines, n_dropped, sha256(coalesce(text, '')) AS kept_sha256 FROM ({ROWS_SQL.format(source='documents', p='l_')})"
