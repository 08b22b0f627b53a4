"""Best outputs by common prefix, from neighbours in one sort.

In the order of texts the longest common prefix of a text with any other is that with a neighbour, and the outputs that share
as much are the run around it whose neighbouring prefix lengths do not fall below. So one look at the nearest and the second nearest output
on either side tells the best one and whether another is as good; no pairs are made. Equal texts are one row with a
count. Rows are dealt out by ranges of folder and text, so a folder or a shared start of any size spreads over tasks; what
a range knows of its edges is a few numbers, from which the driver works out what each range takes over from those beside it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import common_prefix
from ..session import stored

#: Characters of a text that take part in cutting ranges (sampled on the driver, some hundred for each range).
RANGE_CHARS = 1000
NONE, FREE = -1, 1 << 30  # no output yet; no bound yet
ROW, FIRST, LAST = range(3)

Side = tuple  # (prefix shared with the nearest output, with the second nearest, key of the nearest)


def shared_start(a: str, b: str) -> int:
    n, low, step = min(len(a), len(b)), 0, 32
    while low < n and a[low : low + step] == b[low : low + step]:
        low, step = low + step, 2 * step
    if low >= n:
        return n
    high = min(n, low + step)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def passed(side: Side, length: int, outputs: int, key) -> Side:
    """What the next text sees, `length` of whose start is that of a text with so many outputs."""
    first, second, nearest = side
    if outputs:
        return length, length if outputs > 1 else min(first, length), key
    return min(first, length), min(second, length), nearest


def taken_over(side: Side, bound: int, seen: int, carry: Side) -> Side:
    """A side of a row within a range, of which it has `seen` outputs (2: or more), with what the ranges before it carry."""
    if seen > 1:
        return side
    if seen == 1:
        return side[0], min(carry[0], bound), side[2]
    return min(carry[0], bound), min(carry[1], bound), carry[2]


def _one_side(lengths: list[int], outputs: list[int], keys: list) -> list[tuple]:
    """(first, second, key, bound, seen) of each text of a run, from those before it; lengths[i] lies before text i."""
    side, bound, seen, out = (NONE, NONE, None), FREE, 0, []
    for i, (n, key) in enumerate(zip(outputs, keys, strict=True)):
        if i:
            side = passed(side, lengths[i], outputs[i - 1], keys[i - 1])
            bound, seen = min(bound, lengths[i]), min(2, seen + outputs[i - 1])
        out.append((*side, bound, seen))
    return out


def _neighbours(sorted_texts: DataFrame, least: int, key_type: str) -> DataFrame:
    sides = ", ".join(f"{s}1 int, {s}2 int, {s}key {key_type}, {s}bound int, {s}seen int" for s in "lr")
    columns = f"folder string, part int, kind int, name string, head string, h1 long, h2 long, size int, outputs int, lo {key_type}, hi {key_type}, {sides}"

    def of_run(run: list[tuple], lengths: list[int], ends: tuple[str, str], edge: bool) -> Iterator[tuple]:
        outputs, keys = [min(2, r[6]) for r in run], [r[7] for r in run]
        left = _one_side(lengths, outputs, keys)
        right = _one_side([0, *lengths[:0:-1]], outputs[::-1], keys[::-1])[::-1]
        for (folder, part, head, h1, h2, size, n, lo, hi), a, b in zip(run, left, right, strict=True):
            yield folder, part, ROW, None, head, h1, h2, size, n, lo, hi, *a, *b
        for kind, i in ((FIRST, 0), (LAST, -1)) if edge else ():
            folder, part, head, h1, h2, size, n, lo, hi = run[i]
            yield folder, part, kind, ends[i], head, h1, h2, size, n, lo, hi, *left[i], *right[i]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        run, lengths, first, text, opening = [], [], True, "", ""
        for batch in batches:
            for folder, name, h1, h2, n, lo, hi, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if run and run[0][0] != folder:
                    yield from of_run(run, lengths, (opening, text), first)
                    run, lengths, first = [], [], False
                opening = opening if run else name
                lengths.append(shared_start(text, name) if run else 0)
                run.append((folder, part, name[: least - 1], h1, h2, len(name), n, lo, hi))
                text = name
        if run:
            yield from of_run(run, lengths, (opening, text), True)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, held = None, []

        def watched():
            nonlocal schema
            for batch in batches:
                if schema is None:
                    key = batch.schema.field("lo").type
                    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
                    schema = pa.schema([(c.split()[0], key if c.split()[0] in ("lo", "hi", "lkey", "rkey") else kinds[c.split()[1]]) for c in columns.split(", ")])
                yield batch

        for row in rows(watched()):
            held.append(row)
            if len(held) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    return sorted_texts.mapInArrow(of, columns)


def _carried(near: DataFrame) -> dict[tuple[int, str], list[Side]]:
    """What each range's first or last folder takes over from the ranges before and behind it: a few numbers a range."""
    ends = {(r["part"], r["kind"], r["folder"]): r for r in near.filter(F.col("kind") != ROW).drop("name", "head").collect()}
    parts = sorted({p for p, _, _ in ends})
    folder_of = {(p, kind): None for p in parts for kind in (FIRST, LAST)}
    for p, kind, folder in ends:  # a range's last run ends last: its folder is the greatest
        at = folder_of[p, kind]
        folder_of[p, kind] = folder if at is None else max(at, folder, key=lambda x: x.encode()) if kind == LAST else min(at, folder, key=lambda x: x.encode())
    pairs = [(p, q, folder_of[p, LAST]) for p, q in zip(parts, parts[1:], strict=False) if folder_of[p, LAST] == folder_of[q, FIRST]]
    if not pairs:
        return {}
    both = near.sparkSession.createDataFrame(pairs, "p int, q int, folder string")
    texts = lambda kind, at, c: near.filter(F.col("kind") == kind).select(F.col("part").alias(at), "folder", F.col("name").alias(c))
    joined = texts(LAST, "p", "a").join(F.broadcast(both), ["p", "folder"]).join(texts(FIRST, "q", "b"), ["q", "folder"])
    lengths = {(r["p"], r["q"]): r["n"] for r in joined.select("p", "q", common_prefix(F.col("a"), F.col("b")).cast("int").alias("n")).collect()}
    nothing = (NONE, NONE, None)
    carried = {}
    for side, order, inner, outer in (("l", pairs, LAST, 0), ("r", pairs[::-1], FIRST, 1)):
        for p, q, folder in order:
            source, target = (p, q) if outer == 0 else (q, p)
            r = ends[source, inner, folder]
            before = carried.get((source, folder), [nothing, nothing])[outer]
            state = taken_over((r[f"{side}1"], r[f"{side}2"], r[f"{side}key"]), r[f"{side}bound"], r[f"{side}seen"], before)
            carried.setdefault((target, folder), [nothing, nothing])[outer] = passed(state, lengths[p, q], min(2, r["outputs"]), r["lo"])
    return carried


def reconciled(errors: DataFrame, outputs: DataFrame, least: int = 24, key: str | None = None) -> DataFrame:
    """Best output of each error row in its folder by common prefix of names (`least` characters, or one inside the other).

    A tie for the best score is ambiguous. With a `key` column, rows are told apart by it instead of by name, no row is its
    own candidate, and `found` is a key; a key names one row. Rows without a name or a folder are unmatched.
    """
    spark, own = errors.sparkSession, key or "name"
    named = lambda df: df.select("folder", "name", F.col(own).alias("k")).filter("name <> '' AND folder IS NOT NULL")
    given = named(outputs) if key else named(outputs).distinct()
    key_type = given.schema["k"].dataType.simpleString()
    everything = named(errors).withColumn("k", F.lit(None).cast(key_type)).unionByName(given) if errors is not outputs else given
    texts = everything.groupBy("folder", "name").agg(F.count("k").cast("int").alias("outputs"), F.min("k").alias("lo"), F.max("k").alias("hi"))
    hashes = [F.xxhash64("name").alias("h1"), F.xxhash64(F.lit(5), F.col("name")).alias("h2")]
    spread = texts.repartitionByRange("folder", F.substring("name", 1, RANGE_CHARS)).sortWithinPartitions("folder", "name")
    near = stored(_neighbours(spread.select("folder", "name", *hashes, "outputs", "lo", "hi", F.spark_partition_id().alias("part")), least, key_type))

    carried = [(p, f, *a, *b) for (p, f), (a, b) in _carried(near).items()]
    carry = spark.createDataFrame(carried, f"part int, folder string, c_l1 int, c_l2 int, c_lkey {key_type}, c_r1 int, c_r2 int, c_rkey {key_type}")
    rows = near.filter(F.col("kind") == ROW).join(F.broadcast(carry), ["part", "folder"], "left")  # a row for each edge of a range
    now = {}
    for s in "lr":
        first, second = F.coalesce(f"c_{s}1", F.lit(NONE)), F.coalesce(f"c_{s}2", F.lit(NONE))
        low, none, one = F.col(f"{s}bound"), F.col(f"{s}seen") == 0, F.col(f"{s}seen") == 1
        now[f"{s}1"] = F.when(none, F.least(first, low)).otherwise(F.col(f"{s}1"))
        now[f"{s}2"] = F.when(none, F.least(second, low)).when(one, F.least(first, low)).otherwise(F.col(f"{s}2"))
        now[f"{s}key"] = F.when(none, F.col(f"c_{s}key")).otherwise(F.col(f"{s}key"))
    sides = rows.withColumns(now)
    best = sides.select(
        "folder", "head", "h1", "h2", "size", "outputs", "lo", "hi", F.greatest("l1", "r1").alias("most"),
        F.when(F.col("l1") == F.col("r1"), True).when(F.col("l1") > F.col("r1"), F.col("l2") == F.col("l1")).otherwise(F.col("r2") == F.col("r1")).alias("more"),
        F.when(F.col("l1") > F.col("r1"), F.col("lkey")).otherwise(F.col("rkey")).alias("nearest"),
    ).withColumn("beside", (F.col("most") >= least) | (F.col("most") == F.col("size")))

    # a short name at the beginning of a text that shares less with its neighbours; of the lengths that short names have
    shorts = best.filter((F.col("size") < least) & (F.col("outputs") > 0)).select("folder", F.col("head").alias("start"), F.struct("size", "outputs", "lo").alias("inner"))
    lengths = sorted(r[0] for r in shorts.select("inner.size").distinct().collect())  # fewer than `least`
    cuts = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n < F.col("size"))
    starts = best.filter(~F.col("beside")).select("folder", "h1", "h2", "head", F.explode(cuts).alias("n")).select("folder", "h1", "h2", F.substring(F.col("head"), F.lit(1), F.col("n")).alias("start"))
    inner = starts.join(shorts, ["folder", "start"]).groupBy("folder", "h1", "h2").agg(F.max("inner").alias("inner"))

    asked = errors.select("folder", F.col(own).alias("wanted"), *hashes)
    if not key:
        asked = asked.withColumn("self", F.lit(0))
    elif errors is outputs:
        asked = asked.withColumn("self", F.lit(1))
    else:
        there = given.select("folder", F.col("k").alias("wanted"), F.lit(1).alias("self")).distinct()
        asked = asked.join(there, ["folder", "wanted"], "left").withColumn("self", F.coalesce("self", F.lit(0)))
    said = asked.join(best.drop("head"), ["folder", "h1", "h2"], "left").join(inner, ["folder", "h1", "h2"], "left")
    equal, beside = F.col("outputs") - F.col("self"), F.col("beside")
    score = F.when(equal > 0, F.col("size")).when(beside, F.col("most")).otherwise(F.col("inner.size")).cast("long")
    several = F.when(equal > 0, (equal > 1) | (F.col("most") == F.col("size"))).when(beside, F.col("more")).otherwise(F.col("inner.outputs") > 1)
    twin = F.when((F.col("self") == 1) & (F.col("lo") == F.col("wanted")), F.col("hi")).otherwise(F.col("lo"))
    found = F.when(equal > 0, twin).when(beside, F.col("nearest")).otherwise(F.col("inner.lo"))
    status = F.when(score.isNull(), "unmatched").when(several, "ambiguous").otherwise("matched")
    return said.select("folder", "wanted", score.alias("score"), status.alias("status"), F.when(~several, found).alias("found"))
