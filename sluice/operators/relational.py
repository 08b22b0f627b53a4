"""Relational building blocks: latest rows, upserts, scoped deletes, facets, counted pages, unions of equi-joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .running import running


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def guarded_int(c: Column, default: int | None = 0) -> Column:
    """Digits-only text as an integer, else the default; no signs or blanks are accepted."""
    value = F.when(c.rlike(r"^[0-9]+$"), c.try_cast("int"))
    return value if default is None else F.coalesce(value, F.lit(default))


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order; planned as a group limit before and after the exchange."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The columns of the last row of each key, by partial aggregation; an unused join with it is pruned."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("__x")).select(*keys, *(F.col(f"__x.{c}").alias(c) for c in columns))


def first_wins(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    return distinct_on(df, keys, [F.col(seq).asc()])


def last_wins(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    return distinct_on(df, keys, [F.col(seq).desc()])


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after INSERT ... ON CONFLICT (keys) DO UPDATE: matched rows take all source values, nulls too.

    A key that stands in source twice is an error, raised when the result is computed.
    """
    rest = [c for c in target.columns if c not in keys]
    one = source.groupBy(*keys).agg(F.any_value(F.struct(F.lit(True).alias("__m"), *rest)).alias("__s"), F.count(F.lit(1)).alias("__n"))
    s = one.withColumn("__s", F.when(F.col("__n") == 1, F.col("__s")).otherwise(F.raise_error(F.concat(F.lit("repeated key: "), F.to_json(F.struct(*keys)))))).drop("__n")
    joined = target.join(s, list(keys), "full_outer")
    return joined.select(*keys, *(F.when(F.col("__s.__m"), F.col(f"__s.{c}")).otherwise(F.col(c)).alias(c) for c in rest)).select(*target.columns)


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Target after INSERT ... ON CONFLICT DO NOTHING; also conditional inserts on any composite key.

    Of source rows with one new key the first in `order` is inserted; without an order, any one.
    """
    new = source.join(target.select(*keys).distinct(), list(keys), "left_anti")
    new = distinct_on(new, keys, order) if order else new.dropDuplicates(list(keys))
    return target.unionByName(new, allowMissingColumns=True)


def replace_scope(target: DataFrame, scope: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the target's rows whose keys are in scope, then insert new."""
    return target.join(scope.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def mirror_delete(target: DataFrame, loaded: DataFrame, category: str, keys: Sequence[str]) -> DataFrame:
    """Target without rows of the loaded categories whose keys were not loaded."""
    categories = loaded.select(category).distinct().withColumn("__c", F.lit(True))
    known = loaded.select(*keys).distinct().withColumn("__k", F.lit(True))
    marked = target.join(categories, category, "left").join(known, list(keys), "left")
    return marked.filter("__c is null or __k is not null").select(*target.columns)


def full_outer_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """keys and change: keep, replace, remove or add."""
    a = before.select(*keys, F.struct(*columns).alias("__a"))
    b = after.select(*keys, F.struct(*columns).alias("__b"))
    change = F.when(F.col("__b").isNull(), "remove").when(F.col("__a").isNull(), "add").when(F.col("__a").eqNullSafe(F.col("__b")), "keep").otherwise("replace")
    return a.join(b, list(keys), "full_outer").select(*keys, change.alias("change"))


def or_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], keep: Sequence[str]) -> DataFrame:
    """Distinct `keep` columns of left x right where any of the column pairs is equal: a union of equi-joins."""
    out = None
    for a, b in pairs:
        part = left.join(right, left[a] == right[b]).select(*keep)
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def ancestors(path: Column) -> Column:
    """All folders above a path, from the top: of `a/b/c` these are `a` and `a/b`."""
    parts = F.split(path, "/", -1)
    return F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


#: Rows of a name that meet in one task at most, on either side.
DEALT = 1000


def _dealt_join(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """Equi-join on `name`; the rows of a frequent name are dealt into blocks, each block of one side meeting each of the other in a cell of its own."""
    counts = left.groupBy(name).agg(F.count(F.lit(1)).alias("__nl")).join(right.groupBy(name).agg(F.count(F.lit(1)).alias("__nr")), name)
    blocks = lambda n: F.ceil(F.col(n) / DEALT).cast("int")
    often = counts.filter((F.col("__nl") > DEALT) | (F.col("__nr") > DEALT)).select(name, blocks("__nl").alias("__bl"), blocks("__nr").alias("__br"))  # few: each has DEALT rows or more

    def cells(df: DataFrame, own: str, other: str, n_own: str, n_other: str) -> DataFrame:
        at = F.pmod(F.xxhash64(*df.columns), F.coalesce(n_own, F.lit(1))).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.coalesce(n_other, F.lit(1)) - 1)).alias(other)
        return df.join(F.broadcast(often), name, "left").select(*df.columns, at, every)

    return cells(left, "__l", "__r", "__bl", "__br").join(cells(right, "__r", "__l", "__br", "__bl"), [name, "__l", "__r"])


def path_join(left: DataFrame, right: DataFrame, path: str, exact: str, folder: str, keep: Sequence[str]) -> DataFrame:
    """Distinct `keep` columns of left x right where left's path is right's exact path or lies under right's folder.

    Each path meets itself and the folders above it in one equi-join: no pattern and no comparison of all pairs. Folders are literal
    and whole (`a/b` holds `a/b/c`, not `a/bc`); null and empty ones hold nothing. Two rows meet once, so only pairs of
    keys that have several rows are made distinct; the others, which may be many more than the rows, are not moved again.
    """
    mine, theirs = [c for c in keep if c in left.columns], [c for c in keep if c in right.columns]
    files = left.select(*mine, F.col(path).alias("__path")).filter("__path is not null").distinct()
    lists = right.select(*theirs, F.col(exact).alias("__exact"), F.when(F.col(folder) != "", F.col(folder)).alias("__folder")).filter("__exact is not null or __folder is not null").distinct()

    def pairs(files: DataFrame, lists: DataFrame) -> DataFrame:
        above = F.when(F.contains("__path", F.lit("/")), F.transform(ancestors(F.col("__path")), lambda x: F.concat(F.lit("/"), x))).otherwise(F.array().cast("array<string>"))
        named = files.withColumn("__name", F.explode(F.concat(F.array(F.concat(F.lit("="), "__path")), above)))
        wanted = lists.withColumn("__name", F.explode(F.array_compact(F.array(F.concat(F.lit("="), "__exact"), F.concat(F.lit("/"), "__folder")))))
        also = F.coalesce(F.startswith("__path", F.concat("__folder", F.lit("/"))), F.lit(False))  # an exact path that its own row's folder holds too
        return _dealt_join(named, wanted, "__name").filter(F.startswith("__name", F.lit("/")) | ~also).select(*keep)

    if not mine or not theirs:
        return pairs(files, lists).distinct()

    def by_rows(df: DataFrame, keys: list[str], values: list[str]) -> tuple[DataFrame, DataFrame]:
        """Rows whose keys no other row has, and the rest."""
        n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *(F.min(v).alias(v) for v in values))
        named = [F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)]
        same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(keys)))
        return n.filter("__n = 1").select(*keys, *values), df.join(n.filter("__n > 1").select(*named), same, "left_semi")

    one_file, more_files = by_rows(files, mine, ["__path"])
    one_list, more_lists = by_rows(lists, theirs, ["__exact", "__folder"])
    return pairs(one_file, one_list).unionByName(pairs(more_files, lists).unionByName(pairs(one_file, more_lists)).distinct())


def facets(df: DataFrame, filters: dict[str, object]) -> DataFrame:
    """(facet, value) in one pass: each column's values under all filters but its own; None is no filter."""
    columns = list(filters)
    ok = {c: F.lit(True) if v is None else F.coalesce(F.col(c) == F.lit(v), F.lit(False)) for c, v in filters.items()}

    def others(c: str) -> Column:
        cond = F.lit(True)
        for o in columns:
            if o != c:
                cond = cond & ok[o]
        return cond

    pairs = F.array(*(F.when(others(c) & F.col(c).isNotNull(), F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value"))) for c in columns))
    return df.select(F.inline(F.filter(pairs, lambda x: x.isNotNull()))).distinct()


def optional_filters(df: DataFrame, filters: dict[str, object]) -> DataFrame:
    """Equality filters; empty values do not filter."""
    for c, v in filters.items():
        if v not in (None, ""):
            df = df.filter(F.col(c) == F.lit(v))
    return df


def within_years(date: Column, year_start: int, year_end: int) -> Column:
    """Dates of the years from year_end to year_start: the start is the later one, as the windows are read backwards.

    A comparison with two dates, so that it reaches the scan. A start before the end keeps nothing.
    """
    return (date >= F.make_date(F.lit(year_end), F.lit(1), F.lit(1))) & (date < F.make_date(F.lit(year_start + 1), F.lit(1), F.lit(1)))


def review_order(category: str, subject: str, year: str, ordinal: str, number: str, key: str) -> list[Column]:
    """The six keys of review pages: names, later years and ordinals first (text that is no number counts as 0), number, key."""
    name = lambda c: F.coalesce(F.col(c), F.lit("")).asc()
    return [name(category), name(subject), guarded_int(F.col(year)).desc(), guarded_int(F.col(ordinal)).desc(), guarded_int(F.col(number)).asc(), F.col(key).asc()]


def clamp_limit(limit, default: int = 500, most: int = 1000) -> int:
    try:
        n = int(limit or default)
    except (TypeError, ValueError):
        n = default
    return max(1, min(n, most))


def counted_page(df: DataFrame, order: Sequence[Column], limit: int, flag: Column) -> DataFrame:
    """The first rows in order, beside the total count and the count of flagged rows before the limit.

    The counts are one aggregated row; the page is a top-k. No window over all rows.
    """
    counts = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(flag).alias("flagged"))
    return df.orderBy(*order).limit(limit).crossJoin(F.broadcast(counts))


def contains_text(query: str, *columns: str) -> Column:
    """Literal, case-insensitive search in columns joined by blanks; nulls are skipped."""
    return F.contains(F.lower(F.concat_ws(" ", *columns)), F.lit(query.lower()))


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Adds each row's place in the order, from 1, without bringing all rows to one task.

    Rows are dealt to partitions by ranges of the order; each counts its own, and a row for each partition says
    where it begins. Ties in the order are broken by the other columns, so that both passes agree.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # named, so that adaptive execution keeps the partitions as they are
    ranges = df.repartitionByRange(n, *order, *(F.col(c) for c in df.columns)).withColumn("__p", F.spark_partition_id())
    local = ranges.withColumn("__i", F.row_number().over(Window.partitionBy("__p").orderBy(*order, *df.columns)))
    sizes = local.groupBy("__p").agg(F.count(F.lit(1)).alias("n"))
    begin = sizes.select(F.col("__p").alias("__q"), (F.sum("n").over(Window.orderBy("__p")) - F.col("n")).alias("__b"))  # a row for each partition
    return local.join(F.broadcast(begin), F.col("__p") == F.col("__q")).withColumn(name, F.col("__i") + F.col("__b")).drop("__p", "__i", "__q", "__b")


def chunked(df: DataFrame, order: Sequence[Column], size: int, name: str = "chunk") -> DataFrame:
    """Adds the number, from 1, of each row's chunk of `size` rows in order."""
    return numbered(df, order, "__n").withColumn(name, (F.floor((F.col("__n") - 1) / size) + 1).cast("long")).drop("__n")


def gaps(df: DataFrame, key: str, number: str, most: int = 50) -> DataFrame:
    """Numbers that lack between each key's least and greatest, the first `most`; never builds a whole range."""
    w = Window.partitionBy(key).orderBy(number)
    seen = df.select(key, F.col(number).alias("__n")).filter("__n is not null").distinct()
    after = F.lead("__n").over(Window.partitionBy(key).orderBy("__n"))
    open_ = seen.withColumn("__to", after - 1).filter("__to > __n")
    lacking = open_.select(key, F.explode(F.sequence(F.col("__n") + 1, F.least("__to", F.col("__n") + most))).alias(number))
    first = lacking.withColumn("__rn", F.row_number().over(w)).filter(f"__rn <= {most}")
    return first.groupBy(key).agg(F.array_sort(F.collect_list(number)).alias("missing"))


#: Placeholders that one step of filled_sheet() makes at once.
STRETCH = 4096


def filled_sheet(df: DataFrame, key: str, number: str, order: Sequence[str], columns: Sequence[str], first: int = 0) -> DataFrame:
    """Each key's numbers from `first` to its greatest: the last row of each number, and placeholders for numbers without one.

    Placeholders come from the gaps between numbers, STRETCH at a time, so that a stray number costs rows but no memory.
    """
    last = latest_by(df.filter(F.col(number).isNotNull()), [key, number], order, columns).withColumn("placeholder", F.lit(False))
    before = F.coalesce(F.lag(number).over(Window.partitionBy(key).orderBy(number)), F.lit(first - 1))
    spans = last.select(key, (before + 1).alias("__a"), (F.col(number) - 1).alias("__b")).filter("__a <= __b")
    stretches = spans.select(key, "__b", F.explode(F.sequence(F.col("__a"), F.col("__b"), F.lit(STRETCH).cast("bigint"))).alias("__a"))
    lacking = stretches.select(key, F.explode(F.sequence(F.col("__a"), F.least(F.col("__b"), F.col("__a") + STRETCH - 1))).alias(number))
    return last.unionByName(lacking.withColumn("placeholder", F.lit(True)), allowMissingColumns=True)


def occurrence_keys(df: DataFrame, keys: Sequence[str], order: Sequence[Column], base: Column) -> DataFrame:
    """Adds candidate_key: base, with :dupNN from the second occurrence on. A key's rows spread over tasks."""
    found = running(df, keys, order, counts=["__rn"])
    rn = F.col("__rn")
    return found.withColumn("candidate_key", F.when(rn > 1, F.concat(base, F.lit(":dup"), F.lpad(rn.cast("string"), 2, "0"))).otherwise(base)).drop("__rn")


def top_k_l2(df: DataFrame, vector: str, probe: Sequence[float] | Column, k: int, key: str) -> DataFrame:
    """The k rows nearest to probe (numbers, or an array column), exact; ties by key. Planned as a distributed top-k."""
    q = probe if isinstance(probe, Column) else F.array(*(F.lit(float(x)) for x in probe))
    squares = F.zip_with(F.col(vector).cast("array<double>"), q, lambda a, b: (a - b) * (a - b))
    return df.withColumn("distance", F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))).orderBy("distance", key).limit(k)
