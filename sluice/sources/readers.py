"""Scans: CSV with byte order marks and required columns, strict and lenient JSON lines, listings, latest files, pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Manifest names: anything__category__yA-B__timestamp.csv
MANIFEST = r"__([^/]+?)__y([0-9]+)-([0-9]+)__([0-9-]+)\.csv$"


def read_csv(spark: SparkSession, path, required: Sequence[str] = (), schema: StructType | None = None, header: bool = True, breaks: bool = False) -> DataFrame:
    """A CSV table of strings (or of `schema`) with a header; a byte order mark on the first name is dropped.

    A required column that the file's header lacks fails, with a schema too; an empty file lacks all of them.
    With `breaks`, values may hold line breaks, and each file is one task.
    """
    reader = spark.read.option("header", header).option("multiLine", breaks).option("escape", '"')
    plain = lambda names: [c.removeprefix("\ufeff") for c in names]
    named = reader.csv(path) if schema is None or required and header else None
    columns = plain(named.columns) if named is not None else plain(schema.names)
    missing = [c for c in required if c not in columns]
    if missing:
        raise ValueError(f"{path}: missing columns {', '.join(missing)}")
    df = named if schema is None else reader.schema(schema).csv(path)
    return df.toDF(*plain(df.columns))


def first_bad_lines(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """(path, line, value) of each file's first line that is no JSON of the schema; blank lines are none.

    Files are read in splits. A split counts its lines and names its first bad one in one partial aggregation; the lines
    before it are summed over the splits of its file, a row each.
    """
    full = StructType([*schema.fields]).add("_corrupt_record", "string")
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    bad = (F.trim("value") != "") & (parsed.isNull() | parsed["_corrupt_record"].isNotNull())
    splits = rows.groupBy("path", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"), F.min(F.when(bad, F.struct("at", "value"))).alias("bad"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = splits.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).filter("bad is not null")
    lines = placed.select("path", F.struct((F.col("bad.at") - F.col("first") + F.col("before") + 1).alias("line"), F.col("bad.value").alias("value")).alias("x"))
    return lines.groupBy("path").agg(F.min("x").alias("x")).select("path", "x.line", "x.value")


def read_jsonl_strict(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """JSON lines; a bad line fails at once, named by its file and line."""
    found = first_bad_lines(spark, path, schema).orderBy("path").first()
    if found:
        raise ValueError(f"{found['path']}:{found['line']}: not a JSON line of the schema: {found['value'][:200]}")
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_lenient(spark: SparkSession, path, schema: StructType, key: str) -> DataFrame:
    """JSON lines of an event log; bad lines and lines without the key are left out."""
    full = StructType([*schema.fields]).add("_corrupt_record", "string")
    rows = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    return rows.filter(F.col("_corrupt_record").isNull() & F.col(key).isNotNull() & (F.col(key).cast("string") != "")).drop("_corrupt_record")


def files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, modificationTime and length of all files below path that have bytes; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return found.select("path", "modificationTime", "length")


def latest_path(listing: DataFrame) -> DataFrame:
    """The lexicographically last path."""
    return listing.agg(F.max("path").alias("path"))


def latest_manifests(listing: DataFrame) -> DataFrame:
    """Latest manifest of each category, by the timestamp in its name, in order of category."""
    part = lambda g: F.regexp_extract("path", MANIFEST, g)
    named = listing.filter(F.col("path").rlike(MANIFEST)).select("path", part(1).alias("category"), part(4).alias("ts"))
    return named.groupBy("category").agg(F.max_by("path", F.struct("ts", "path")).alias("path"), F.max("ts").alias("ts")).orderBy("category")


def last_row_by_path(df: DataFrame, key: str) -> DataFrame:
    """Rows of many files; the row of the file changed last wins for each key, later lines over earlier ones.

    Within a part of a file, rows come in the order of their lines, and monotonically_increasing_id rises with them.
    """
    order = F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("line"))
    columns = df.columns
    return df.select("*", order.alias("__o")).groupBy(key).agg(F.max_by(F.struct(*columns), "__o").alias("x")).select("x.*")


def relative_paths(listing: DataFrame, root: str) -> DataFrame:
    """Distinct paths below `root`, without it; paths elsewhere stay whole."""
    mark = F.lit("/" + root.strip("/") + "/")
    at = F.instr(F.concat(F.lit("/"), F.col("path")), mark)
    return listing.select(F.when(at > 0, F.substring("path", at + len("/" + root.strip("/") + "/") - 1, F.length("path"))).otherwise(F.col("path")).alias("relative")).distinct()


def empty_files(spark: SparkSession, path: str) -> DataFrame:
    """Paths of the files without bytes below path, which scans leave out; from the file system's listing."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found, out = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(hadoop, True), []
    while found.hasNext():
        status = found.next()
        if not status.getLen():
            out.append((status.getPath().toString(),))
    return spark.createDataFrame(out, "path string")


def folder_counts(listing: DataFrame, empty: DataFrame) -> DataFrame:
    """Files of each folder, and how many of them are empty."""
    rows = listing.select("path", F.lit(0).alias("e")).unionByName(empty.select("path", F.lit(1).alias("e")))
    return rows.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).agg(F.count(F.lit(1)).alias("n"), F.sum("e").alias("n_empty"))


def images(listing: DataFrame) -> DataFrame:
    return listing.filter(F.lower("path").rlike(r"\.(png|jpe?g|webp)$"))


def markdown_documents(spark: SparkSession, path: str) -> DataFrame:
    """path and whole text of every Markdown file; bytes that are not UTF-8 become U+FFFD."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md").select(F.col("_metadata.file_path").alias("path"), F.make_valid_utf8("value").alias("text"))


def resolve_markdown(wanted: DataFrame, listing: DataFrame, modes: Sequence[str] = ("vlm", "hybrid_auto", "ocr")) -> DataFrame:
    """Best Markdown file of each (stem): modes in order, else the first path."""
    stem = F.regexp_extract("path", r"([^/]+)\.md$", 1)
    rank = F.lit(len(modes))
    for i, mode in reversed(list(enumerate(modes))):
        rank = F.when(F.contains("path", F.lit(f"/{mode}/")), i).otherwise(rank)
    best = listing.filter(F.endswith("path", F.lit(".md"))).groupBy(stem.alias("stem")).agg(F.min_by("path", F.struct(rank, F.col("path"))).alias("markdown"))
    return wanted.join(best, "stem", "left")


def index_by_stem(df: DataFrame, path: str, seq: str) -> DataFrame:
    """One row for each file stem, the last."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]*$", "")
    return df.groupBy(stem.alias("stem")).agg(F.max_by(F.struct(*df.columns), F.col(seq)).alias("x")).select("stem", "x.*")


def option_list(pages: DataFrame, html: str, first: int, last: int) -> DataFrame:
    """(code, label) of <option> entries whose code begins with a year from first to last."""
    pattern = F.lit(r'(?is)<option[^>]*value="([^"]*)"[^>]*>(.*?)</option>')
    pairs = F.arrays_zip(F.regexp_extract_all(html, pattern, F.lit(1)).alias("code"), F.regexp_extract_all(html, pattern, F.lit(2)).alias("label"))
    rows = pages.select(F.inline(pairs))
    return rows.filter(F.substring("code", 1, 3).try_cast("int").between(first, last))


def catalog_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Subjects of catalog pages: check-box labels and file links merged by (category, subject), role flags set.

    Labels carry `chk_{exam}_{category}_{subject}`; links carry t (role), code, c and s in their query.
    Links without a label become rows of their own, with a note.
    """
    label = F.lit(r'(?is)<label[^>]*for="chk_([0-9]+)_([0-9A-Za-z]+)_([0-9A-Za-z]+)"[^>]*>(.*?)</label>')
    groups = F.arrays_zip(*(F.regexp_extract_all(html, label, F.lit(i)).alias(n) for i, n in enumerate(("exam", "category", "subject", "name"), 1)))
    labels = pages.select(F.inline(groups)).withColumn("name", F.trim(F.regexp_replace(F.regexp_replace("name", "<[^>]+>", ""), r"\s+", " ")))
    labels = labels.groupBy("exam", "category", "subject").agg(F.min("name").alias("name"))
    url = pages.select(F.explode(F.regexp_extract_all(html, F.lit(r'href="([^"]*[?&]t=[A-Z][^"]*)"'), F.lit(1))).alias("url")).withColumn("url", F.replace("url", F.lit("&amp;"), F.lit("&")))
    value = lambda k: F.regexp_extract("url", rf"[?&]{k}=([^&#]*)", 1)
    links = url.select("url", value("t").alias("role"), value("code").alias("exam"), value("c").alias("category"), value("s").alias("subject"))
    roles = {"Q": "question_url", "S": "answer_url", "M": "correction_url"}
    links = links.groupBy("exam", "category", "subject").agg(*(F.max(F.when(F.col("role") == r, F.col("url"))).alias(n) for r, n in roles.items()))
    joined = labels.join(links, ["exam", "category", "subject"], "full_outer")
    return joined.select(
        "exam", "category", "subject", "name", *roles.values(), *(F.col(n).isNotNull().alias("has_" + n.removesuffix("_url")) for n in roles.values()),
        F.concat_ws("; ", F.when(F.col("name").isNull(), "link without label"), F.when(F.col("question_url").isNull(), "no question link")).alias("notes"),
    ).orderBy("exam", "category", "subject")
