"""A corpus pipeline: language ID, line dedup, near-duplicate removal, decontamination, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next one's docs. All but the last return the columns of documents, and any extra ones, whatever their names.

Null, empty and blank texts have no language and go in the first stage, so none reaches the others. Of rows that are
alike the one of smallest doc_id (null first) stays, and one of rows equal in
doc_id and text. An empty table, or one of which nothing is left, gives no rows. Very long texts are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import bpe, decontaminate, language, lines, similar
from sluice.llm.common import discard, stored, table

#: A text whose best language has less than this share of the probability is rejected.
SURE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with letters whose language is told with a probability of SURE or more; rows without text go."""
    path = language.default_vocabulary()
    model = language.fit(docs.filter(language.is_training(F.col("doc_id"))), path)
    own = {c: f"__own_{c}" for c in docs.columns if c in ("lang_pred", "score")}
    renamed = docs.withColumnsRenamed(own)
    found = language.identify(renamed, model, path, keep=tuple(renamed.columns))
    sure = found.filter((F.col("lang_pred") != "und") & (F.col("score") >= SURE)).select(*renamed.columns)
    return sure.withColumnsRenamed({v: k for k, v in own.items()})


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line matches go, and rows of which no word is left; n_chars follows the text."""
    own = {c: f"__own_{c}" for c in docs.columns if c in ("n_lines", "n_dropped")}
    found = lines.dedup(docs.withColumnsRenamed(own)).drop("n_lines", "n_dropped").withColumnsRenamed({v: k for k, v in own.items()})
    found = found.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    counted = {"n_chars": F.length("text").cast("long")} if "n_chars" in docs.columns else {}
    return found.withColumns(counted).select(*docs.columns)


def join_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of linked rows stays: that of smallest doc_id."""
    return similar.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which a benchmark item appears go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every row."""
    return bpe.encode(docs, keep=("doc_id", "lang", "source"), digests=True)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("jaccard_join", join_similar),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        now = stored(stage(spark, docs, sf_dir))
        if before is not None:
            discard(before)
        docs = before = now
    return docs


#: Language scores, word edits within passages and tokenisation are not expressible in SQL; see the tests.
ORACLE_SQL = None
