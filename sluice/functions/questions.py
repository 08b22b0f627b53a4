"""A question's block taken apart: stem, options, group and type, as Column expressions.

Option marks are `(A)`, `A.` and the like at a line's start or after a blank, or `A-` before a small letter. The
options are one run of marks with different letters: of all places where a run may start, the one that gives A to
D, else one that starts with A, else the longest. A letter that the run already has ends it, unless the mark is
`A-` or `A、`, which may stand within a text; `E. coli` is never a mark.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import group_ref, strip

# How an option's mark may be written, after an optional command for upright letters.
MARK = r"(?m)(?:^|\s+)(?:\$\s*)?(?:\\(?:mathrm|mathbf|text)\{)?(?:[（(]([A-E])[)）]|([A-E])\}?[.、．·]|([A-E])-(?=[a-z]))\s*"
RUN = "struct<seen:array<string>,picked:array<int>,over:boolean>"


def once(value: Column, f) -> Column:
    """f of a value that is computed once, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def pieces(body: Column) -> Column:
    """Array of (i, label, mark, text): each mark with the text up to the next one."""
    parts = F.split(F.regexp_replace(body, MARK, "\u0001$1$2$3$0\u0002"), "\u0001")
    return F.transform(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda p, i: F.struct(i.alias("i"), F.substring(p, 1, 1).alias("label"), F.substring(F.substring_index(p, "\u0002", 1), F.lit(2), F.length(p)).alias("mark"), F.substring(p, F.instr(p, "\u0002") + 1, F.length(p)).alias("text")),
    )


def run_from(marks: Column, first: Column) -> Column:
    """Places of the run of marks that starts at `first`."""

    def step(state: Column, m: Column) -> Column:
        organism = (m["label"] == "E") & m["text"].rlike(r"(?i)^\s*coli\b")
        within = F.trim(m["mark"]).rlike(r"^\s*[A-E](-|、)\s*$")
        met = F.array_contains(state["seen"], m["label"])
        taken = F.struct(F.concat(state["seen"], F.array(m["label"])).alias("seen"), F.concat(state["picked"], F.array(m["i"])).alias("picked"), F.lit(False).alias("over"))
        ended = F.struct(state["seen"].alias("seen"), state["picked"].alias("picked"), F.lit(True).alias("over"))
        return F.when(state["over"] | (m["i"] < first) | organism | (met & within), state).when(met, ended).otherwise(taken).cast(RUN)

    none = F.struct(F.array().cast("array<string>").alias("seen"), F.array().cast("array<int>").alias("picked"), F.lit(False).alias("over")).cast(RUN)
    return F.aggregate(marks, none, step, lambda s: s)


def best_run(marks: Column) -> Column:
    """Places of the marks that are options; with fewer than two, those at the start of a line."""

    def scored(first: Column) -> Column:
        return once(run_from(marks, first), lambda r: F.struct(
            F.forall(F.array(*map(F.lit, "ABCD")), lambda x: F.array_contains(r["seen"], x)).cast("int").alias("whole"), (F.get(r["seen"], F.lit(0)) == "A").cast("int").alias("from_a"), F.size(r["picked"]).alias("n"), (-first).alias("first"), r["picked"].alias("picked"),
        ))

    best = F.array_max(F.transform(F.sequence(F.lit(0), F.size(marks) - 1), scored))
    lines = F.transform(F.filter(marks, lambda m: m["mark"].rlike(r"^(\s*\n)?\s*[（(A-E]") & (F.contains(m["mark"], F.lit("\n")) | (m["i"] == 0))), lambda m: m["i"])
    return F.when(F.size(marks) == 0, F.array().cast("array<int>")).otherwise(once(best, lambda b: F.when(b["n"] >= 2, b["picked"]).otherwise(lines)))


def question(number: Column, body: Column) -> Column:
    """(number, stem, options, group_ref, question_type) of a block; options are (key, raw_order, text) in order of keys."""

    def built(marks: Column) -> Column:
        def with_run(run: Column) -> Column:
            text = lambda a, b: F.array_join(F.transform(F.filter(marks, lambda m: (m["i"] >= a) & (m["i"] < b)), lambda m: F.when(m["i"] == a, m["text"]).otherwise(F.concat(m["mark"], m["text"]))), "")
            options = F.transform(run, lambda at, j: F.struct(F.get(marks, at)["label"].alias("key"), (j + 1).alias("raw_order"), strip(text(at, F.coalesce(F.get(run, j + 1), F.size(marks)))).alias("text")))
            head = F.substring_index(F.regexp_replace(body, MARK, "\u0001$0"), "\u0001", 1)
            before = F.array_join(F.transform(F.filter(marks, lambda m: m["i"] < F.get(run, F.lit(0))), lambda m: F.concat(m["mark"], m["text"])), "")
            stem = strip(F.when(F.size(run) > 0, F.concat(head, before)).otherwise(body))
            kind = F.when(F.size(run) > 0, "multiple_choice").otherwise("unknown")
            return F.struct(number.alias("number"), stem.alias("stem"), F.array_sort(options).alias("options"), group_ref(stem, number).alias("group_ref"), kind.alias("question_type"))

        return once(best_run(marks), with_run)

    return once(pieces(body), built)


# --- many marks: one look at each ------------------------------------------------------------------

#: What a mark's kind says: an organism's name, a mark that may stand within a text, any other.
ORGANISM, WITHIN, PLAIN = "owp"


def run_of(labels: str, kinds: str) -> list[int]:
    """Places of the best run of marks, by one scan from the last mark to the first.

    A run that starts at a mark takes the first mark of each letter from there on, and ends where a plain mark repeats a letter
    that it has. So it is told by the next mark of each letter and the plain mark of that letter behind it, which the
    scan keeps for five letters. Of equal runs the first start counts, so a later look replaces an earlier one.
    """
    first: dict[str, int] = {}
    plain: dict[str, int] = {}
    ends: dict[str, int] = {}
    best, score = [], (0, 0, 0)
    for i in range(len(labels) - 1, -1, -1):
        label, kind = labels[i], kinds[i]
        if kind != ORGANISM:
            first[label], ends[label] = i, plain.get(label, len(labels))
            if kind == PLAIN:
                plain[label] = i
        end = min(ends.values(), default=len(labels))
        taken = sorted(at for at in first.values() if at < end)
        letters = {labels[at] for at in taken}
        now = (int(letters >= set("ABCD")), int(bool(taken) and labels[taken[0]] == "A"), len(taken))
        if now >= score:
            best, score = taken, now
    return best


def best_runs(labels: Column, kinds: Column) -> Column:
    """run_of each row's marks."""

    @F.arrow_udf("array<int>")
    def runs(labels: pa.Array, kinds: pa.Array) -> pa.Array:
        return pa.array([run_of(x or "", k or "") for x, k in zip(labels.to_pylist(), kinds.to_pylist(), strict=True)], pa.list_(pa.int32()))

    return runs(labels, kinds)


def with_question(df, number: str, body: str):
    """df with stem, options (key, raw_order, text), group_ref and question_type of its blocks, as `question` gives them.

    Takes time in proportion to the marks of a block: the run is one scan in an Arrow batch, the rest is columns.
    """
    kind = lambda m: F.when((m["label"] == "E") & m["text"].rlike(r"(?i)^\s*coli\b"), ORGANISM).when(F.trim(m["mark"]).rlike(r"^\s*[A-E](-|、)\s*$"), WITHIN).otherwise(PLAIN)
    joined = lambda f: F.array_join(F.transform("__marks", f), "")
    marked = df.withColumn("__marks", pieces(F.col(body)))
    marked = marked.withColumns({"__labels": joined(lambda m: m["label"]), "__kinds": joined(kind)})
    marked = marked.withColumn("__best", F.when(F.size("__marks") > 0, best_runs(F.col("__labels"), F.col("__kinds"))).otherwise(F.array().cast("array<int>")))
    lines = F.transform(F.filter("__marks", lambda m: m["mark"].rlike(r"^(\s*\n)?\s*[（(A-E]") & (F.contains(m["mark"], F.lit("\n")) | (m["i"] == 0))), lambda m: m["i"])
    marked = marked.withColumn("__run", F.when(F.size("__best") >= 2, F.col("__best")).otherwise(lines))
    marks, run = F.col("__marks"), F.col("__run")
    said = lambda a, b: F.array_join(F.transform(F.slice(marks, a + 1, b - a), lambda m, j: F.when(j == 0, m["text"]).otherwise(F.concat(m["mark"], m["text"]))), "")
    options = F.transform(run, lambda at, j: F.struct(F.get(marks, at)["label"].alias("key"), (j + 1).alias("raw_order"), strip(said(at, F.coalesce(F.get(run, j + 1), F.size(marks)))).alias("text")))
    head = F.substring_index(F.regexp_replace(F.col(body), MARK, "\u0001$0"), "\u0001", 1)
    before = F.array_join(F.transform(F.slice(marks, F.lit(1), F.coalesce(F.get(run, F.lit(0)), F.lit(0))), lambda m: F.concat(m["mark"], m["text"])), "")
    out = {"stem": strip(F.when(F.size(run) > 0, F.concat(head, before)).otherwise(F.col(body))), "options": F.array_sort(options), "question_type": F.when(F.size(run) > 0, "multiple_choice").otherwise("unknown")}
    return marked.withColumns(out).withColumn("group_ref", group_ref(F.col("stem"), F.col(number))).drop("__marks", "__labels", "__kinds", "__best", "__run")
