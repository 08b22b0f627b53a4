"""Question-bank rules: answer tables, issue codes, gates, review filters, staging rows, exports."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names, ocr
from ..functions.text import CORRECTION_NOTE
from .review import ANSWER_CODES
from .rules import severity_rank

# Actions by what they mean for a question or an answer.
READY = ("accept", "unblock")
BLOCKING = ("block", "exclude", "needs_review")
RESETS = ("unreviewed", "reset_review")
AI_RESETS = ("unreviewed", "reset_review", "reset_ai_review")
#: Fields that a correction replaces; image_refs are appended instead.
REPLACED = ("stem", "stem_markup", "stem_image", "options", "answer", "answer_payload", "group_ref", "question_type")
UNRELIABLE_MODELS = ("", "heuristic", "gpt-5.4-mini", "codex-gpt5-pilot")
UNRELIABLE_REVIEWERS = ("batch-ai-audit", "local", "codex-5.4mini-pilot", "codex-pilot-5parts")
OPTION = "struct<key:string,text:string,image:string,raw_order:int>"
REF = "struct<path:string,exists:boolean,bytes:bigint>"


# --- answers -------------------------------------------------------------------------------------


_EITHER = re.I | re.S | re.A
_TABLE, _ROW, _CELL = re.compile(r"<table.*?>(.*?)</table>", _EITHER), re.compile(r"<tr.*?>(.*?)</tr>", _EITHER), re.compile(r"<td[^>]*>(.*?)</td>", _EITHER)
_TAG, _BLANKS, _NUMBER = re.compile(r"<[^>]+>"), re.compile(r"[ \t\n\r\f\x0B]+"), re.compile(r"[0-9]{1,3}")
_NOTE, _LETTER = re.compile(CORRECTION_NOTE, re.A), re.compile(r"[A-E]")
ANSWER = pa.struct([("__at", pa.int32()), ("number", pa.int32()), ("__raw", pa.string()), ("__noted", pa.list_(pa.string()))])


def page_answers(page: str) -> list[tuple[int, int, str, list[str] | None]]:
    """(place, number, answer, accepted by a note) of a page's tables, the last of each number; of several notes the last.

    The row of numbers stands beside the row of answers, blank cells left out first; of several such rows of a table the last counts.
    """
    found, at = {}, 0
    for body in _TABLE.findall(page):
        numbers, answers = [], []
        for row in _ROW.findall(body):
            cells = [_BLANKS.sub(" ", _TAG.sub("", c)).strip(" ") for c in _CELL.findall(row)]
            if cells and cells[0] in ("題號", "題序"):
                numbers = [c for c in cells[1:] if c != ""]
            elif cells and cells[0] == "答案":
                answers = [c for c in cells[1:] if c != ""]
        for head, answer in zip(numbers, answers):  # noqa: B905  the shorter row counts
            if number := _NUMBER.search(head):
                found[int(number[0])] = (at, answer)
                at += 1
    notes = {int(n): _LETTER.findall(accepted) for n, accepted in _NOTE.findall(page)} if found else {}
    return [(place, number, answer, notes.get(number)) for number, (place, answer) in found.items()]


def answers_of(markdown: Column) -> Column:
    """page_answers of each page, in Arrow batches: pages hold so many small cells that expressions on arrays take several times as long."""

    @F.arrow_udf("array<struct<__at:int,number:int,__raw:string,__noted:array<string>>>")
    def answers(column: pa.Array) -> pa.Array:
        ends, rows = [0], []
        for at in range(0, len(column), 128):  # few pages are Python objects at once
            for page in column.slice(at, 128).to_pylist():
                rows += page_answers(page) if page else ()
                ends.append(len(rows))
        columns = list(zip(*rows, strict=True)) or [()] * len(ANSWER)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ANSWER, strict=True)], fields=list(ANSWER)))

    return answers(markdown)


def answer_rows(df: DataFrame, keys: Sequence[str], markdown: str) -> DataFrame:
    """(keys, number, answer, accepted, raw_answer, special): the last answer of each number; `#` takes what the notes accept."""
    rows = df.select(*keys, F.inline(answers_of(F.col(markdown))))
    last = rows.groupBy(*keys, "number").agg(F.max_by(F.struct("__raw", "__noted"), "__at").alias("x"))
    special = (F.col("x.__raw") == "#") & F.col("x.__noted").isNotNull()
    accepted = F.when(special, F.col("x.__noted")).otherwise(F.array("x.__raw"))
    return last.select(*keys, "number", F.array_join(accepted, "|").alias("answer"), accepted.alias("accepted"), F.col("x.__raw").alias("raw_answer"), special.alias("special"))


def with_answers(questions: DataFrame, answers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Questions (keys, number, ...) beside the answers of their documents; missing ones are null."""
    return questions.join(answers, [*keys, "number"], "left")


# --- issues --------------------------------------------------------------------------------------


def with_issues(df: DataFrame, name: str = "issues") -> DataFrame:
    """Candidates (stem, options, answer, image_refs) with the array of their issues (issue_code, severity), which all rules share.

    Options are (key, text, image, raw_order) in order of keys, references (path, exists, bytes). An issue of an
    option or a reference is one for each.
    """
    stem, options, answer = F.coalesce("stem", F.lit("")), F.col("options"), F.col("answer")
    refs = F.coalesce("image_refs", F.array().cast(f"array<{REF}>"))
    labels = F.transform(options, lambda o: o["key"])
    raw = F.transform(F.array_sort(F.transform(options, lambda o: F.struct(o["raw_order"].alias("r"), o["key"].alias("k")))), lambda o: o["k"])
    n = F.size(options)
    expected = F.slice(F.array(*map(F.lit, "ABCDE")), F.lit(1), F.least(n, F.lit(5)))
    visible = F.concat_ws("\n", stem, F.array_join(F.transform(options, lambda o: F.coalesce(o["text"], F.lit(""))), "\n"))
    table = F.contains(F.lower(stem), F.lit("<table")) & F.contains(F.lower(stem), F.lit("</table>"))
    one = lambda code, severity, cond: F.when(cond, F.struct(F.lit(code).alias("issue_code"), F.lit(severity).alias("severity")))
    single = F.array(
        one("empty_stem", "error", stem == ""), one("short_stem", "warning", (stem != "") & (F.length(stem) < 8)), one("suspicious_ocr_chars", "warning", ocr.is_suspicious(stem)),
        one("too_few_options", "error", n < 4), one("duplicate_option_label", "error", F.size(F.array_distinct(labels)) < n), one("option_order_unusual", "warning", (n >= 4) & (raw != expected)),
        one("missing_answer", "info", answer.isNull()), one("unexpected_answer_value", "warning", (answer != "") & ~answer.rlike(r"^[A-E#|/或、]+$")),
        one("image_hint_without_asset", "warning", ocr.has_figure_words(stem) & (F.size(refs) == 0) & ~table),
        one("markup_needs_review", "warning", names.markup_payload(stem)["needs_review"]), one("amino_acid_translation_suspect", "warning", F.size(ocr.anchor_suspects(visible)) > 0),
    )
    of_options = F.transform(options, lambda o: one("empty_option", "error", (F.coalesce(o["text"], F.lit("")) == "") & o["image"].isNull()))
    of_refs = F.transform(refs, lambda r: F.coalesce(one("missing_image_asset", "error", ~r["exists"]), one("empty_image_asset", "error", r["bytes"] == 0)))
    return df.withColumn(name, F.filter(F.concat(single, of_options, of_refs), lambda x: x.isNotNull()))


def candidate_issues(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, issue_code, severity) of candidates: one scan, a row for each issue."""
    return with_issues(df).select(*keys, F.inline("issues"))


def document_failures(documents: DataFrame, parsed: DataFrame, key: str, question: str, answer: str) -> DataFrame:
    """(key, issue_code, severity) of documents without question or answer Markdown, or of which no question was parsed."""
    n = parsed.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    code = F.when(F.col(question).isNull(), "missing_question_markdown").when(F.col(answer).isNull(), "missing_answer_markdown").when(F.col("__n").isNull(), "no_questions_parsed")
    return documents.join(n, key, "left").select(key, code.alias("issue_code"), F.lit("blocked").alias("severity")).filter("issue_code is not null")


def split_statuses(issues: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, question_status, answer_status): codes about answers count for the one, all others for the other."""
    rank, about = severity_rank(F.col("severity")), F.col("issue_code").isin(*ANSWER_CODES)
    status = lambda cond: F.element_at(F.array(F.lit("pass"), F.lit("needs_review"), F.lit("blocked")), F.coalesce(F.max(F.when(cond, rank)), F.lit(0)) + 1)
    return issues.groupBy(*keys).agg(status(~about).alias("question_status"), status(about).alias("answer_status"))


# --- corrections and the formal gate -------------------------------------------------------------


def has_key(json: Column, key: str) -> Column:
    """Whether a JSON object holds the key, be its value null or not."""
    return F.coalesce(F.array_contains(F.json_object_keys(json), key), F.lit(False))


def canonical_json(json: Column) -> Column:
    """JSON in one spelling: keys in order at every depth, no blanks; parsed once, as VARIANT. Null for what is no JSON."""
    return F.to_json(F.try_parse_json(json))


def canonical_hash(json: Column) -> Column:
    """SHA-256 of the canonical spelling: equal under the order of keys and white space."""
    return F.sha2(canonical_json(json), 256)


def typed_paths(json: Column, paths: dict[str, tuple[str, str]]) -> Column:
    """A struct of values {name: (path, type)} out of one parsed VARIANT; null where a path or a cast fails."""
    return ocr.once(F.try_parse_json(json), lambda v: F.struct(*(F.try_variant_get(v, path, kind).alias(name) for name, (path, kind) in paths.items())))


def path_text(json: Column, *paths: str) -> Column:
    """The first non-null of the JSON paths as text, else empty."""
    return F.coalesce(*(F.get_json_object(json, p) for p in paths), F.lit(""))


def array_length(json: Column) -> Column:
    """Length of a JSON array; 0 of anything else."""
    return F.coalesce(F.json_array_length(json), F.lit(0))


def corrected(df: DataFrame, correction: str) -> DataFrame:
    """df with the fields that the correction (a JSON object) holds, null ones too, in place of its own text columns; image_refs (array<string>) are appended."""
    c = F.col(correction)
    out = {f: F.when(has_key(c, f), F.get_json_object(c, f"$.{f}")).otherwise(F.col(f)) for f in REPLACED if f in df.columns}
    if "image_refs" in df.columns:
        more = F.from_json(F.get_json_object(c, "$.image_refs"), "array<string>")
        out["image_refs"] = F.concat(F.coalesce("image_refs", F.array().cast("array<string>")), F.coalesce(more, F.array().cast("array<string>")))
    return df.withColumns(out)


def is_resolved(code: Column, four_options: Column, has_asset: Column, group_ref: Column) -> Column:
    """Whether what a correction gives settles an issue."""
    return F.when(code == "too_few_options", four_options).when(code == "image_hint_without_asset", has_asset).when(code == "missing_group_ref", F.coalesce(group_ref, F.lit("")) != "").otherwise(False)


def formal_gate(df: DataFrame) -> DataFrame:
    """status, reasons and warnings of candidates with quality_status, question_action, question_reset, answer_action,
    answer_reset, open_codes, settled_codes (arrays), group_hint, group_ref, visual_hint, has_asset, markup_hint, has_markup.

    An action is that of the latest event after any reset; null where there is none. Issues count as settled
    only where the question is ready.
    """
    q, a = F.coalesce("question_action", F.lit("")), F.coalesce("answer_action", F.lit(""))
    ready = q.isin(*READY)
    quality = F.coalesce(F.nullif(F.col("quality_status"), F.lit("")), F.lit("missing"))
    codes = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    blocking = F.when(ready, F.col("open_codes")).otherwise(F.concat("open_codes", "settled_codes"))
    group = F.col("group_hint") & (F.coalesce("group_ref", F.lit("")) == "")
    visual = F.col("visual_hint") & ~F.col("has_asset")

    def review(name: str, action: Column, reset: Column) -> Column:
        said = F.when(action.isin(*BLOCKING), F.concat(F.lit(f"{name}_review_not_ready="), action)).otherwise(f"{name}_review_missing_accept")
        return F.when(reset & (action == ""), f"{name}_review_reset_pending").when(~action.isin(*READY), said)

    reasons = F.concat_ws(
        ";", F.when((quality != "pass") & ~ready, F.concat(F.lit("candidate_quality_status="), quality)), review("question", q, F.col("question_reset")), review("answer", a, F.col("answer_reset")),
        F.when(F.size(blocking) > 0, F.concat(F.lit("blocking_parse_issues="), codes(blocking))), F.when(group & ~ready, "group_hint_without_group_ref"), F.when(visual & ~ready, "visual_hint_without_asset"),
    )
    warnings = F.concat_ws(
        ";", F.when((quality != "pass") & ready, F.concat(F.lit("candidate_quality_resolved_by_human_review="), quality)),
        F.when(ready & (F.size("settled_codes") > 0), F.concat(F.lit("blocking_parse_issues_resolved_by_human_correction="), codes(F.col("settled_codes")))),
        F.when(group & ready, "group_hint_without_group_ref_confirmed_by_human_review"), F.when(visual & ready, "visual_hint_without_asset_confirmed_by_human_review"),
        F.when(F.col("markup_hint") & ~F.col("has_markup"), "markup_or_table_fragment_without_markup_json"),
    )
    return df.withColumns({"reasons": reasons, "warnings": warnings}).withColumn("status", F.when(F.col("reasons") == "", "ready").otherwise("blocked"))


# --- review state --------------------------------------------------------------------------------


def review_filter(status: str = "", review: str = "", ai: str = "", q: str = "", search: Sequence[str] = ()) -> Column:
    """The page's filter over question_quality_status, is_reviewed, review_action, correction_json, event_json, ai_reviewed,
    ai_has_suggestion and ai_effective_status; empty values do not filter. q: literal, in the `search` columns."""
    action = F.coalesce("review_action", F.lit("unreviewed"))
    reset = action.isin(*RESETS)
    forms = {
        "": F.lit(True), "not_accept": (F.col("is_reviewed") & ~action.isin("accept", "correct", "unblock")) | reset,
        "correct": F.col("is_reviewed") & (F.col("correction_json").isNotNull() | has_key(F.coalesce("event_json", F.lit("{}")), "correction")),
        "reset_review": reset, "unreviewed": ~F.col("is_reviewed"), "reviewed": F.col("is_reviewed"),
    }
    ai_forms = {
        "": F.lit(True), "unreviewed": ~F.col("ai_reviewed"), "reviewed": F.col("ai_reviewed"), "suggested_correction": F.col("ai_has_suggestion"),
        "needs_review": F.coalesce(F.col("ai_effective_status").isin("needs_review", "block", "blocked"), F.lit(False)),
    }
    kept = forms.get(review, action == review) & ai_forms.get(ai, F.col("ai_effective_status") == ai)
    if status:
        kept = kept & (F.col("question_quality_status") == status)
    if q.strip():
        kept = kept & F.contains(F.lower(F.concat_ws(" ", *search)), F.lit(q.strip().lower()))
    return kept


def suggested_correction(explicit: Column, stem: Column) -> Column:
    """(stem, changes) that an audit suggests: the explicit correction's (a JSON object), else what the tables of OCR repairs give; null without either."""
    derived = ocr.suggestions(stem)
    said = F.struct(F.coalesce(F.get_json_object(explicit, "$.stem"), stem).alias("stem"), F.array(F.lit("explicit")).alias("changes"))
    return F.when(F.coalesce(F.size(F.json_object_keys(explicit)), F.lit(0)) > 0, said).when(F.size(derived["changes"]) > 0, F.struct(derived["text"].alias("stem"), derived["changes"].alias("changes")))


def audit_status(status: Column, deferred_only: Column, has_work: Column) -> Column:
    """What an audit amounts to: deferred answers alone pass, a pass with work to do needs review."""
    plain = F.when(status == "blocked", "block").otherwise(status)
    return F.when(deferred_only, "pass").when((plain == "pass") & has_work, "needs_review").otherwise(F.nullif(plain, F.lit("")))


def batch_reason(known: Column, action: Column, ai: Column, quality: Column) -> Column:
    """Why a key is not accepted in a batch, the first reason that holds; null where it is."""
    return (
        F.when(~known, "not_found").when(action.isin(*BLOCKING), F.concat(F.lit("manual_"), action)).when(action.isin(*READY), "already_accepted")
        .when(ai.isin("needs_review", "block"), F.concat(F.lit("ai_"), ai)).when(quality != "pass", F.concat(F.lit("quality_"), quality))
    )


def repair_active(action: Column, reset: Column, reviewer: Column, sources: Column, prefixes: Sequence[str]) -> Column:
    """Whether a repaired candidate waits for another look: by a repair reviewer, a pending reset or a noted source, and not accepted."""
    by_repair = F.lit(False)
    for p in prefixes:
        by_repair = by_repair | F.startswith(F.coalesce(reviewer, F.lit("")), F.lit(p))
    return ~F.coalesce(action.isin(*READY), F.lit(False)) & (by_repair | (reset & action.isNull()) | (F.size(sources) > 0))


def is_reliable_audit(action: Column, model: Column, reviewer: Column, provider: Column) -> Column:
    """Whether the latest audit counts: not a reset, by a trusted model and reviewer."""
    e = lambda c: F.coalesce(c, F.lit(""))
    return action.isNotNull() & ~action.isin(*AI_RESETS) & ~e(model).isin(*UNRELIABLE_MODELS) & ~e(reviewer).isin(*UNRELIABLE_REVIEWERS) & ((e(provider) == "codex") | F.startswith(e(reviewer), F.lit("codex")))


def to_export(policy: str, action: Column, has_audit: Column, reliable: Column, include_accepted: bool = False) -> Column:
    """Export policy `all`, `pending-only` or (else) whatever lacks a reliable audit; accepted ones stay out unless asked for."""
    wanted = {"all": F.lit(True), "pending-only": ~has_audit}.get(policy, ~reliable)
    return wanted if include_accepted else wanted & ~F.coalesce(action.isin(*READY), F.lit(False))


def rejected_answers(answer: Column, needs_review: Column) -> Column:
    """Why an answer review is refused: an unresolved mark, or a question whose answer needs none; null where it is taken."""
    return F.when(F.contains(F.coalesce(answer, F.lit("")), F.lit("#")), "unresolved_mark").when(~needs_review, "not_eligible")


# --- staging and exports -------------------------------------------------------------------------


def staged_events(events: DataFrame, scope: DataFrame, key: str, actions: Sequence[str]) -> DataFrame:
    """Events of the keys in scope with a known action; AI statuses as pass, needs_review or block; audits default to {}."""
    status = F.trim(F.coalesce(F.nullif(F.col("audit_status"), F.lit("")), F.lit("pass")))
    kept = events.filter(F.col("action").isin(*actions)).join(scope.select(key).distinct(), key, "left_semi")
    return kept.withColumns({"audit_status": F.when(status.isin("block", "blocked"), "block").when(status == "needs_review", "needs_review").otherwise("pass"), "audit_json": F.coalesce(F.nullif(F.col("audit_json"), F.lit("")), F.lit("{}"))})


def staged(df: DataFrame, required: Sequence[str], defaults: dict[str, str]) -> DataFrame:
    """Rows whose required columns are not blank, blanks and nulls in others replaced by defaults."""
    for c in required:
        df = df.filter(F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    return df.withColumns({c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(v)) for c, v in defaults.items()})


def hashed_assets(df: DataFrame, content: str, seq: str, ok: Column, most: int) -> DataFrame:
    """The first `most` good results in order of `seq`, one row for each content: key and the first row's columns."""
    top = df.filter(ok).orderBy(seq).limit(most)
    return top.groupBy(F.sha2(content, 256).alias("asset_key")).agg(F.min_by(F.struct(*df.columns), seq).alias("x")).select("asset_key", "x.*")


def sheet_key(*parts: Column) -> Column:
    return F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))


def compact_options(options: Column) -> Column:
    """(key, text, has_image) of each option."""
    return F.transform(options, lambda o: F.struct(o["key"].alias("key"), o["text"].alias("text"), o["image"].isNotNull().alias("has_image")))


def counter_json(df: DataFrame, keys: Sequence[str], column: str, name: str = "counts") -> DataFrame:
    """Counts of a column's values for each key, as one JSON object in order of the values; nulls are left out."""
    each = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("__n"))
    pairs = F.array_sort(F.collect_list(F.struct(F.col(column).cast("string").alias("k"), "__n")))  # a row for each value
    text = F.transform(pairs, lambda p: F.concat(F.lit('"'), p["k"], F.lit('":'), p["__n"].cast("string")))
    return each.groupBy(*keys).agg(F.concat(F.lit("{"), F.array_join(text, ","), F.lit("}")).alias(name))


def nonblank(df: DataFrame, column: str) -> DataFrame:
    """Distinct trimmed values of a column that are not blank."""
    return df.select(F.trim(column).alias(column)).filter(F.col(column) != "").distinct()


def scoped(df: DataFrame, column: str, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Rows of the included values (all if none are named) that are not excluded."""
    if include:
        df = df.filter(F.col(column).isin(*include))
    return df.filter(~F.coalesce(F.col(column).isin(*exclude), F.lit(False))) if exclude else df


def markdown_table(df: DataFrame, columns: dict[str, str], order: Sequence[Column], first: int) -> DataFrame:
    """(place, line) of a Markdown table of df: two lines of head, then a line for each row; places begin at `first`."""
    from .relational import numbered

    head = [(first, "| " + " | ".join(columns.values()) + " |"), (first + 1, "|" + "---|" * len(columns))]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), F.lit(" |"))
    body = numbered(df.select(*columns), order, "__n")
    return df.sparkSession.createDataFrame(head, "place long, line string").unionByName(body.select((F.col("__n") + first + 1).cast("long").alias("place"), line.alias("line")))
