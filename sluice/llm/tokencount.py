"""Token counts at every prefix of a text, by dynamic programming over its bytes.

A byte sequence has one BPE encoding, and every prefix of that encoding is the encoding of the bytes it covers. So the
last token of a prefix is the one token that ends there, follows the last token of the prefix before it, and whose pair
with that token is left alone by the merges; the count is that prefix's count plus one. An automaton over the vocabulary
names the tokens that end at each byte, so a run of n bytes takes time in proportion to n, and all its prefixes
are counted at once. Runs are those of the byte-level pattern; the counts of runs and words met before are remembered in a bounded
table. Where a cut text falls into other runs than the whole one (within a contraction, after white space, within a special
token) its end is counted anew.

`prefix_index` stores the counts; `tokens_before`, `longest_within` and `truncated` answer from them, without a tokenizer.
A longer prefix can have fewer tokens, so the longest within a budget is the last one that fits, not the first that does not.

Nulls and empty texts have no tokens and the single count 0. Every row yields one row, repeated rows too; an
empty table gives none. Texts of any length are taken whole. Columns that are not kept are left out, so names never clash.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import NEWER, byte_letters, one_of
from .common import table

NAME = "op13_token_counts"
LIMIT = 1024
REMEMBERED = 600_000
PAIR, NEVER = 20, 1 << 40
#: Runs at its end that a cut text may have in another form than the whole one: white space, a special token and what is before them.
CHANGED = 4
#: Runs of more characters are counted anew each time.
LONGEST_REMEMBERED = 64
# The pattern of byte-level vocabularies, and its contractions of two letters.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTRACTIONS = ("'re", "'ve", "'ll")

# Capitals that are no letters to the library, beside those of NEWER.
NEWER_LETTERS = NEWER + "A7D2 A7D4"
IS_NEWER = regex.compile(one_of(NEWER_LETTERS))
NO_LETTER = "\ue000"
RUNS = regex.compile(PATTERN)
BLANKS = regex.compile(r"(?<!\s)\s{2,}+(?=\S)")
BLANK = regex.compile(r"(?<=\S) ")
WHITE = [chr(c) for c in range(0x3001) if regex.match(r"\s", chr(c))]
LAST_LETTER = regex.compile(r"(?r)\S")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Remembered(dict):
    """Counts of runs by their text, worked out when first asked for."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, run: str):
        value = self.of(run)
        if len(run) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[run] = value
        return value


class PrefixCounter:
    """Counts of a byte-level BPE file. Texts are held as strings of one character for each byte."""

    def __init__(self, path: str):
        spec = json.loads(open(path, encoding="utf-8").read())
        byte_of = {c: chr(b) for b, c in enumerate(byte_letters())}
        added = [t["content"] for t in spec["added_tokens"]]
        tokens = {t: "".join(byte_of[c] for c in t) for t in spec["model"]["vocab"] if t not in added}
        self.number = {t: i for i, t in enumerate(tokens.values())}
        self.rank: dict[int, int] = {}
        made: dict[int, tuple[int, int, int]] = {}  # of a token its halves and the rank of their merge
        for r, (a, b) in enumerate(spec["model"]["merges"]):
            left, right, whole = self.number[tokens[a]], self.number[tokens[b]], self.number[tokens[a] + tokens[b]]
            self.rank[left << PAIR | right] = r
            made.setdefault(whole, (left, right, r))
        # of a token its last (first) parts from the byte up, each with the rank of the merge that takes it in
        self.lasts, self.firsts = ([self.spine(t, made, side) for t in self.number.values()] for side in (1, 0))
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.added = frozenset(added)
        self.automaton = ahocorasick.Automaton()
        for t, i in self.number.items():
            self.automaton.add_word(t, (i, len(t)))
        self.automaton.make_automaton()
        self.stays: dict[int, bool] = {}
        self.all_counts = Remembered(self.run_counts)
        self.counts = Remembered(lambda run: self.byte_counts(run.encode().decode("latin-1"))[-1])
        self.words = Remembered(lambda word: sum(map(self.counts.__getitem__, self.runs(" " + word))))

    @staticmethod
    def spine(token: int, made: dict[int, tuple[int, int, int]], side: int) -> list[tuple[int, int]]:
        out = [(token, NEVER)]
        while token in made:
            rank, token = made[token][2], made[token][side]
            out.append((token, rank))
        return out[::-1]

    def side_by_side(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b ends in the tokens a and b.

        Merges run by rank, as a merge can only enable later ones. So the part before the border and the part behind it
        grow along the spines of a and b, until a merge of the two comes first (of equal ranks the one further left).
        """
        before, behind, rank = iter(self.lasts[a]), iter(self.firsts[b]), self.rank
        (x, grows), (y, starts) = next(before), next(behind)
        while True:
            across = rank.get(x << PAIR | y, NEVER)
            if across < grows and across <= starts:
                return False
            if grows == starts == NEVER:
                return True
            if grows <= starts:
                x, grows = next(before)
            else:
                y, starts = next(behind)

    def byte_counts(self, data: str) -> list[int]:
        """Tokens of every prefix of one run, by bytes."""
        count, last, stays = [0] * (len(data) + 1), [0] * (len(data) + 1), self.stays
        for end, (token, size) in self.automaton.iter(data):
            end += 1
            if count[end]:
                continue
            start = end - size
            if start:
                pair = last[start] << PAIR | token
                if (fits := stays.get(pair)) is None:
                    if len(stays) >= REMEMBERED:
                        stays.clear()
                    fits = stays[pair] = self.side_by_side(last[start], token)
                if not fits:
                    continue
            count[end], last[end] = count[start] + 1, token
        return count

    def run_counts(self, run: str) -> np.ndarray:
        """Tokens of every prefix of one run of the pattern, by characters, the empty one left out."""
        data = run.encode()
        counts = np.array(self.byte_counts(data.decode("latin-1"))[1:], np.int32)
        if len(data) > len(run):
            ends = np.ones(len(data), bool)
            ends[:-1] = (np.frombuffer(data, np.uint8)[1:] & 0xC0) != 0x80
            counts = counts[ends]
        if run in CONTRACTIONS:  # cut after its first letter, it is no contraction
            counts[1] = self.counts[run[0]] + self.counts[run[1]]
        return counts

    @staticmethod
    def runs(text: str) -> list[str]:
        if text.isascii() or not IS_NEWER.search(text):
            return RUNS.findall(text)
        return [text[m.start() : m.end()] for m in RUNS.finditer(IS_NEWER.sub(NO_LETTER, text))]

    @staticmethod
    def split(part: str) -> list[str]:
        """What lies between blanks behind another character: no run goes on over such a blank."""
        after_white = any(c + " " in part for c in WHITE if c in part)
        return BLANK.split(part) if after_white else part.split(" ")

    def totals(self, part: str) -> tuple[list[str], list[int]]:
        """The words of a text without special tokens, and the tokens up to the end of each."""
        first, *rest = words = self.split(part)
        return words, list(accumulate(map(self.words.__getitem__, rest), initial=sum(map(self.counts.__getitem__, self.runs(first)))))

    def count(self, text: str) -> int:
        return sum(1 if part in self.added else self.totals(part)[1][-1] for part in self.parts(text))

    def measure(self, text: str, limit: int) -> tuple[int, int]:
        """Tokens of the whole text, and characters of its longest prefix of at most `limit`.

        Every run has a token, and a cut changes no run before the word that it goes through; so only the prefixes of the
        word that passes the limit are counted one by one.
        """
        if len(self.parts(text)) > 1:
            n = self.count(text)
            return n, len(text) if n <= limit else self.longest_beside_special(text, limit)
        words, totals = self.totals(text)
        at = bisect_right(totals, limit)
        if at == len(totals):
            return totals[-1], len(text)
        before, word = (totals[at - 1], " " + words[at]) if at else (0, words[0])
        start = at - 1 + sum(map(len, words[:at])) if at else 0
        return totals[-1], start + int(np.flatnonzero(before + self.prefix_counts(word) <= limit)[-1])

    def longest_beside_special(self, text: str, limit: int) -> int:
        """The same where special tokens stand, which a cut takes apart: runs around the limit, CHANGED behind it."""
        total, at, over, begun = 0, 0, 0, []  # begun: where each run starts, and the tokens before it
        for part in self.parts(text):
            special, start = part in self.added, 0
            seen = part if special or part.isascii() else IS_NEWER.sub(NO_LETTER, part)
            for end in [len(part)] if special else (m.end() for m in RUNS.finditer(seen)):
                begun.append((at + start, total))
                total += 1 if special else self.counts[part[start:end]]
                over += total >= limit
                if over > CHANGED:
                    return self.last_fit(text[: at + end], begun, limit)
                start = end
            at += len(part)
        return self.last_fit(text, begun, limit)

    def last_fit(self, text: str, begun: list[tuple[int, int]], limit: int) -> int:
        back = max(0, len(begun) - 2 * CHANGED - 2)
        while back and text[begun[back][0] - 1].isspace():
            back -= 1
        start, tokens = begun[back] if begun else (0, 0)
        fits = np.flatnonzero(tokens + self.prefix_counts(text[start:]) <= limit)
        return start + int(fits[-1])

    def parts(self, text: str) -> list[str]:
        return self.special.split(text) if any(t in text for t in self.added) else [text]

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of text[:p] for p from 0 to its length."""
        pieces, base = [np.zeros(1, np.int32)], 0
        before = ""  # the part before a special token
        for part in self.parts(text):
            if part in self.added:
                last = LAST_LETTER.search(before)
                tail = self.runs(before[: last.start() + 1])[-1] + before[last.start() + 1 :] if last else before
                under = base - sum(map(self.counts.__getitem__, self.runs(tail)))
                ends = [under + sum(map(self.counts.__getitem__, self.runs(tail + part[:k]))) for k in range(1, len(part))]
                pieces.append(np.array([*ends, base + 1], np.int32))
                base, before = base + 1, ""
                continue
            before = part
            if not part:
                continue
            found = [self.all_counts[run] for run in self.runs(part)]
            bases = np.concatenate([[0], np.cumsum([c[-1] for c in found])])
            inner = np.concatenate(found) + np.repeat(bases[:-1], [len(c) for c in found])
            for m in BLANKS.finditer(part):  # cut after its last blank, the white space is one run
                inner[m.end() - 1] = (inner[m.start() - 1] if m.start() else 0) + self.counts[m[0]]
            pieces.append((base + inner).astype(np.int32))
            base += int(bases[-1])
        return np.concatenate(pieces)


_loaded: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _loaded:
        _loaded[path] = PrefixCounter(path)
    return _loaded[path]


def _mapped(docs: DataFrame, text: str, keep: tuple[str, ...], more: str, of) -> DataFrame:
    """keep, and the columns `more` that of(value) gives for each text."""
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"`{k}` {fields[k]}" for k in keep), more])
    names = [x.split()[0] for x in more.split(", ")]
    kinds = {"long": pa.int64(), "array<int>": pa.list_(pa.int32())}
    types = [kinds[x.split()[1]] for x in more.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [of(value or "") for value in part.column(len(keep)).to_pylist()]
                made = [pa.array(list(column), kind) for column, kind in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *made], [*keep, *names])

    return docs.select(*(docs[k] for k in keep), docs[text].alias("__text")).mapInArrow(run, schema)


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """n_tokens of every text, and fit_chars: characters of its longest prefix of at most `limit` tokens."""
    path = path or default_vocabulary()
    return _mapped(docs, text, keep, "n_tokens long, fit_chars long", lambda value: counter(path).measure(value, limit))


def prefix_index(docs: DataFrame, path: str | None = None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`counts` of every text: the tokens of its prefixes of 0, 1, 2 ... characters, to be stored and asked."""
    path = path or default_vocabulary()
    return _mapped(docs, text, keep, "counts array<int>", lambda value: (counter(path).prefix_counts(value),))


def tokens_before(counts: Column, chars: Column) -> Column:
    """Tokens of the first `chars` characters; of the whole text if it has fewer."""
    return F.get(counts, F.least(F.greatest(chars, F.lit(0)), F.size(counts) - 1))


def longest_within(counts: Column, budget: Column) -> Column:
    """Characters of the longest prefix of at most `budget` tokens; null for a budget below 0."""
    fits = F.array_position(F.transform(F.reverse(counts), lambda c: c <= budget), F.lit(True))
    return F.when(fits > 0, F.size(counts) - fits)


def truncated(text: Column, counts: Column, budget: Column) -> Column:
    """The longest prefix of text of at most `budget` tokens."""
    return F.substring(text, F.lit(1), longest_within(counts, budget).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    found = token_counts(docs, keep=("doc_id", "n_bytes"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "fit_chars")
