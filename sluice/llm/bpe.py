"""BPE encoding and decoding with a contiguous array of part ranks.

A word is held as its parts and, beside them, the merge rank of every pair of neighbouring parts. The
array is scanned for its minimum, the boundary there is deleted, the ranks of its neighbours are
refreshed, and so on until no pair has a rank. Words are encoded once and remembered in a bounded table;
words of more than LONG parts, where repeated scans would cost the square of the length, take the same
merges from a heap.

Nulls and empty texts have no tokens. Every row yields one row, repeated rows too; an empty table gives none. Texts
of any length are taken whole. Columns that are not kept are left out, so their names never clash.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import Remembered, kept, table

NAME = "op5_bpe_round_trip"
LONG = 200
REMEMBERED = 300_000
# Letters and digits that are newer than the library's Unicode, and so neither to it.
NEWER = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7
10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6
187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24
1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF
2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""
# Capitals that the library lowers and Python does not yet, with their small letters.
NEWER_CAPITALS = {
    0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
    **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}
# Combining characters that are newer than the library's normalisation, which neither reorders nor composes them.
NEWER_MARKS = """
7FD 898-89F 8CA-8D3 9FE C3C D3B-D3C EBA 1715 1ABF-1ACE 1DF6-1DFA A82C 10D24-10D27 10EAB-10EAC 10EFD-10EFF 10F46-10F50
10F82-10F85 11070 1133B 1145E 11839-1183A 11930 1193D-1193E 11943 119E0 11A34 11A47 11A99 11D42 11D44-11D45 11D97
11F41-11F42 16FF0-16FF1 1E08F 1E130-1E136 1E2AE 1E2EC-1E2EF 1E4EC-1E4EF
"""


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


HAS_NEWER_CAPITAL = re.compile("[" + "".join(map(chr, NEWER_CAPITALS)) + "]").search


def one_of(ranges: str) -> str:
    """A character class of hexadecimal ranges."""
    return "[" + "".join("-".join(chr(int(x, 16)) for x in r.split("-")) for r in ranges.split()) + "]"


IS_NEWER = regex.compile(one_of(NEWER))
NEWER_MARK = re.compile(f"({one_of(NEWER_MARKS)})")


class WordBPE:
    """The tokenizer of a word-level BPE file: NFC, white space to one blank, lower case, pattern, merges."""

    def __init__(self, path: str, longest_scanned: int = LONG, remembered: int = REMEMBERED):
        spec = json.loads(open(path, encoding="utf-8").read())
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.token = {i: t for t, i in self.vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token.update({i: t for t, i in self.added.items()})
        self.names = {i: (str(i), t) for i, t in self.token.items()}
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for a, b in model["merges"]:
            self.rank[self.vocab[a] << 32 | self.vocab[b]] = len(self.merged)
            self.merged.append(self.vocab[a + b])
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern)
        self.special = regex.compile("(" + "|".join(regex.escape(t) for t in self.added) + ")")
        letters = byte_letters()
        self.inner = [self.vocab[c] for c in letters]
        self.final = [self.vocab[c + self.suffix] for c in letters]
        self.longest_scanned = longest_scanned
        self.known = Remembered(remembered)  # by word: (ids, their number, decoded text)

    def merge(self, parts: list[int]) -> list[int]:
        if len(parts) > self.longest_scanned:
            return self.merge_long(parts)
        none = len(self.merged)
        rank, merged = self.rank.get, self.merged
        ranks = [rank(a << 32 | b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            parts[i] = merged[least]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 32 | parts[i], none)
            if i < len(ranks):
                ranks[i] = rank(parts[i] << 32 | parts[i + 1], none)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges in the same order (rank, then place), by a heap over linked parts."""
        n = len(parts)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := self.rank.get(parts[i] << 32 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j] = self.merged[r], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := self.rank.get(parts[x] << 32 | parts[y])) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p in parts if p >= 0]

    def chunk(self, chunk: str) -> tuple[str, int, str]:
        """Ids, their number and the decoded text of a run of characters other than white space."""
        if chunk.isalpha():  # one piece: the pattern's run of letters
            data = chunk.encode()
            inner = self.inner
            ids = [inner[b] for b in data]
            ids[-1] = self.final[data[-1]]
            return self.said(self.merge(ids))
        if chunk[-1] in ".,;:!?" and (word := chunk[:-1]).isalpha():  # a word and a mark: two pieces
            got = self.known.get(word) or self.chunk(word)
            mark = self.final[ord(chunk[-1])]
            return f"{got[0]} {mark}", got[1] + 1, f"{got[2]} {self.token[mark]}"
        ids: list[int] = []
        seen = chunk if chunk.isascii() else IS_NEWER.sub("\ue000", chunk)
        for m in self.pieces.finditer(seen):
            data = chunk[m.start() : m.end()].encode("utf-8", "surrogatepass")
            ids += self.merge([*(self.inner[b] for b in data[:-1]), self.final[data[-1]]])
        return self.said(ids)

    def said(self, ids: list[int]) -> tuple[str, int, str]:
        names = self.names
        return " ".join([names[i][0] for i in ids]), len(ids), " ".join([names[i][1] for i in ids])

    def normal(self, text: str) -> str:
        if not text.isascii():
            if NEWER_MARK.search(text):
                text = "".join(unicodedata.normalize("NFC", part) for part in NEWER_MARK.split(text))
            else:
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # lower case letter by letter
            if HAS_NEWER_CAPITAL(text):
                text = text.translate(NEWER_CAPITALS)
        return text.lower()

    def split(self, text: str) -> list[str]:
        found = text.split()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # blanks to str.split, but not white space in Unicode
            found = regex.findall(r"[^\t-\r \x85\xa0  -     　]+", text)
        return found

    def encode(self, text: str) -> tuple[str, int, str]:
        """(ids joined by a blank, their number, the decoded text)."""
        if "<|" in text:
            parts = self.special.split(text)
        else:
            parts = [text]
        ids, decoded, n = [], [], 0
        for part in parts:
            if part in self.added:
                ids.append(str(self.added[part]))
                decoded.append(part)
                n += 1
                continue
            known = self.known.newer.get
            for w in self.split(self.normal(part)):
                if (got := known(w)) is None and (got := self.known.get(w)) is None:
                    got = self.chunk(w)
                    if len(w) <= self.longest_scanned:
                        self.known.put(w, got)
                if got[1]:
                    ids.append(got[0])
                    n += got[1]
                    decoded.append(got[2])
        return " ".join(ids), n, " ".join(decoded)

    def decode(self, ids: list[int]) -> str:
        """As a tokenizer file without a decoder does it: tokens joined by a blank; unknown ids are left out."""
        return " ".join(self.token[i] for i in ids if i in self.token)


def tokenizer(path: str) -> WordBPE:
    return kept(("bpe", path), lambda: WordBPE(path))


def encode(docs: DataFrame, path: str | None = None, text: str = "text", keep: tuple[str, ...] = ("doc_id",), digests: bool = False) -> DataFrame:
    """Token ids and decoded text of every row of docs, beside the columns in `keep`.

    Returns ids (blank-separated), n_tokens and decoded; with `digests`, SHA-256 of both instead of the texts.
    The vocabulary file must be at `path` on every executor.
    """
    path = path or default_vocabulary()
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    names = ("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")
    schema = ", ".join([*(f"`{k}` {fields[k]}" for k in keep), "n_tokens long", *(f"{x} string" for x in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            column = batch.column(len(keep))
            for at in range(0, len(column), 256):  # texts are short-lived: decoded ones are several times as long
                ids, counts, decoded = [], [], []
                for value in column.slice(at, 256).to_pylist():
                    i, n, d = bpe.encode(value or "")
                    if digests:
                        i, d = hashlib.sha256(i.encode()).hexdigest(), hashlib.sha256(d.encode("utf-8", "surrogatepass")).hexdigest()
                    ids.append(i)
                    counts.append(n)
                    decoded.append(d)
                kept = [batch.column(k).slice(at, 256) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], [*keep, "n_tokens", *names])

    return docs.select(*(docs[k] for k in keep), docs[text].alias("__text")).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), digests=True)
