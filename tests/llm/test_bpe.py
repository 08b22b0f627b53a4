import hashlib
import unicodedata

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sluice.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OURS = bpe.WordBPE(PATH, longest_scanned=12)


def library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    return " ".join(map(str, ids)), len(ids), LIBRARY.decode(ids, skip_special_tokens=False)


CASES = ["", " ", "The cat's 12 éÉ ñ", "a<|endoftext|>B <|startoftext|>", "x" * 5000, "ab\x1cc d　e\x85f", "ΟΔΟΣ İ ŒUVRE", "étude", "日本語 テスト 😀👍🏽", "don't we'LL 'D", "  nbsp", "<|notspecial|>"]


def test_cases():
    for text in CASES:
        assert OURS.encode(text) == library(text), text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=60))
def test_random_texts(text):
    ours = OURS.encode(text)
    assert ours == library(text)
    assert OURS.decode([int(x) for x in ours[0].split()]) == ours[2]


def test_rows(spark):
    rows = [(i, t, "extra") for i, t in enumerate([*CASES, None, CASES[2]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe.encode(docs, PATH, digests=True).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        ids, n, decoded = library(t or "")
        assert got[i].n_tokens == n
        assert got[i].ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.encode(docs.limit(0), PATH).collect() == []


def test_every_code_point():
    """In letters, after numbers, alone, and among combining marks; 128 to a text."""
    real = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}B1{c}\u0323 {c} a\u0301{c}\u0300" for c in real[i : i + 128]) for i in range(0, len(real), 128)]
    for text, said in zip(texts, LIBRARY.encode_batch(texts, add_special_tokens=False), strict=True):
        assert OURS.encode(text)[0] == " ".join(map(str, said.ids)), hex(ord(text[1]))


def test_every_canonical_pair():
    for c in range(0x110000):
        if (parts := unicodedata.decomposition(chr(c))) and not parts.startswith("<"):
            text = "".join(chr(int(x, 16)) for x in parts.split())
            assert OURS.encode(text) == library(text), hex(c)
