"""LM scoring: a causal self-attention model on subword ids, trained in numpy, over counted words.

A text's tokens are its lower-cased (A-Z) words and one end. Each word, with a blank before it, is cut into
subword ids of a public byte-level BPE; the end is one more id. A token's class is that of its first id, and
P(token | before) = P(class | ids before) * P(token | class). The class comes from one causal self-attention
layer over at most STRIDE earlier ids. P(token | class) is counted over every training row: a share for words
that no training row holds (that of words seen once), the rest by counts. As in the base score, all unknown
words (of one class) are one event.

Frequent ids have an embedding, and frequent first ids a class, of their own; the others share some. All counts
are of every training row. The attention parameters are averages of those that learners find, one for each
block of documents, in ROUNDS rounds: every learner starts from the last average and goes once through its block's rows of
that round, which their hash picks. So every training row is learned from once, at any size. Averages are taken in groups
of FAN.

Scoring lays each text's ids out in rows of STRIDE. The queries of a row see the keys of their own row
and of the one before it, masked to what comes earlier in the same text: windows of 2 * STRIDE overlap by half,
and each token is scored once, in batched matrix products. Only queries that predict a token are softened and weighed.

Texts are cut into ids once; counting, learning and scoring read the stored ids, two bytes each. Only the first
id of a word begins with a blank, so ids alone tell words apart.

Word counts are joined with what needs them by blocks of documents: rows are dealt to blocks of bounded bytes
by their hash, each block's distinct words are counted once, summed over blocks, and sent back to the blocks that do not
hold all training rows of the word; a block counts the others itself, from its stored ids.
A null text is empty: it has the end alone. Rows equal in doc_id and text each get their row. Without
training rows all counts are 0 and every token is unknown. Words are told apart by 64-bit hashes. Texts are
scored whole, a very long one in a block of its own; an empty table gives no rows. Only doc_id and text are
read, so other columns never clash.
"""

from __future__ import annotations

import base64
import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER_VALUE, Prefix, Scratch, chunks, mix, release, stored, table, words

NAME = "op6_lm_scoring"
SIZE = 16
CELLS, SHARED_CELLS = 2048, 256  # embeddings, and those that rare ids share
CLASSES, SHARED_CLASSES = 128, 32
STRIDE = 16
BATCH = 128
FEW = 512  # different embeddings in a batch up to which queries meet keys as embeddings, not as places
ROUNDS = 3
FAN = 64
BLOCK_BYTES = 8 << 20
END = 50256
VOCABULARY = 50257
LOG10 = float(np.log(10.0))
KNOWN, KNOWN_BYTES = 1 << 17, 32  # words (of texts that are not UTF-8) whose ids a worker remembers, and about the longest of them
SAFE = 60.0  # exp of what is no further from 0, and sums of it, are normal float32 numbers

_encoders: dict[str, object] = {}
_known: dict[str, dict[bytes, bytes]] = {}
_begins: dict[str, np.ndarray] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(path: str):
    """Subword ids by merge ranks alone: of one word, and of a text of words with a blank before each."""
    if path not in _encoders:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(path, "rb") if line.strip())}
        _encoders[path] = tiktoken.Encoding("words", pat_str=" [^ ]+", mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]._core_bpe.encode_single_piece, _encoders[path].encode_to_numpy


def cut(found: list[bytes], path: str) -> list[bytes]:
    """The ids of each of these words, two bytes an id."""
    known = _known.setdefault(path, {})
    out = list(map(known.get, found))
    new = [i for i, ids in enumerate(out) if ids is None]
    if not new:
        return out
    piece, together = encoder(path)
    text = b" " + b" ".join([found[i] for i in new])
    try:
        ids = together(text.decode(), disallowed_special=())
    except UnicodeDecodeError:  # bytes that are not UTF-8
        ids = np.array([x for i in new for x in piece(b" " + found[i])], np.uint32)
    at = (2 * np.append(np.flatnonzero(begins(path)[ids]), len(ids))).tolist()
    ids = ids.astype(np.uint16).tobytes()
    for i, a, b in zip(new, at[:-1], at[1:], strict=True):
        out[i] = ids[a:b]
    if len(known) < KNOWN:
        known.update({found[i]: out[i] for i in new if len(found[i]) <= KNOWN_BYTES})
    return out


def begins(path: str) -> np.ndarray:
    """Which ids begin a token: those that begin with a blank, which no other place of a word can hold, and END."""
    if path not in _begins:
        out = np.zeros(1 << 16, bool)
        out[[int(b) for a, b in (line.split() for line in open(path, "rb") if line.strip()) if base64.b64decode(a)[:1] == b" "]] = True
        out[END] = True
        _begins[path] = out
    return _begins[path]


LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def listed(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """These words of raw one after another, each with a blank before it."""
    size = ends - starts + 1
    at = np.cumsum(size) - size
    out = np.frombuffer(raw, np.uint8).take(np.arange(int(size.sum())) + np.repeat(starts - 1 - at, size), mode="clip")
    out[at] = 32
    return out.tobytes()


class Block:
    """The words of some texts: distinct ones with their hashes and ids, and the sequence of them."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, path: str):
        starts, ends, self.firsts = words(buf, offsets)
        hashes = Prefix(buf, LOWER_VALUE).of(starts, ends)
        self.hashes, self.of = np.unique(hashes, return_inverse=True)
        place = np.zeros(len(self.hashes), np.int64)
        place[self.of] = np.arange(len(self.of))  # any one of equal words
        starts, ends = starts[place], ends[place]
        raw = buf.tobytes().translate(LOWER)
        try:
            ids = encoder(path)[1](listed(raw, starts, ends).decode(), disallowed_special=())
            begin = np.flatnonzero(begins(path)[ids])
        except UnicodeDecodeError:
            ids = cut([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], path)
            begin = np.concatenate([[0], np.cumsum([len(x) // 2 for x in ids])])[:-1].astype(np.int64)
            ids = np.frombuffer(b"".join(ids), np.uint16)
        self.ids, self.begin = ids.astype(np.int32), np.append(begin, len(ids))

    def sequence(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts, each ending with END, which of them begin a token, and each text's first (and one past)."""
        n = len(self.firsts) - 1
        length = np.diff(self.begin)[self.of]
        owner = np.repeat(np.arange(n), np.diff(self.firsts))
        size = np.bincount(owner, weights=length, minlength=n).astype(np.int64) + 1
        first = np.concatenate([[0], np.cumsum(size)])
        out = np.full(first[-1], END, np.int32)
        starts = np.zeros(first[-1], bool)
        starts[first[1:] - 1] = True
        at = np.concatenate([[0], np.cumsum(length)])[:-1] + owner  # one END for each earlier text
        starts[at] = True
        if len(length):
            step = np.arange(int(length.sum())) - np.repeat(np.concatenate([[0], np.cumsum(length)])[:-1], length)
            out[np.repeat(at, length) + step] = self.ids[np.repeat(self.begin[:-1][self.of], length) + step]
        return out, starts, first


#: A random-looking 64-bit value for every id.
ID_VALUE = mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Coded:
    """Texts as the stored ids of `coded`, of which words are told apart by hashes of their ids."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, path: str):
        self.ids, self.first = buf.view(np.uint16).astype(np.int32), offsets // 2
        self.starts = begins(path)[self.ids]

    def sequence(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.ids, self.starts, self.first

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The hash, the first id and the text of every word."""
        at = np.flatnonzero(self.starts)
        ends = np.append(at[1:], len(self.ids))
        real = self.ids[at] != END
        at, ends = at[real], ends[real]
        return Prefix(self.ids, ID_VALUE).of(at, ends), self.ids[at], np.searchsorted(self.first, at, "right") - 1


def blocked(inputs: np.ndarray, goals: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs and goals (-1: none) in rows of STRIDE, each place after its input, which rows begin a text, and each row's text."""
    size = np.diff(first)
    rows = -(-size // STRIDE)
    row_first = np.concatenate([[0], np.cumsum(rows)])
    place = np.arange(len(inputs)) + np.repeat(row_first[:-1] * STRIDE - first[:-1], size)
    goal = np.full(row_first[-1] * STRIDE, -1, np.int32)
    goal[place] = goals
    before = np.full(row_first[-1] * STRIDE + 1, end, np.int32)
    before[1:][place] = inputs
    before = before[:-1]
    before[row_first[:-1] * STRIDE] = end
    fresh = np.zeros(row_first[-1], bool)
    fresh[row_first[:-1]] = True
    return before.reshape(-1, STRIDE), goal.reshape(-1, STRIDE), fresh, np.repeat(np.arange(len(size)), rows)


#: How far back each key of a query lies.
BACK = np.arange(STRIDE)

#: 0 where a query of (a row after another, one that begins a text) may see a key so far back, else -inf.
MASK = np.concatenate([np.zeros((STRIDE, STRIDE)), np.where(BACK <= BACK[:, None], 0.0, -np.inf)]).astype(np.float32)


def row_sums(rows: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """The sum of the rows of each number below n."""
    width = rows.shape[1]
    at = (of * width)[:, None] + np.arange(width)
    return np.bincount(at.ravel(), weights=rows.ravel(), minlength=n * width).reshape(n, width).astype(rows.dtype)


def lower(x: np.ndarray) -> np.ndarray:
    """x itself, less the greatest value of each row where exp could leave the range of its numbers."""
    if x.size and not (x.max() < SAFE and x.min() > -SAFE):
        x -= x.max(-1, keepdims=True)
    return x


def dealt_by_count(counts: np.ndarray, n: int, shared: int) -> np.ndarray:
    """A number below n for each id: the most frequent have one of their own, the others the last `shared`."""
    own = np.argsort(-counts, kind="stable")[: n - shared]
    out = (n - shared + np.arange(len(counts)) % shared).astype(np.int32)
    out[own] = np.arange(len(own))
    return out


class Model:
    """ids, firsts: how often each id, and each first id of a token, stands in the training rows; once: tokens seen once."""

    def __init__(self, ids: np.ndarray, firsts: np.ndarray, once: int, rng: np.random.Generator):
        self.cell, self.classes = dealt_by_count(ids, CELLS, SHARED_CELLS), dealt_by_count(firsts, CLASSES, SHARED_CLASSES)
        self.mass = np.bincount(self.classes, weights=firsts, minlength=CLASSES)
        self.unknown = (once + 0.5) / (firsts.sum() + 1)
        draw = lambda *shape: (rng.standard_normal(shape) * 0.2).astype(np.float32)
        prior = np.log((self.mass + 0.5) / (self.mass.sum() + 0.5 * CLASSES)).astype(np.float32)
        self.p = {"e": draw(CELLS, SIZE), "q": draw(SIZE, SIZE), "k": draw(SIZE, SIZE), "v": draw(SIZE, SIZE), "near": np.zeros(STRIDE, np.float32), "u": draw(2 * SIZE, CLASSES) / 4, "c": prior}

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def set_flat(self, values: np.ndarray) -> None:
        at = 0
        for k, v in self.p.items():
            self.p[k] = np.asarray(values[at : at + v.size], np.float32).reshape(v.shape)
            at += v.size

    def within(self, classes: np.ndarray, times: np.ndarray) -> np.ndarray:
        """log P(token | class) of tokens of these classes, by their training counts (0: unknown)."""
        mass = self.mass[classes]
        known = np.log(1 - self.unknown) + np.log(np.maximum(times, 1)) - np.log(np.maximum(mass, 1))
        return np.where(times > 0, known, np.where(mass > 0, np.log(self.unknown), 0.0))

    def inputs(self, part: Block | Coded) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        ids, starts, first = part.sequence()
        return blocked(self.cell[ids], np.where(starts, self.classes[ids], -1), first, int(self.cell[END]))

    def bias(self) -> np.ndarray:
        """What is added to the score of each key (-inf: not seen), for the queries of rows after another and of rows that begin a text."""
        return MASK + self.p["near"]

    def softened(self, w: np.ndarray, fresh: np.ndarray, at: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """The weights of the keys of the queries at the flat places `at`, nearest first, made of their scores w."""
        place = at % STRIDE + STRIDE * fresh.take(at // STRIDE)
        if w.size and w.max() < SAFE and w.min() > -SAFE and np.abs(self.p["near"]).max() < SAFE / 4:
            np.exp(w, out=w)
            w *= np.exp(bias).take(place, 0)
        else:
            w += bias.take(place, 0)
            w -= w.max(-1, keepdims=True)
            np.exp(w, out=w)
        w *= (1 / (w @ np.ones(STRIDE, w.dtype)))[:, None]
        return w

    def attended(self, qkv: np.ndarray, fresh: np.ndarray, at: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, ...]:
        """For the queries at the flat places `at`: what they attend to and their weights; keys and values; all weights by row and where those of `at` lie.

        qkv has a row of zeros before the rows; keys and values are views of it, each row's after those of the row before.
        """
        rows = len(qkv) - 1
        both = np.ndarray((rows, 2 * STRIDE, 3 * SIZE), qkv.dtype, qkv, 0, qkv.strides)
        keys, values = both[..., SIZE : 2 * SIZE], both[..., 2 * SIZE :]
        where = (at * (2 * STRIDE) + at % STRIDE + STRIDE)[:, None] - BACK
        w = self.softened(np.matmul(qkv[1:, :, :SIZE], keys.transpose(0, 2, 1)).take(where), fresh, at, bias)
        dense = np.zeros((rows, STRIDE, 2 * STRIDE), w.dtype)
        dense.reshape(-1)[where] = w
        return np.matmul(dense, values).reshape(-1, SIZE).take(at, 0), w, keys, values, (dense, where)

    def tables(self) -> dict:
        """What depends on one embedding alone, or on those of a query and a key (`plain`: its exp), for every embedding."""
        p = self.p
        q, k, v = (p["e"] @ p[x] for x in "qkv")
        scores, bias, own = q @ k.T, self.bias(), p["e"] @ p["u"][:SIZE] + p["c"]
        plain = bool(np.abs(scores).max() + np.abs(p["near"]).max() < SAFE)
        # what a query attends to is a mean of values, so no class scores more than this
        small = bool(np.abs(own).max() + np.abs(v @ p["u"][SIZE:]).max() < SAFE)
        if plain:
            np.exp(scores, out=scores)
            bias = np.exp(bias)
        return {"scores": scores, "bias": bias, "plain": plain, "v": v, "own": own, "small": small}

    def gradients(self, before: np.ndarray, goal: np.ndarray, fresh: np.ndarray) -> tuple[float, dict]:
        """The loss and its gradients, that of e as (the embeddings that occur, their rows).

        Few different embeddings occur in a batch of words. Up to FEW of them each is projected once, and queries meet keys and
        values as embeddings: all pairs of them in one product, of which every query takes its own, and sums of what each embedding
        got at all its places. With more of them that would cost more than the places themselves.
        """
        p, rows = self.p, len(before)
        weights = np.concatenate([p["q"], p["k"], p["v"]], 1)
        number = np.zeros(CELLS, np.int64)
        number[before.ravel()] = 1
        some = np.flatnonzero(number)
        size = len(some)
        number[some] = np.arange(size)
        cell = np.zeros((rows + 1) * STRIDE, np.int64)  # what stands before the first row is not seen
        number.take(before.ravel(), out=cell[STRIDE:], mode="clip")
        e = p["e"].take(some, 0)
        each = e @ weights
        at = np.flatnonzero(goal.ravel() >= 0)
        goal, n, line = goal.ravel().take(at), max(1, len(at)), np.arange(len(at))
        mine, bias = cell.take(at + STRIDE), self.bias()
        if few := size <= FEW:
            q, k = each[:, :SIZE], each[:, SIZE : 2 * SIZE]
            seen = cell.take((at + STRIDE)[:, None] - BACK)
            values = np.ascontiguousarray(each[:, 2 * SIZE :]).take(seen, 0)
            pair = seen + (mine * size)[:, None]
            w = self.softened((q @ k.T).take(pair), fresh, at, bias)
            h = np.matmul(w[:, None], values)[:, 0]
        else:
            qkv = each.take(cell, 0).reshape(rows + 1, STRIDE, 3 * SIZE)
            qkv[0] = 0
            h, w, keys, values, (attention, where) = self.attended(qkv, fresh, at, bias)
        both = np.concatenate([e.take(mine, 0), h, np.ones((len(at), 1), h.dtype)], 1)  # the last for c
        d = both @ np.concatenate([p["u"], p["c"][None]])
        np.exp(lower(d), out=d)
        total = d @ np.ones(CLASSES, d.dtype)
        loss = -np.log(np.maximum(d[line, goal] / total, 1e-20)).sum() / n
        d[line, goal] -= total
        scale = (1 / (n * total))[:, None]  # applied to the narrow sides of the products, not to d
        du = d.T @ (both * scale)
        g = {"u": du[:, :-1].T, "c": du[:, -1]}
        db = d @ p["u"].T
        db *= scale
        if few:
            dh = np.ascontiguousarray(db[:, SIZE:])
            ds = np.matmul(values, dh[:, :, None])[..., 0]
            seen *= len(at)
            seen += line[:, None]
            attention = np.zeros((size, len(at)), w.dtype)
            np.add.at(attention.reshape(-1), seen.ravel(), w.ravel())
            dv = attention @ dh
        else:
            dh = np.zeros((rows, STRIDE, SIZE), d.dtype)
            dh.reshape(-1, SIZE)[at] = db[:, SIZE:]
            ds = np.matmul(dh, values.transpose(0, 2, 1)).take(where)
            dv = np.matmul(attention.transpose(0, 2, 1), dh)
        ds -= ((ds * w) @ np.ones(STRIDE, d.dtype))[:, None]
        ds *= w
        g["near"] = np.ones(len(at), d.dtype) @ ds
        if few:
            met = np.zeros(size * size, d.dtype)
            np.add.at(met, pair.ravel(), ds.ravel())
            met = met.reshape(size, size)
            dqkv = np.concatenate([met @ k, met.T @ q, dv], 1)
        else:
            attention.reshape(-1)[where] = ds
            dqkv = np.empty((rows, STRIDE, 3 * SIZE), d.dtype)
            dqkv[..., :SIZE] = np.matmul(attention, keys)
            for a, x in ((SIZE, np.matmul(attention.transpose(0, 2, 1), qkv[1:, :, :SIZE])), (2 * SIZE, dv)):
                x[:-1, STRIDE:] += x[1:, :STRIDE]
                dqkv[..., a : a + SIZE] = x[:, STRIDE:]
            dqkv = row_sums(dqkv.reshape(-1, 3 * SIZE), cell[STRIDE:], size)
        dw = e.T @ dqkv
        g["q"], g["k"], g["v"] = dw[:, :SIZE], dw[:, SIZE : 2 * SIZE], dw[:, 2 * SIZE :]
        g["e"] = (some, dqkv @ weights.T + row_sums(db[:, :SIZE], mine, size))
        return float(loss), g

    def train(self, before: np.ndarray, goal: np.ndarray, fresh: np.ndarray, rng: np.random.Generator, rate: float = 0.02, batch: int = BATCH) -> list[float]:
        """Once through all rows, in batches of neighbouring rows."""
        names = [k for k in self.p if k != "e"]
        e, rest = self.p["e"], np.concatenate([self.p[k].ravel() for k in names])
        ends = np.cumsum([self.p[k].size for k in names])
        self.p |= {k: x.reshape(self.p[k].shape) for k, x in zip(names, np.split(rest, ends[:-1]), strict=True)}  # views of rest
        a, b, ea, eb = np.zeros_like(rest), np.zeros_like(rest), np.zeros_like(e), np.zeros_like(e)

        def step(a: np.ndarray, b: np.ndarray, grad: np.ndarray, size: float) -> np.ndarray:
            a *= 0.9
            a += 0.1 * grad
            b *= 0.98
            grad *= grad
            grad *= 0.02
            b += grad
            np.sqrt(b, out=grad)
            grad += 1e-6
            np.divide(a, grad, out=grad)
            grad *= size
            return grad

        losses = []
        for t, at in enumerate(rng.permutation(np.arange(0, len(before), batch)), 1):
            rows = slice(at, at + batch)
            cut = fresh[rows].copy()
            cut[0] = True
            loss, g = self.gradients(before[rows], goal[rows], cut)
            losses.append(loss)
            size = rate * min(1.0, t / 20)
            rest -= step(a, b, np.concatenate([g[k].ravel() for k in names]), size)
            some, grad = g["e"]
            sa, sb = ea.take(some, 0), eb.take(some, 0)
            down = step(sa, sb, grad, size)
            ea[some], eb[some] = sa, sb
            e[some] -= down
        return losses

    def class_scores(self, part: Block | Coded, tables: dict, most: int = 128) -> np.ndarray:
        """For each text, the sum over its tokens of log P(class | ids before)."""
        before, goal, fresh, text = self.inputs(part)
        out = np.zeros(text[-1] + 1 if len(text) else 0)  # each text has its end
        u, ones = self.p["u"][SIZE:], np.ones(STRIDE, tables["v"].dtype)
        for first in range(0, len(before), most):
            a = max(0, first - 1)  # the row before, for its keys
            rows = slice(a, first + most)
            start = fresh[rows].copy()
            start[0] = True
            if first > a and not fresh[first]:
                start[1] = False
            seen = np.zeros((len(start) + 1) * STRIDE, np.int64)  # what stands before the first row is not seen
            seen[STRIDE:] = before[rows].ravel()
            now = goal[rows].ravel()
            at = np.flatnonzero(now >= 0)
            at = at[at >= (first - a) * STRIDE]
            mine, keys = seen.take(at + STRIDE), seen.take((at + STRIDE)[:, None] - BACK)
            w = tables["scores"].take((mine * CELLS)[:, None] + keys)
            bias = tables["bias"].take(at % STRIDE + STRIDE * start.take(at // STRIDE), 0)
            if tables["plain"]:
                w *= bias
            else:
                w += bias
                w -= w.max(-1, keepdims=True)
                np.exp(w, out=w)
            w *= (1 / (w @ ones))[:, None]
            logits = np.matmul(w[:, None], tables["v"].take(keys, 0))[:, 0] @ u
            logits += tables["own"].take(mine, 0)
            if not tables["small"]:
                lower(logits)
            picked = logits[np.arange(len(at)), now[at]]
            np.exp(logits, out=logits)
            said = picked.astype(np.float64) - np.log(logits @ np.ones(CLASSES, logits.dtype))
            out += np.bincount(text[a + at // STRIDE], weights=said, minlength=len(out))
        return out


def is_training(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 != 1, F.lit(True))


def dealt(docs: DataFrame) -> tuple[DataFrame, int]:
    """doc_id, text, training, turn and block: rows dealt by hash to blocks of about BLOCK_BYTES; and the number of blocks."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), is_training(F.col("doc_id")).alias("training"))
    turn = F.pmod(F.xxhash64("doc_id", "text", F.lit(3)), F.lit(ROUNDS)).cast("int")
    return rows.withColumns({"turn": turn, "block": F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")}), n


def coded(rows: DataFrame, path: str) -> DataFrame:
    """Rows of `dealt` with the ids of each text, two bytes each, in place of the text."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, offsets in chunks(batch.column(4)):
                ids, _, first = Block(buf, offsets, path).sequence()
                column = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(2 * first), pa.py_buffer(ids.astype(np.uint16))])
                if 2 * first[-1] < 1 << 31:
                    column = column.cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[:4]), column], ["doc_id", "training", "turn", "block", "ids"])

    return rows.select("doc_id", "training", "turn", "block", "text").mapInArrow(run, f"doc_id {kind}, training boolean, turn int, block int, ids binary")


def block_words(rows: DataFrame, path: str) -> DataFrame:
    """(block, h, n): each block's distinct words with their training counts; as block -1, of each id; as -2, of each first id."""

    def run(frame: pa.Table) -> pa.Table:
        block = frame.column("block")[0].as_py()
        learn = frame.column("training").to_numpy()
        h, n, ids, firsts = [], [], np.zeros(VOCABULARY, np.int64), np.zeros(VOCABULARY, np.int64)
        for a, b, buf, offsets in chunks(frame.column("ids")):
            part = Coded(buf, offsets, path)
            hashes, lead, owner = part.words()
            mine = learn[a:b]
            ids += np.bincount(part.ids[np.repeat(mine, np.diff(part.first))], minlength=VOCABULARY)
            firsts += np.bincount(lead[mine[owner]], minlength=VOCABULARY)
            firsts[END] += int(mine.sum())
            found, of = np.unique(hashes, return_inverse=True)
            h.append(found)
            n.append(np.bincount(of, weights=mine[owner], minlength=len(found)).astype(np.int64))
        words_, back = np.unique(np.concatenate(h), return_inverse=True)
        times = np.bincount(back, weights=np.concatenate(n), minlength=len(words_)).astype(np.int64)
        some, lead = np.flatnonzero(ids), np.flatnonzero(firsts)
        blocks = np.concatenate([np.full(len(words_), block), np.full(len(some), -1), np.full(len(lead), -2)]).astype(np.int32)
        return pa.table({"block": pa.array(blocks), "h": pa.array(np.concatenate([words_.view(np.int64), some, lead])), "n": pa.array(np.concatenate([times, ids[some], firsts[lead]]))})

    return rows.groupBy("block").applyInArrow(run, "block int, h long, n long")  # a block's bytes are bounded


def average(found: DataFrame, n: int, work: Scratch) -> np.ndarray:
    """The mean, by weight, of the parameters of n learners (learner, weight, p), in groups of FAN."""

    def mean(frame: pa.Table) -> pa.Table:
        weight = frame.column("weight").to_numpy()
        order = np.argsort(frame.column("learner").to_numpy(), kind="stable")  # alike in every run
        total = sum(weight[i] * np.asarray(frame.column("p")[int(i)].values, np.float64) for i in order)
        out = (total / max(weight.sum(), 1e-9)).astype(np.float32)
        return pa.table({"learner": pa.array([frame.column("learner")[0].as_py() // FAN], pa.int64()), "weight": pa.array([float(weight.sum())]), "p": pa.array([out], pa.list_(pa.float32()))})

    while n > 1:
        found = work.stored(found.groupBy(F.floor(F.col("learner") / FAN).alias("g")).applyInArrow(mean, "learner long, weight double, p array<float>"))
        n = -(-n // FAN)
    got = found.select("p").first()
    return None if got is None else np.array(got.p, np.float32)


def fit(model: Model, training: DataFrame, blocks: int, path: str, work: Scratch) -> Model:
    """The attention parameters, from all training rows (doc_id, turn, block, ids), each in the round of its turn."""
    spark = training.sparkSession
    rows = training.select("block", "doc_id", "ids", "turn")

    def learner(turn: int, shared):
        def learn(frame: pa.Table) -> pa.Table:
            mine = copy.deepcopy(shared.value)
            block = frame.column("block")[0].as_py()
            frame = frame.sort_by([("doc_id", "ascending"), ("ids", "ascending")])  # alike in every run
            weight, rng = 0, np.random.default_rng([turn, block])
            for _, _, buf, offsets in chunks(frame.column("ids")):
                before, goal, fresh, _ = mine.inputs(Coded(buf, offsets, path))
                mine.train(before, goal, fresh, rng, 0.02 / (1 + turn))
                weight += int((goal >= 0).sum())
            return pa.table({"learner": pa.array([block], pa.int64()), "weight": pa.array([float(weight)]), "p": pa.array([mine.flat()], pa.list_(pa.float32()))})

        return learn

    for turn in range(ROUNDS):
        learn = learner(turn, spark.sparkContext.broadcast(model))  # its size is fixed
        found = work.stored(rows.filter(F.col("turn") == turn).drop("turn").groupBy("block").applyInArrow(learn, "learner long, weight double, p array<float>"))
        got = average(found, blocks, work)
        if got is not None:
            model.set_flat(got)
    return model


def score(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, training, n_tokens, n_known, train_tokens, base_score, score of every row of docs (doc_id, text)."""
    with Scratch(docs.sparkSession) as work:
        return stored(_score(docs, path or default_vocabulary(), work))


def _score(docs: DataFrame, path: str, work: Scratch) -> DataFrame:
    spark = docs.sparkSession
    rows, blocks = dealt(docs)
    rows = work.stored(coded(rows, path))
    counted = work.stored(block_words(rows, path))
    release(spark)
    ids, firsts = np.zeros(VOCABULARY, np.int64), np.zeros(VOCABULARY, np.int64)
    for block, i, n in counted.filter("block < 0").groupBy("block", "h").agg(F.sum("n")).collect():  # two rows for each id at most
        (ids if block == -1 else firsts)[i] = n
    end = int(ids[END])
    known = counted.filter("block >= 0")
    sums = work.stored(known.groupBy("h").agg(F.sum("n").alias("c")).filter("c > 0"))
    distinct, once = sums.agg(F.count(F.lit(1)), F.count(F.when(F.col("c") == 1, 1))).first()
    total, distinct = int(firsts.sum()), distinct + (end > 0)
    model = fit(Model(ids, firsts, once, np.random.default_rng(7)), rows.filter("training"), blocks, path, work)
    release(spark)
    shared = spark.sparkContext.broadcast(model)  # its size is fixed
    counts = known.join(sums.hint("merge"), "h").filter("n < c").select("block", "h", "c")  # a block counts its own words
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "training", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        model = shared.value
        tables = model.__dict__.setdefault("_tables", None) or model.tables()
        model._tables = tables
        learn, out = left.column("training").to_numpy(), {k: [] for k in names[2:]}
        parts = [(a, b, Coded(buf, offsets, path)) for a, b, buf, offsets in chunks(left.column("ids"))]
        cut_up = [part.words() for _, _, part in parts]
        found, of = np.unique(np.concatenate([x[0] for x in cut_up]).view(np.int64), return_inverse=True)
        mine = np.concatenate([learn[a + x[2]] for (a, _, _), x in zip(parts, cut_up, strict=True)])
        times = np.bincount(of, weights=mine, minlength=len(found)).astype(np.int64)
        times[np.searchsorted(found, right.column("h").to_numpy())] = right.column("c").to_numpy()  # those that other blocks learn from too
        floor = total + 0.5 * (distinct + 1)
        base = np.log10((times + 0.5) / floor)
        last_word = np.cumsum([len(x[0]) for x in cut_up])
        for (a, b, part), (_, lead, owner), to in zip(parts, cut_up, last_word, strict=True):
            word = of[to - len(owner) : to]
            each = times[word]
            summed = lambda x, owner=owner, n=b - a: np.bincount(owner, weights=x, minlength=n)
            out["n_tokens"].append(np.bincount(owner, minlength=b - a) + 1)
            out["n_known"].append(summed(each > 0).astype(np.int64) + (end > 0))
            out["train_tokens"].append(np.full(b - a, total))
            out["base_score"].append(summed(base[word]) + np.log10((end + 0.5) / floor))
            last = float(model.within(model.classes[[END]], np.array([end]))[0])
            out["score"].append((model.class_scores(part, tables) + summed(model.within(model.classes[lead], each)) + last) / LOG10)
        return pa.table({"doc_id": left.column("doc_id"), "training": left.column("training"), **{k: pa.array(np.concatenate(v) if v else np.zeros(0)) for k, v in out.items()}})

    left = rows.select("block", "doc_id", "training", "ids").groupBy("block")
    return left.cogroup(counts.groupBy("block")).applyInArrow(run, f"doc_id {kind}, training boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
