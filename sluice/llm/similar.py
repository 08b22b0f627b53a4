"""N-gram Jaccard join by a size-aware heavy-light scheme.

A document's set is its distinct shingles of five lower-cased words. Two documents link if the Jaccard
similarity of their sets is 0.75 or more. Documents with equal sets form one class; links are sought
between classes.

Small sets (light): for each pair of sizes, every subset of the overlap that this pair of sizes needs is a
key; classes that share a key link, no check needed. Large sets (heavy): inverted lists over each set's
prefix are scanned; any two similar sets share a token in their prefixes, since all sets are ordered alike
(frequent tokens last). The boundary is the size where the summed cost of both ways is least.

Lists are never expanded to all pairs. First every class is checked against one pivot of its lists and
components are formed. Then the lists that still hold several components are scanned in bounded blocks, for the
likeliest partner of each class, and, once those are joined, for all that is left. Classes of different components
are paired where their sizes, the number of lists that linked sets of these
sizes must share, and a parity sketch allow it. The number of differing places of two sketches never exceeds
the size of the symmetric difference; sketches are as long as the sets, so that few pairs pass that are not
alike. What passes is verified on whole texts, the likeliest pair of each two components before all others.
Pairs within a component need no check: the result is components.

Null, empty and blank texts have empty sets, which link with nothing. Repeated rows each get their row; a
null doc_id never names a component unless all its members are null. Very long texts are taken whole; an
empty table gives no rows. Only doc_id and text are read, so other columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER_VALUE, Prefix, Scratch, chunks, inside, mix, release, rolling, stored, table, words
from .graph import components

NAME = "op4_jaccard_join"
SHINGLE = 5
PERCENT = 75
HOT_TOKENS = 200_000  # most tokens that are ordered by frequency (8 MB at most to each executor)
HOT_IN_BATCH = 4
LIGHTEST, HEAVIEST = 0, 10  # sizes between which the boundary may lie
BITS = 8  # 64-bit words of a folded sketch, and the least of a whole one
PART = 4096  # rows of a part of a frequent token's list
LOT = 512  # rows of a block of a list in the second round


def needed(a: int, b: int) -> int:
    """Least overlap of sets of sizes a and b that link: 100 i >= 75 (a + b - i)."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def partners(a: int) -> range:
    """Sizes that a set of size a may link with."""
    return range(max(1, -(-PERCENT * a // 100)), 100 * a // PERCENT + 1)


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - (PERCENT * n + 99) // 100 + 1


def shingle_sets(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where each text's begin (and one past)."""
    starts, ends, firsts = words(buf, offsets)
    hashes = Prefix(buf, LOWER_VALUE).of(starts, ends)
    counts = np.diff(firsts)
    whole = inside(firsts, SHINGLE, len(hashes))
    sizes = np.where(counts < SHINGLE, counts > 0, counts - SHINGLE + 1)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    tokens = np.zeros(edges[-1], np.uint64)
    tokens[np.repeat(counts >= SHINGLE, sizes)] = rolling(hashes, SHINGLE)[whole]
    for k in range(1, SHINGLE):
        few = np.flatnonzero(counts == k)
        if len(few):
            tokens[edges[few]] = rolling(hashes, k)[firsts[few]]
    new = np.ones(len(tokens), bool)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        tokens[a:b].sort()
    new[1:] = tokens[1:] != tokens[:-1]
    new[edges[:-1][sizes > 0]] = True
    return tokens[new], np.concatenate([[0], np.cumsum(new)])[edges]


def sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[firsts[1:]] - total[firsts[:-1]]


def sketches(tokens: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Parity of the number of tokens at each place of every text's sketch.

    A sketch has a power of two places, four times the tokens or more. Returned: all sketches as 64-bit words, each
    one's first word (and one past), and all sketches folded to BITS words.
    """
    sizes = np.diff(firsts)
    width = np.int64(64 * BITS) << np.maximum(0, np.ceil(np.log2(np.maximum(1, 4 * sizes) / (64 * BITS)))).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(width)])
    place = (mix(tokens ^ np.uint64(0xA5A5A5A5)) & np.repeat((width - 1).astype(np.uint64), sizes)).astype(np.int64) + np.repeat(begin[:-1], sizes)
    odd = (np.bincount(place, minlength=int(begin[-1])) & 1).astype(np.uint8)
    whole = np.packbits(odd, bitorder="little").view(np.uint64)
    edges = begin // 64
    folded = np.bitwise_xor.reduceat(whole.reshape(-1, BITS), edges[:-1] // BITS, axis=0) if len(sizes) else np.zeros((0, BITS), np.uint64)
    return whole, edges, [np.ascontiguousarray(folded[:, w]).view(np.int64) for w in range(BITS)]


def far(one: bytes, two: bytes) -> int:
    """Differing places of two sketches, the wider one folded to the other: at most the size of the symmetric difference."""
    x, y = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
    if len(x) > len(y):
        x, y = y, x
    if len(y) > len(x):
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def class_ids(tokens: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    sizes = np.diff(firsts)
    return mix(sums(mix(tokens ^ np.uint64(0x5BD1E995)), firsts) ^ (sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))).view(np.int64)


SKETCH = [f"s{i}" for i in range(BITS)]


def once(ids: np.ndarray) -> np.ndarray:
    """Which of the texts of a batch are the first of their class."""
    keep = np.zeros(len(ids), bool)
    keep[np.unique(ids, return_index=True)[1]] = True
    return keep


def row_keys() -> list[Column]:
    return [F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(5), "text", "doc_id").alias("k2")]


def described(docs: DataFrame) -> DataFrame:
    """One row for each document (doc_id, k1, k2, c, n, folded and whole sketch, tokens of a small set), and rows (token, times) of tokens frequent in a batch."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "k1", "k2", "c", "n", *SKETCH, "sketch", "small", "token", "times"]
    kinds = {"sketch": "binary", "small": "array<long>"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = []
            for a, b, buf, offsets in chunks(batch.column(3)):
                tokens, firsts = shingle_sets(buf, offsets)
                ids, sizes = class_ids(tokens, firsts), np.diff(firsts)
                seen.append(tokens[np.repeat(once(ids), sizes)])
                whole, edges, folded = sketches(tokens, firsts)
                sketch = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(edges * 8), pa.py_buffer(whole)]).cast(pa.binary())
                rows = [*(c.slice(a, b - a) for c in batch.columns[:3]), pa.array(ids), pa.array(sizes), *map(pa.array, folded), sketch]
                few = sizes <= HEAVIEST
                small = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(np.where(few, sizes, 0))]).astype(np.int32), pa.array(tokens[np.repeat(few, sizes)].view(np.int64)))
                none = pa.nulls(b - a, pa.int64())
                yield pa.RecordBatch.from_arrays([*rows, small, none, none], names)
            values, times = np.unique(np.concatenate(seen) if seen else np.zeros(0, np.uint64), return_counts=True)
            often = times >= HOT_IN_BATCH
            values, times = values[often].view(np.int64), times[often]
            none = [pa.nulls(len(values), batch.schema.field(0).type), *(pa.nulls(len(values), {"sketch": pa.binary(), "small": pa.list_(pa.int64())}.get(x, pa.int64())) for x in names[1:-2])]
            yield pa.RecordBatch.from_arrays([*none, pa.array(values), pa.array(times.astype(np.int64))], names)

    rows = docs.select("doc_id", *row_keys(), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{x} {kinds.get(x, 'long')}" for x in names[1:]))


def boundary(sizes: dict[int, int]) -> int:
    """The largest small size: subset keys up to it and scanned prefixes beyond it cost least together."""
    checking = 20  # a scanned set's share of filters and checks, in rows

    def cost(x: int) -> float:
        light = sum(k * sum(comb(a, needed(a, b)) for b in partners(a) if b <= x) for a, k in sizes.items() if a <= x)
        return light + sum(k * (int(prefix_length(np.array(a))) + checking) for a, k in sizes.items() if a > x or 100 * a >= PERCENT * (x + 1))

    return min(range(LIGHTEST, HEAVIEST + 1), key=cost)


def prefixes(docs: DataFrame, most: int, hot: np.ndarray, times: np.ndarray) -> DataFrame:
    """Rows (token, part, c, n): the prefix tokens of large sets, and of small ones that large ones may link with.

    hot: frequent tokens, from the least frequent, and how often each was counted. part: the list of a frequent
    token lies in parts of about PART rows, from 0; the part of other lists is -1.
    """
    order = np.argsort(hot)
    shared = docs.sparkSession.sparkContext.broadcast((hot[order], (order + 1).astype(np.int64), 1 + times[order] // PART))  # HOT_TOKENS at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ranks, parts = shared.value
        for batch in batches:
            for _, _, buf, offsets in chunks(batch.column(0)):
                tokens, firsts = shingle_sets(buf, offsets)
                ids, sizes = class_ids(tokens, firsts), np.diff(firsts)
                heavy = once(ids) & ((sizes > most) | (100 * sizes >= PERCENT * (most + 1)))  # copies near each other go once
                rows = heavy[np.repeat(np.arange(len(ids)), sizes)]
                tokens, ids, sizes = tokens[rows], ids[heavy], sizes[heavy]
                firsts = np.concatenate([[0], np.cumsum(sizes)])
                owner = np.repeat(np.arange(len(ids)), sizes)
                rank, part = np.zeros(len(tokens), np.int64), np.ones(len(tokens), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    found = known[at] == tokens
                    rank, part = np.where(found, ranks[at], 0), np.where(found, parts[at], 1)
                late = np.flatnonzero(rank)  # frequent tokens go last in each set; the others stay in order
                turn = np.concatenate([np.flatnonzero(rank == 0), late[np.lexsort((rank[late], owner[late]))]])
                turn = turn[np.argsort(owner[turn], kind="stable")]
                place = np.arange(len(tokens)) - firsts[owner]
                chosen = place < prefix_length(sizes)[owner]
                pick, whose = turn[chosen], owner[chosen]
                lot = (mix(ids[whose].view(np.uint64) ^ tokens[pick]) % part[pick].astype(np.uint64)).astype(np.int32)
                lot[part[pick] == 1] = -1
                yield pa.RecordBatch.from_arrays([pa.array(tokens[pick].view(np.int64)), pa.array(lot), pa.array(ids[whose]), pa.array(sizes[whose])], ["token", "part", "c", "n"])

    return docs.select("text").mapInArrow(run, "token long, part int, c long, n long")


def subset_keys(classes: DataFrame, most: int) -> DataFrame:
    """Rows (key, c, low) for every subset that a small class (c, n, small) may share with a partner of some size.

    low: the class has the smaller size of the key's pair of sizes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for c, a, mine in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                for b in partners(a):
                    if b <= most:
                        tag = min(a, b) << 8 | max(a, b)
                        for subset in combinations([x & (1 << 64) - 1 for x in mine], needed(a, b)):
                            rows.append((int(rolling(np.array([tag, *subset], np.uint64), len(subset) + 1).view(np.int64)[0]), c, a <= b))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.bool_())], ["key", "c", "low"])

    return classes.filter(F.col("n").between(1, most)).select("c", "n", "small").mapInArrow(run, "key long, c long, low boolean")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar, by their whole texts (c, text)."""
    both = pairs.select("a", "b").join(texts.select(F.col("c").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("c").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for r in range(batch.num_rows):
                one, two = ([*chunks(batch.column(k).slice(r, 1))][0] for k in (2, 3))
                s, t = shingle_sets(*one[2:])[0], shingle_sets(*two[2:])[0]
                i = len(np.intersect1d(s, t, assume_unique=True))
                good[r] = 100 * i >= PERCENT * (len(s) + len(t) - i)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(good)) for c in batch.columns[:2]], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def differing(names: list[str]) -> Column:
    return sum((F.bit_count(F.col(s).bitwiseXOR(F.col(f"o_{s}"))) for s in names), F.lit(0))


def least_shared(a: Column, b: Column) -> Column:
    """Least number of tokens that the prefixes of linked sets of sizes a and b share.

    Of at least o = needed(a, b) shared tokens, the k-th is at place a - o + k or before in the one set, and at
    b - o + k in the other: all are in both prefixes up to o - (larger size - its prefix).
    """
    whole = lambda x, per: F.floor((x + per - 1) / per)
    return F.greatest(F.lit(1), whole(PERCENT * (a + b), 100 + PERCENT) - whole(PERCENT * F.greatest(a, b), 100) + 1)


def likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) that size, shared tokens and sketches allow, with the number of differing places: folded sketches first, whole ones last."""
    one = classes.select(F.col("c").alias("a"), F.col("n").alias("na"), F.col("open").alias("oa"), *SKETCH)
    two = classes.select(F.col("c").alias("b"), F.col("n").alias("nb"), F.col("open").alias("ob"), *(F.col(s).alias(f"o_{s}") for s in SKETCH))
    na, nb = F.col("na"), F.col("nb")
    apart = F.floor((na + nb) * (100 - PERCENT) / (100 + PERCENT))
    fits = (100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb)) & (F.least("oa", "ob") >= least_shared(na, nb)) & (differing(SKETCH) <= apart)
    met = pairs.join(one, "a").join(two, "b").filter(fits).select("a", "b", apart.alias("most"))
    met = met.join(classes.select(F.col("c").alias("a"), F.col("sketch").alias("sa")), "a").join(classes.select(F.col("c").alias("b"), F.col("sketch").alias("sb")), "b").select("a", "b", "most", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([far(x.as_py(), y.as_py()) for x, y in zip(batch.column(3), batch.column(4), strict=True)], np.int64)
            good = pa.array(bits <= batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([*(c.filter(good) for c in batch.columns[:2]), pa.array(bits).filter(good)], ["a", "b", "bits"])

    return met.mapInArrow(run, "a long, b long, bits long")


def met_in_lists(rows: DataFrame, best: bool) -> DataFrame:
    """Pairs (a, b) of different roots that share a list, where size, rank and folded sketches allow it.

    best: of each set's pairs in a block only the one of fewest differing places, so that what is made never
    exceeds the rows read. rows: token, m (length of the list), c, n, root, rank and SKETCH. rank: how many of the set's lists are as long as
    this one or longer. The shortest list that linked sets share has for both at least the rank of the number of
    lists they must share, so that they need to meet in that one alone. A list lies in blocks of about LOT rows, and each two
    blocks of one list, in order of size, pass through one task: a set meets those up to a third larger, and only
    pairs that pass the filters are ever made.
    """
    blocks = F.floor((F.col("m") + LOT - 1) / LOT).cast("int")
    mine = F.pmod(F.xxhash64("c"), blocks).cast("int").alias("mine")
    dealt = rows.select("*", mine, blocks.alias("blocks")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("token", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "mine", "c", "n", "root", "rank", *SKETCH)
    ordered = dealt.repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi", "n")
    ordered = ordered.select("token", "lo", "hi", "mine", "c", "n", "root", "rank", *SKETCH)

    def pairs(columns: list[np.ndarray]) -> pa.RecordBatch:
        token, lo, hi, mine, c, n, root, rank, *sketch = columns
        sketch = np.stack(sketch, 1).view(np.uint64)
        at, step, found = np.arange(len(token)), 1, []
        least, who = np.full(len(token), 1 << 30), np.full(len(token), -1)
        while len(at):
            at = at[at + step < len(token)]
            to = at + step
            near = (token[at] == token[to]) & (lo[at] == lo[to]) & (hi[at] == hi[to]) & (100 * n[at] >= PERCENT * n[to])
            at, to = at[near], to[near]
            good = (root[at] != root[to]) & ((lo[at] == hi[at]) | (mine[at] != mine[to]))
            x, y = at[good], to[good]
            shared = np.maximum(1, -(-PERCENT * (n[x] + n[y]) // (100 + PERCENT)) + -PERCENT * n[y] // 100 + 1)  # n[y] is the larger
            ranked = np.minimum(rank[x], rank[y]) >= shared
            x, y = x[ranked], y[ranked]
            bits = np.bitwise_count(sketch[x] ^ sketch[y]).sum(1, dtype=np.int64)
            fits = bits * (100 + PERCENT) <= (n[x] + n[y]) * (100 - PERCENT)
            x, y, bits = x[fits], y[fits], bits[fits]
            if best:
                for one, two in ((x, y), (y, x)):
                    better = bits < least[one]
                    least[one[better]], who[one[better]] = bits[better], two[better]
            else:
                found.append(np.stack([x, y], 1))
            step += 1
        if best:
            x = np.flatnonzero(who >= 0)
            found = [np.stack([x, who[x]], 1)]
        ends = np.sort(c[np.concatenate(found)], axis=1) if found else np.zeros((0, 2), np.int64)
        ends = np.unique(ends, axis=0)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # rows of a group that may go on in the next batch: 2 * LOT or so
        for batch in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(now[0]):
                continue
            now = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            last = (now[0] != now[0][-1]) | (now[1] != now[1][-1]) | (now[2] != now[2][-1])
            cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
            held = [c[cut:] for c in now]
            if cut:
                yield pairs([c[:cut] for c in now])
        if held is not None:
            yield pairs(held)

    return ordered.mapInArrow(run, "a long, b long").distinct()


def similar_components(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2 (row keys), n_shingles and component_id of every row of docs (doc_id, text)."""
    with Scratch(docs.sparkSession) as work:
        return stored(_components(docs, work))


def _components(docs: DataFrame, work: Scratch) -> DataFrame:
    facts = work.stored(described(docs))
    rows = facts.filter("token is null")
    tops = facts.filter("token is not null").groupBy("token").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "token").limit(HOT_TOKENS).collect()
    hot, times = np.array([r.token for r in reversed(tops)], np.int64).view(np.uint64), np.array([r.times for r in reversed(tops)], np.int64)
    sizes = {r.n: r["count"] for r in rows.filter(f"n between 1 and {2 * HEAVIEST}").groupBy("n").count().collect()}
    most = boundary(sizes)

    # heavy: one shuffle of the prefixes gives the lists of at least two classes, their pivots and their members
    heavy = prefixes(docs, most, hot, times).repartition("token", "part")
    pivots = heavy.groupBy("token", "part").agg(F.min("c").alias("p"), F.max("c").alias("last"), F.count(F.lit(1)).alias("m")).filter("part >= 0 or p <> last")
    longest = F.when(F.col("part") >= 0, 1 << 40).otherwise(F.col("m"))  # lists in parts are the longest of all
    met_lists = heavy.join(pivots.select("token", "part", "p", longest.alias("m")).hint("merge"), ["token", "part"]).distinct()
    ranked = F.row_number().over(Window.partitionBy("c").orderBy(F.desc("m"), F.desc("token")))  # the lists of one set
    members = work.stored(met_lists.withColumn("rank", ranked).drop("m"))
    release(docs.sparkSession)
    # light: classes that share a subset key link with the key's first class of the smaller size
    light = subset_keys(rows.select("c", "n", "small").filter(F.col("n").between(1, most)).dropDuplicates(["c"]), most)
    lows = light.filter("low").groupBy("key").agg(F.min("c").alias("p"))
    light_links = work.stored(light.join(lows.hint("merge"), "key").filter("c <> p").select(F.col("c").alias("a"), F.col("p").alias("b")).distinct())

    lists = members.groupBy("c").agg(F.max("rank").alias("open"))
    ones = rows.join(lists.hint("merge"), "c").groupBy("c", "open").agg(F.min(F.struct("k1", "k2", "n", *SKETCH, "sketch")).alias("x"))
    near = work.stored(ones.select("c", "open", "x.*"))

    def texts_of(pairs: DataFrame) -> DataFrame:
        """(c, text) of the classes in pairs."""
        wanted = near.select("c", "k1", "k2").join(pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct().hint("merge"), "c", "left_semi")
        keyed = docs.select(*row_keys(), "text")
        texts = work.stored(keyed.join(wanted.hint("merge"), ["k1", "k2"]).select("c", "text").dropDuplicates(["c"]))
        release(docs.sparkSession)
        return texts

    # first round: each class meets the pivots of its lists; for lists in parts, the two pivots met most often or smallest
    split = members.filter("part >= 0").select("token", "c", "p")
    tops_of_lists = split.groupBy("token").agg(F.min("p").alias("p"))  # HOT_TOKENS rows at most
    often = split.select("token", "c").join(F.broadcast(tops_of_lists), "token").filter("c <> p").groupBy("c", "p").agg(F.count(F.lit(1)).alias("times"))
    two = often.groupBy("c").agg(F.min("p").alias("x"), F.max(F.struct("times", "p")).alias("y"))
    between = two.select(F.col("c").alias("a"), F.explode(F.array("x", "y.p")).alias("b"))
    met = members.filter("part < 0 and c <> p").select(F.col("c").alias("a"), F.col("p").alias("b")).unionByName(between)
    first = work.stored(likely(met.distinct(), near))
    texts = texts_of(first)
    best = first.groupBy("a").agg(F.min(F.struct("bits", "b")).alias("x")).select("a", "x.b")
    links = light_links.unionByName(work.stored(verified(best, texts)))
    work.discard(texts)
    joined = components(links)

    def apart_in(pairs: DataFrame, found: DataFrame) -> DataFrame:
        """The pairs whose classes are in different components, with both roots."""
        root = lambda side: found.select(F.col("node").alias(side), F.col("root").alias(f"r{side}"))
        named = pairs.join(root("a"), "a", "left").join(root("b"), "b", "left").select("a", "b", "bits", F.coalesce("ra", "a").alias("ra"), F.coalesce("rb", "b").alias("rb"))
        return named.filter("ra <> rb")

    # classes of different components that share a list: first the likeliest pair of each class, and of each two
    # components; then, with what this has joined, every pair that is still apart
    open_rows = members.filter("part >= 0 or c <> p").select("token", "c", "n", "rank")  # in a list of one part the pivot has met all others
    seen = first
    for best in (True, False):
        labelled = work.stored(open_rows.join(joined.select(F.col("node").alias("c"), "root"), "c", "left").withColumn("root", F.coalesce("root", "c")))
        mixed = labelled.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("m")).filter("x <> y").select("token", "m")
        open_lists = labelled.join(mixed.hint("merge"), "token").join(near.select("c", *SKETCH).hint("merge"), "c")
        seen = seen.unionByName(work.stored(likely(met_in_lists(open_lists, best), near)))
        work.discard(labelled)
        still = work.stored(apart_in(seen.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "bits").distinct(), joined))
        texts = texts_of(still.select("a", "b"))
        if best:
            pairs = still.groupBy(F.least("ra", "rb"), F.greatest("ra", "rb")).agg(F.min(F.struct("bits", "a", "b")).alias("x")).select("x.a", "x.b")
        else:
            pairs = still.select("a", "b")
        links = links.unionByName(work.stored(verified(pairs, texts)))
        work.discard(texts)
        joined = components(links)

    of = rows.select("doc_id", "k1", "k2", "c", "n").join(joined.select(F.col("node").alias("c"), "root"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    least = of.filter("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    out = of.join(least, "root", "left")
    return out.select("doc_id", "k1", "k2", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """docs without the rows that have a linked row of smaller (doc_id, row keys); all columns. Rows equal in doc_id and text go once."""
    found = similar_components(docs.select("doc_id", "text"))
    kept = found.filter("n_shingles > 0").groupBy("component_id").agg(F.min(F.struct("doc_id", "k1", "k2")).alias("x")).select("x.k1", "x.k2")
    empty = found.filter("n_shingles = 0 or component_id is null").select("k1", "k2").distinct()
    keys = kept.unionByName(empty).distinct()
    k1, k2 = row_keys()
    rows = docs.select("*", k1.alias("__k1"), k2.alias("__k2"))
    chosen = rows.join(keys.select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")), ["__k1", "__k2"], "left_semi")
    return chosen.dropDuplicates(["__k1", "__k2"]).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


#: Rows of similar_components() for a table `{source}`, and all columns. DuckDB.
ROWS_SQL = """
  WITH RECURSIVE {p}all AS (SELECT row_number() OVER (ORDER BY doc_id, text) AS r, * FROM {source}),
  {p}words AS (SELECT r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {p}all),
  {p}sets AS (SELECT r, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM {p}words),
  {p}tokens AS (SELECT r, unnest(s) AS t FROM {p}sets),
  {p}sizes AS (SELECT r, len(s) AS n FROM {p}sets),
  {p}common AS (SELECT a.r AS x, b.r AS y, count(*) AS i FROM {p}tokens a JOIN {p}tokens b ON a.t = b.t AND a.r < b.r GROUP BY ALL),
  {p}links AS (SELECT x, y FROM {p}common JOIN {p}sizes p ON p.r = x JOIN {p}sizes q ON q.r = y WHERE 100 * i >= 75 * (p.n + q.n - i)),
  {p}edges AS (SELECT x, y FROM {p}links UNION SELECT y, x FROM {p}links UNION SELECT r, r FROM {p}all),
  {p}reach(r, z) AS (SELECT x, y FROM {p}edges UNION SELECT c.r, e.y FROM {p}reach c JOIN {p}edges e ON c.z = e.x),
  {p}least AS (SELECT c.r, min(d.doc_id) AS component_id, min(c.z) AS first FROM {p}reach c JOIN {p}all d ON d.r = c.z GROUP BY c.r)
  SELECT a.* EXCLUDE (r), n AS n_shingles, component_id, first = a.r AS leads FROM {p}all a JOIN {p}sizes USING (r) JOIN {p}least USING (r)
"""
SQL = f"SELECT doc_id, n_shingles, component_id FROM ({ROWS_SQL.format(source='documents', p='s_')})"
