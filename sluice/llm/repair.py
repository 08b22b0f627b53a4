"""Conversation repair: cheapest edits by tight arcs of a graph of rows and roles.

A node is a place between rows and a state of the role pattern ``(s?(ua)+)?``: nothing yet, after the system row, after a user
row, after an assistant row. Arcs keep, rerole or delete the next row, or insert an empty one. Minimum costs forward from
the start and backward from the ends name the arcs that lie on some cheapest path (forward + arc + backward = least cost).
The nodes that the letters so far can reach form a frontier; of the tight arcs that leave it those of least letter are taken.

Rows of a conversation are ordered by turn (null first), then role, then text; equal rows are one row with a count,
summed before any shuffle, as all copies but the first are deleted. Rows are spread by ranges of that order, so a conversation
of any size spreads over tasks. Conversations that lie within one task are solved there. Those that touch the edge of a
range, at most two a task, are solved in parts: each part yields its least (cost, letters) between every two states, the
parts' tables are composed in order, and one pass over the rows in order follows the letters, counts and hashes. That pass
holds one row and the letters at a time: SHA-256 of a whole conversation allows nothing that is more parallel.

Nulls: a null role or text is one blank, and so is a null conv_id or turn in the checksum; rows of null conv_id are one
conversation, and null turns take no part in `gaps`. An empty role has no initial, and may be kept anywhere. A conversation of which no row is left has zeros, an empty audit and the hash of the empty
text. Only conv_id, turn, role and text are read, so names never clash; an empty table gives no rows; long texts need nothing
else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, stored, table

NAME = "op11_conversation_repair"
WHITE = " \t\n\x0b\x0c\r"
#: Characters of a text that take part in cutting ranges; the order within a range is by whole texts.
RANGE_CHARS = 64

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: The role that may be added in a state, and the state it leads to.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: The state after a kept row, by state and role initial.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = (START, ASSISTANT)
NEVER = 1 << 60

#: What the search knows of a row: role initial, whether it must go, whether it is truncated, how many copies follow.
Fact = tuple[str, bool, bool, int]


def arcs(fact: Fact) -> list[list[tuple[str, int, int]]]:
    """(letter, state after, cost) of the arcs over one row, from each state; letters ascend."""
    initial, gone, cut, more = fact
    again = DELETE * more
    out = []
    for q in STATES:
        found = [("D", q, DELETE + again)]
        if not gone:
            extra = (TRUNCATED if cut else 0) + again
            if not initial or (q, initial) in KEPT:
                found.append(("K", KEPT.get((q, initial), q), KEEP + extra))
            found.append(("R", NEXT[q], REROLE + extra))
        out.append(found)
    return out


def with_inserts(cost: list[int]) -> list[int]:
    """Costs of reaching each state when rows may be inserted too."""
    user = min(cost[USER], min(cost[START], cost[SYSTEM], cost[ASSISTANT]) + INSERT)
    return [cost[START], cost[SYSTEM], user, min(cost[ASSISTANT], user + INSERT)]


def before_inserts(cost: list[int]) -> list[int]:
    """Costs still to come from each state when rows may be inserted first."""
    user = min(cost[USER], cost[ASSISTANT] + INSERT)
    assistant = min(cost[ASSISTANT], cost[USER] + INSERT)
    return [min(cost[START], user + INSERT), min(cost[SYSTEM], user + INSERT), user, assistant]


def solve(facts: list[Fact], entry: int = START, ends: Iterable[int] = ENDS) -> tuple[int, str]:
    """The least cost from the state `entry` to one of `ends`, and the least letters of that cost; NEVER if there is no way."""
    steps: dict[Fact, list] = {}
    layers = [steps.get(f) or steps.setdefault(f, arcs(f)) for f in facts]
    forward = [with_inserts([0 if q == entry else NEVER for q in STATES])]
    for layer in layers:
        at, reached = forward[-1], [NEVER] * 4
        for q in STATES:
            for _, to, cost in layer[q]:
                reached[to] = min(reached[to], at[q] + cost)
        forward.append(with_inserts(reached))
    backward = [before_inserts([0 if q in ends else NEVER for q in STATES])]
    for layer in reversed(layers):
        after = backward[-1]
        backward.append(before_inserts([min(cost + after[to] for _, to, cost in layer[q]) for q in STATES]))
    backward.reverse()
    least = backward[0][entry]
    if least >= NEVER:
        return NEVER, ""
    letters, place, frontier, last = [], 0, {entry}, len(facts)
    while place < last or not any(q in ends and forward[place][q] == least for q in frontier):
        best, reached = "~", set()
        for q in frontier:
            so_far = forward[place][q]
            here = layers[place][q] if place < last else ()
            tight = [(x, to) for x, to, cost in here if so_far + cost + backward[place + 1][to] == least]
            if so_far + INSERT + backward[place][NEXT[q]] == least and forward[place][NEXT[q]] == so_far + INSERT:
                tight.append(("I", NEXT[q]))
            for x, to in tight:
                if x < best:
                    best, reached = x, {to}
                elif x == best:
                    reached.add(to)
        letters.append(best)
        if best != "I":
            letters.append("D" * facts[place][3])
            place += 1
        frontier = reached
    return least, "".join(letters)


class Replay:
    """Counts of a conversation's rows in order, and the repair that the letters make of them. Holds nothing but its letters."""

    def __init__(self, letters: str):
        self.letters, self.at, self.state = letters, 0, START
        self.turns: list[int | None] = [None, None, 0]  # least, last and the number of different ones: rows come by turn
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.initial: str | None = None
        self.sha, self.any = hashlib.sha256(), False

    def write(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any = True

    def inserts(self) -> None:
        while self.letters[self.at : self.at + 1] == "I":
            self.state = NEXT[self.state]
            self.write(ROLE[self.state], "")
            self.cost += INSERT
            self.at += 1

    def row(self, turn: int | None, role: str, text: str, copies: int, blank: bool, seen: bool, cut: bool) -> None:
        if turn is not None:
            low, last, n = self.turns
            self.turns = [turn if low is None else low, turn, n + (turn != last)]
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - (not seen)
            self.truncated += cut and not seen
        initial = role[:1]
        self.illegal += copies - 1 + (self.initial is not None and self.initial + initial not in ("su", "ua", "au"))
        self.initial = initial
        self.inserts()
        letter = self.letters[self.at]
        self.at += copies
        self.cost += DELETE * (copies - 1)
        if letter == "D":
            self.cost += DELETE
            return
        self.cost += TRUNCATED if cut else 0
        if letter == "R":
            self.cost += REROLE
            self.state = NEXT[self.state]
            role = ROLE[self.state]
        else:
            self.state = KEPT.get((self.state, initial), self.state)
        self.write(role, text)

    def result(self) -> tuple:
        self.inserts()
        low, last, n = self.turns
        return (last - low + 1 - n if n else 0, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, self.letters, self.sha.hexdigest())


def faults(text: str) -> tuple[bool, bool]:
    """Whether a text is blank, and whether its last character other than white space is none of ``.!?``."""
    end = text.rstrip(WHITE)
    return not end, bool(end) and end[-1] not in ".!?"


def repaired(rows: list[tuple]) -> tuple:
    """The result of one whole conversation: (turn, role, text, copies) in order."""
    known, said, facts = set(), [], []
    for turn, role, text, copies in rows:
        if not copies:
            continue
        blank, cut = faults(text)
        seen = not blank and (role, text) in known
        known.add((role, text))
        said.append((turn, role, text, copies, blank, seen, cut))
        facts.append((role[:1], blank or seen, cut, copies - 1))
    replay = Replay(solve(facts)[1])
    for x in said:
        replay.row(*x)
    return replay.result()


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
ROW = "turn long, role string, text string, copies long"


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _mapped(df: DataFrame, of, columns: str) -> DataFrame:
    """of(iterator of row tuples) over each task's rows."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in columns.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    yield from zip(*(c.to_pylist() for c in batch.slice(at, 512).columns), strict=True)

        yield from _batches(of(rows()), schema)

    return df.mapInArrow(run, columns)


def _within(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Results of the conversations inside a range; the rows of its first and last conversation as they came."""
    nothing = (None,) * 8
    first, key, held = True, None, []

    def edge() -> Iterator[tuple]:
        return ((key, *nothing, part, i, *row) for i, row in enumerate(held))

    part = None
    for conv, turn, role, text, copies, part in rows:
        if held and conv != key:
            if first:
                yield from edge()
            else:
                yield (key, *repaired(held), *(None,) * 6)
            first, held = False, []
        key = conv
        held.append((turn, role, text, copies))
    yield from edge()


def _groups(rows: Iterator[tuple], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of equal first `width` values, which lie together."""
    key, held = None, []
    for row in rows:
        if held and row[:width] != key:
            yield key, held
            held = []
        key = row[:width]
        held.append(row[width:])
    if held:
        yield key, held


def _tables(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(key, part, costs, letters) of each part between every two states."""
    for (key, part), held in _groups(rows, 2):
        facts = [(initial, gone, cut, copies - 1) for _, initial, gone, cut, copies in held]
        found = [solve(facts, a, (b,)) for a in STATES for b in STATES]
        yield key, part, [c for c, _ in found], [x for _, x in found]


def _composed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(key, letters): the parts' tables put together in order."""
    for (key,), held in _groups(rows, 1):
        now: dict[int, tuple[int, str]] = {START: (0, "")}
        for _, costs, letters in held:
            ways = [(b, cost + costs[4 * a + b], path + letters[4 * a + b]) for a, (cost, path) in now.items() for b in STATES if costs[4 * a + b] < NEVER]
            now = {b: min((c, x) for to, c, x in ways if to == b) for b in {w[0] for w in ways}}
        yield key, min(now[q] for q in ENDS if q in now)[1]


def _followed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Results of conversations whose letters come before their rows."""
    key, conv, replay = None, None, None
    for k, part, _, conv_id, letters, turn, role, text, copies, seen in rows:
        if k != key:
            if replay:
                yield (conv, *replay.result())
            key, replay = k, Replay("")
        if part < 0:
            replay = Replay(letters)
            continue
        conv = conv_id
        if copies:
            blank, cut = faults(text)
            replay.row(turn, role, text, copies, blank, seen, cut)
    if replay:
        yield (conv, *replay.result())


def repair(rows: DataFrame) -> DataFrame:
    """One result for each conv_id of rows (conv_id, turn, role, text, copies), stored; rows of no copies only name their conv_id."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    counted = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), blank("role"), blank("text"), "copies").groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    place = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role"]
    spread = counted.repartitionByRange(*place, F.substring("text", 1, RANGE_CHARS)).sortWithinPartitions(*place, "text")
    with Scratch(rows.sparkSession) as work:
        first = work.stored(_mapped(spread.select("conv_id", "turn", "role", "text", "copies", F.spark_partition_id().alias("part")), _within, f"conv_id long, {RESULT}, part int, at long, {ROW}"))
        edge = first.filter("part is not null").withColumn("key", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
        # what was said before in its conversation
        said = edge.filter("copies > 0").select("key", "part", "at", F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", "role", F.lit(1)).alias("h2"))
        earliest = said.groupBy("key", "h1", "h2").agg(F.min(F.struct("part", "at")).alias("e"))
        new = said.join(earliest, ["key", "h1", "h2"]).select("key", "part", "at", (F.struct("part", "at") > F.col("e")).alias("seen"))
        flagged = work.stored(edge.filter("copies > 0").join(new, ["key", "part", "at"]))
        end = F.rtrim(F.translate("text", WHITE, " "))
        facts = flagged.select("key", "part", "at", F.substring("role", 1, 1).alias("initial"), (F.col("seen") | (end == "")).alias("gone"), (~end.rlike(r"[.!?]\z")).alias("cut"), "copies")
        tables = _mapped(facts.repartition("key", "part").sortWithinPartitions("key", "part", "at"), _tables, "key string, part int, costs array<long>, letters array<string>")
        letters = _mapped(tables.repartition("key").sortWithinPartitions("key", "part"), _composed, "key string, letters string")
        none = {"conv_id": "long", "turn": "long", "role": "string", "text": "string", "copies": "long", "seen": "boolean"}
        heads = letters.select("key", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("at"), "letters", *(F.lit(None).cast(t).alias(c) for c, t in none.items()))
        bare = edge.filter("copies = 0").withColumn("seen", F.lit(False))
        body = flagged.unionByName(bare.select(*flagged.columns)).select("key", "part", "at", F.lit(None).cast("string").alias("letters"), *none)
        stream = heads.unionByName(body).repartition("key").sortWithinPartitions("key", "part", "at").select("key", "part", "at", "conv_id", "letters", *list(none)[1:])
        followed = _mapped(stream, _followed, f"conv_id long, {RESULT}")
        return stored(first.filter("part is null").select(*followed.columns).unionByName(followed))


def damage(rows: DataFrame) -> DataFrame:
    """rows with the damage that the checksum of ``conv_id:turn`` picks, and their copies; dropped ones keep their conv_id alone."""
    name: list[Column] = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(name[0], F.lit(":"), name[1])) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).select(
        "conv_id",
        F.when(F.col("kind") != 0, F.col("turn")).alias("turn"),
        F.when(F.col("kind") == 0, "").when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(table(spark, sf_dir, "conversations")))
