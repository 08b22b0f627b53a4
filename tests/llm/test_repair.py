import hashlib
import itertools
import random
import re
import zlib

from sluice.llm import repair

PATTERN = re.compile("(s?(ua)+)?")


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, rows in out.items()}


def brute(rows):
    """By least (cost, letters, repaired) of each output initials' state, rows one by one."""
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))

    def prefix(s):  # of the pattern, or not
        return any(PATTERN.fullmatch(s + more) for more in ("", "a", "ua"))

    short = lambda s: s if len(s) < 2 else "u" if s[-1] == "u" else "ua"  # noqa: E731  what may follow is the same

    def inserted(ways):
        for _ in range(2):
            new = {}
            for s, (c, x, out) in ways.items():
                for role in ("user", "assistant"):
                    if prefix(s + role[0]):
                        new.setdefault(short(s + role[0]), []).append((c + 3, x + "I", (*out, f"{role}:")))
            ways = {s: min([*new.get(s, []), *([ways[s]] if s in ways else [])]) for s in {*ways, *new}}
        return ways

    ways = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for s, (c, x, out) in inserted(ways).items():
            new.setdefault(s, []).append((c + 4, x + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault else 0
            for letter, cost, r in (("K", 0, role), ("R", 3, "user"), ("R", 3, "assistant")):
                if prefix(s + r[:1]):
                    new.setdefault(short(s + r[:1]), []).append((c + cost + more, x + letter, (*out, f"{r}:{text}")))
        ways = {s: min(v) for s, v in new.items()}
    cost, audit, out = min(v for s, v in inserted(ways).items() if PATTERN.fullmatch(s))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def exhaustive(facts):
    """Least (cost, letters) over all edits of a few rows, at most two inserts in each place."""
    found = []

    def go(i, said, cost, letters):
        for n in range(3):
            for added in itertools.product("ua", repeat=n):
                s, c, x = said + "".join(added), cost + 3 * n, letters + "I" * n
                if i == len(facts):
                    if PATTERN.fullmatch(s):
                        found.append((c, x))
                    continue
                initial, gone, cut, more = facts[i]
                go(i + 1, s, c + 4 + 4 * more, x + "D" + "D" * more)
                if not gone:
                    for letter, price, r in (("K", 0, initial), ("R", 3, "u"), ("R", 3, "a")):
                        go(i + 1, s + r, c + price + 3 * cut + 4 * more, x + letter + "D" * more)

    go(0, "", 0, "")
    return min(found)


def test_every_short_conversation():
    kinds = [("u", False, False, 0), ("a", False, True, 0), ("a", False, False, 1), ("s", False, False, 0), ("s", True, False, 0), (" ", False, False, 0), ("", False, True, 0)]
    for n in range(3):
        for facts in itertools.product(kinds, repeat=n):
            assert repair.solve(list(facts)) == exhaustive(facts), facts


def rows_of(rng, conv, n, texts, roles=("user", "assistant", "system", "tool", None, "")):
    return [(conv, rng.choice([None, *range(n + 3)]) if rng.random() < 0.3 else t, rng.choice(roles), rng.choice(texts)) for t in range(n)]


def sample():
    rng = random.Random(7)
    texts = ["Hello.", "Why?", "no end", " ", "", None, "\n\tx!  \n", "é?", "日本", "same.", "." * 3]
    rows = [r for conv in range(120) for r in rows_of(rng, conv, rng.randint(1, 7), texts)]
    rows += [r for conv in range(120, 130) for r in rows_of(rng, conv, 12, [f"text {i}." for i in range(40)], ("user", "assistant"))]
    rows += rows_of(rng, None, 9, texts) + [(200, None, None, None)] * 3 + [(201, 5, "user", "long " * 20_000 + ".")] + rows[:20]
    return rows


def check(found, rows):
    expected = {c: brute(r) for c, r in damaged(rows).items()}
    got = {r[0]: tuple(r)[1:] for r in found.collect()}
    assert got.keys() == expected.keys()
    for c in expected:
        assert got[c] == expected[c], c


def test_against_brute_force(spark):
    rows = sample()
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, audit string")
    found = repair.repair(repair.damage(frame))
    check(found, rows)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert repair.repair(repair.damage(frame.limit(0))).collect() == []


def test_one_conversation_over_all_tasks(spark):
    """A conversation that holds most rows, with copies that come back far apart, is solved in parts."""
    rng = random.Random(3)
    rows = rows_of(rng, 5, 3000, [f"text {i}{rng.choice(['.', '', '?'])}" for i in range(1200)] + ["", None]) + rows_of(rng, 4, 6, ["a.", "b"]) + rows_of(rng, 6, 300, ["a.", "b", "c!"])
    rows += [(7, 1, "user", "again.")] * 500
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        check(repair.repair(repair.damage(frame)), rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(repair.query(spark, sf), rows)
