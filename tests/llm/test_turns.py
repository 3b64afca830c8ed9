import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from freshet.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\f\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        harm = zlib.crc32(key.encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        out += [(conv, turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, marks):
    """Cost, audit and lines by looking at all edits of every suffix; inserted turns at most two in a row."""

    @lru_cache(None)
    def best(i, last, inserted):
        found = []
        if i == len(rows) and last in ("", "a"):
            found.append((0, "", ()))
        nxt = "a" if last == "u" else "u"
        name = {"a": "assistant", "u": "user"}[nxt]
        if inserted < 3:
            cost, audit, lines = best(i, nxt, inserted + 1)
            found.append((cost + 2, "I" + audit, (f"{name}:", *lines)))
        if i < len(rows):
            _, _, role, text = rows[i]
            cost, audit, lines = best(i + 1, last, 0)
            found.append((cost + 3, "D" + audit, lines))
            if marks[i] not in ("blank", "duplicate"):
                extra = marks[i] == "truncated"
                if role[:1] == nxt or (role[:1] == "s" and last == ""):
                    cost, audit, lines = best(i + 1, role[:1], 0)
                    found.append((cost + extra, "K" + audit, (f"{role}:{text}", *lines)))
                cost, audit, lines = best(i + 1, nxt, 0)
                found.append((cost + 2 + extra, "R" + audit, (f"{name}:{text}", *lines)))
        return min(found) if found else (10**9, "", ())

    for i in range(len(rows), 0, -1):  # from the end, to recurse one step only
        for last in ("", "s", "u", "a"):
            best(i, last, 0)
    return best(0, "", 0)


def order(row):
    return (row[1] is not None, row[1] or 0, row[2], row[3])


def brute(rows, ids):
    out = []
    for conv in ids:
        own = sorted((r for r in rows if r[0] == conv), key=order)
        marks = faults(own)
        numbers = [r[1] for r in own if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = cheapest(own, marks)
        counts = [marks.count(m) for m in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed=1, count=150):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "open end", "", " \n", "a. b. c.", "é?", "ok.\t \n", "x.\x1f", None]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "ux", None]
    rows = []
    for conv in range(count):
        for turn in range(rng.randrange(1, 11)):
            if rng.random() < 0.5:
                role = "assistant" if turn % 2 else "user"
            else:
                role = rng.choice(roles)
            number = None if rng.random() < 0.1 else turn * rng.choice([1, 1, 1, 2])
            rows.append((conv if conv % 17 else None, number, role, f"{rng.randrange(99)} {rng.choice(['a.', 'b!', 'c'])}" if rng.random() < 0.6 else rng.choice(texts)))
    rows = [r for r in rows if r[0] is not None] + [r for r in rows if r[0] is None][:9]
    rng.shuffle(rows)
    return rows


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("block_rows", [1, 3, 32])
def test_damaged_conversations_equal_brute_force(spark, block_rows):
    rows = conversations()
    rows += [r for r in rows[:20]] + [(1000, 5, "user", "gone")] + [(2000 + i, 0, "user", "a.") for i in range(60)]
    frame = turns.damaged(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got(turns.repair(frame, F.col("present"), block_rows)) == brute(damage(rows), {r[0] for r in rows})


def test_undamaged_conversations(spark):
    rows = conversations(7, 60)
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert got(turns.repair(spark.createDataFrame(rows, SCHEMA))) == brute(plain, {r[0] for r in rows})


def test_repaired_turns_are_the_digest(spark):
    frame = spark.createDataFrame(conversations(3, 40), SCHEMA)
    lines = {}
    for r in turns.repaired_turns(frame).orderBy("conv_id", "place").collect():
        lines.setdefault(r["conv_id"], []).append((r["edit"], f"{r['role']}:{r['text']}"))
    for r in turns.repair(frame).collect():
        own = lines.get(r["conv_id"], [])
        assert hashlib.sha256("\n".join(line for _, line in own).encode()).hexdigest() == r["repaired_sha256"]
        assert "".join(e for e, _ in own) == r["audit"].replace("D", "")
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for _, line in own))


def test_long_conversation(spark):
    rng = random.Random(2)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), rng.choice([f"{i}.", f"{i}", "same.", ""])) for i in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(turns.repair(frame, block_rows=7)) == got(turns.repair(frame)) == brute(rows, {1})
    many = spark.range(60_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.col("id"), F.lit(".")).alias("text"))
    record = turns.repair(many).first()
    assert record["cost"] == 2 * 20_000 and set(record["audit"]) <= set("KIR")


def test_one_shuffle_by_conversation(spark):
    frame = spark.createDataFrame(conversations(3, 40), SCHEMA)
    plan = turns.repair(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in plan


def test_empty_and_clashing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert got(turns.repair(turns.damaged(none), F.col("present"))) == [] and got(turns.repaired_turns(none)) == []
    rows = conversations(5, 20)
    frame = spark.createDataFrame(rows, SCHEMA)
    extra = frame.withColumns({n: F.lit("x") for n in ("present", "copy", "fault", "initial", "letters", "again", "place")})
    assert got(turns.repair(extra)) == got(turns.repair(frame))
    assert got(turns.repair(turns.damaged(extra), F.col("present"))) == brute(damage(rows), {r[0] for r in rows})


def test_prices_are_distances():
    rng = random.Random(4)
    for _ in range(300):
        rows = [turns.Row(rng.choice("suat"), rng.choice(["", "", "truncated", "blank"])) for _ in range(rng.randrange(1, 9))]
        letters, prices = turns.policies(rows, turns._END)
        fake = [(1, i, {"s": "system", "u": "user", "a": "assistant", "t": "tool"}[r.initial], str(i)) for i, r in enumerate(rows)]
        cost, audit, _ = cheapest(fake, [r.fault for r in rows])
        walk = turns.Walk()
        for row, best in zip(rows, letters, strict=True):
            list(walk.row("", "", row, best))
        list(walk.finish())
        assert prices[0] == cost == walk.cost and audit == walk.audit.decode()
