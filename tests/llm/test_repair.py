"""Conversation repair against all derivations of short inputs and a plain table of suffixes for long ones."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tastegrid.llm import queries, repair

PATTERN = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def all_repairs(rows, inserts=2):
    """(cost, audit) of the cheapest, from every sequence of edits with some inserts at each place."""
    found = []
    options = []
    for letter, fault in rows:
        own = [("D", None, 3)]
        if fault not in "bd":
            own += [("K", letter, fault == "t"), ("R", "u", 2 + (fault == "t")), ("R", "a", 2 + (fault == "t"))]
        options.append(own)
    fills = [p for n in range(inserts + 1) for p in itertools.product("ua", repeat=n)]
    for edits in itertools.product(*options):
        for gaps in itertools.product(fills, repeat=len(rows) + 1):
            output, audit, cost = "", "", 0
            for i in range(len(rows) + 1):
                output, audit, cost = output + "".join(gaps[i]), audit + "I" * len(gaps[i]), cost + 2 * len(gaps[i])
                if i < len(rows):
                    edit, letter, price = edits[i]
                    audit, cost = audit + edit, cost + price
                    output += letter or ""
            if PATTERN.fullmatch(output):
                found.append((cost, audit))
    return min(found)


@pytest.mark.parametrize("seed", range(6))
def test_lightest_of_all_derivations(seed):
    r = random.Random(seed)
    for _ in range(6):
        rows = [(r.choice("suax"), r.choice("--tbd")) for _ in range(r.randint(0, 3))]
        want = all_repairs(rows)
        assert repair.lightest(tuple(rows), repair._endings())[0] == want
        for block in (1, 2, 64):
            assert (repair.best_repair(repair.part_of(rows, block)) if rows else repair.best_repair(None)) == want


def plain_best(rows):
    """The same by a table of suffixes."""
    after = {0: (0, ""), 1: (4, "II"), 2: (2, "I"), 3: (0, "")}
    for letter, fault in reversed(rows):
        now = {}
        for p in range(4):
            options = [(after[p][0] + 3, "D" + after[p][1])]
            if fault not in "bd":
                for role in "sua":
                    q = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((p, role))
                    if q is not None:
                        if role == letter:
                            options.append((after[q][0] + (fault == "t"), "K" + after[q][1]))
                        if role != "s":
                            options.append((after[q][0] + 2 + (fault == "t"), "R" + after[q][1]))
            now[p] = min(options)
        for _ in range(3):
            for p, q in ((0, 2), (1, 2), (2, 3), (3, 2)):
                now[p] = min(now[p], (now[q][0] + 2, "I" + now[q][1]))
        after = now
    return after[0]


def plain_statistics(rows):
    held = defaultdict(list)
    for c, t, role, text in rows:
        own = held[c]
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for c, own in held.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, marked = set(), []
        for _, role, text in own:
            body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            fault = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "-"
            seen.add((role, text))
            marked.append((role[:1], fault))
        cost, audit = plain_best(marked)
        turns = {t for t, _, _ in own if t is not None}
        lines, queue, i = [], list(own), 0
        odd = sum(e != "D" for e in audit) % 2
        for edit in audit:
            _, role, text = queue.pop(0) if edit != "I" else (None, "", "")
            if edit == "D":
                continue
            lines.append(f"{role if edit == 'K' else ['user', 'assistant'][(i - odd) % 2]}:{text}")
            i += 1
        faults = Counter(f for _, f in marked)
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        out.append((c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults["b"], faults["d"], faults["t"], illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def conversations(seed, n, longest=9):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "unknown"]
    texts = ["Fine.", "Cut off", "Why?", " \t\n", "", None, "So!  ", "dot.  ", "Ok", "日本。"]
    rows = []
    for c in range(n):
        turn = r.randint(-3, 3)
        for _ in range(r.randint(1, longest)):
            rows.append((c if c else None, r.choice([turn, turn, turn, None]), r.choice(roles), r.choice(texts) if r.random() < 0.5 else f"Turn {r.random()}" + r.choice(".?x")))
            turn += r.choice([1, 1, 1, 2, 0])
    return rows


def test_statistics_against_plain_lists(spark):
    rows = conversations(1, 120) + [(5, 7, "user", "Same.")] * 4
    df = spark.createDataFrame(rows, SCHEMA).withColumn("slice", F.lit("clash")).withColumn("row_id", F.lit(1)).repartition(5)
    got = repair.repair_statistics(df).collect()
    assert Counter(map(tuple, got)) == Counter(plain_statistics(rows))
    assert got[0].asDict().keys() == dict.fromkeys(["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]).keys()


def test_one_conversation_over_many_slices(spark):
    """Half of all rows are one conversation, many of them equal."""
    r = random.Random(3)
    long = [(1000, t, r.choice(["user", "assistant", "assistant", "system"]), r.choice(["Yes.", f"Turn {t}.", f"Turn {t}", ""])) for t in range(0, 1500)]
    rows = long + conversations(2, 200, 12)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.createDataFrame(rows, SCHEMA)
        numbered = repair.materialize(df.withColumn("row_id", F.monotonically_increasing_id()), "test-rows")
        sliced = repair.store_slices(repair._flagged(numbered), ["conv_id"], [F.col(c).asc_nulls_first() for c in repair.ORDER], "test-slices")
        assert sliced.filter("conv_id = 1000").select("slice").distinct().count() > 2
        got = repair.repair_statistics(df).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert Counter(map(tuple, got)) == Counter(plain_statistics(rows))


def test_edits_are_rows_in_order(spark):
    rows = [(1, 1, "system", "Be kind."), (1, 2, "assistant", "Hello."), (1, 3, "assistant", "Hello."), (1, 4, "user", "And"), (2, 1, "user", " ")]
    edits, figures = repair.repair(spark.createDataFrame(rows, SCHEMA))
    got = [tuple(r) for r in edits.orderBy("conv_id", "place").select("conv_id", "edit", "turn", "role", "text").collect()]
    audit = {r.conv_id: r.audit for r in figures.collect()}
    assert audit == {c: plain_best(m)[1] for c, m in {1: [("s", "-"), ("a", "-"), ("a", "d"), ("u", "t")], 2: [("u", "b")]}.items()}
    assert "".join(e for c, e, *_ in got if c == 1) == audit[1] and "".join(e for c, e, *_ in got if c == 2) == "D"
    kept = [r for r in got if r[0] == 1 and r[1] != "D"]
    assert PATTERN.fullmatch("".join(r[3][0] for r in kept)) and [r[4] for r in got if r[1] == "I"] == [""] * audit[1].count("I")


def test_nothing_to_repair(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair_statistics(empty).count() == 0
    dropped = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = repair.repair_statistics(spark.createDataFrame([(dropped, 0, "user", "Gone.")], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_long_conversations_in_blocks():
    rows = [("u" if i % 3 else "a", "-t"[i % 2]) for i in range(1000)]
    assert repair.best_repair(repair.part_of(rows)) == plain_best(rows)
    assert repair.given_roles("IKDR", 0, True) == ["s", "u", "a"] and repair.given_roles("KK", 3, True) == ["u", "a"]
