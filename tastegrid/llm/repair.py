"""Repair of conversations whose turns are damaged, by lightest derivations.

A conversation read in order is to become ``(s?(ua)+)?`` in the first letters of its roles.  Each row is kept, gets
another role or is deleted, and turns may be inserted.  An item ``(i, p)`` says: rows i and later can follow
what leaves the pattern in state p.  It is derived from an item of the rows after it and from the row's own item:

    row(i) does e in state p, giving q       item(i + 1, q)
    ----------------------------------------------------------       cost(e) + cost, letter(e) + audit
    item(i, p)

Inserting derives ``(i, p)`` from ``(i, q)``.  Weights are (cost, audit), audits compared by their letters.  Knuth's algorithm
pops items from an agenda by (cost, rows read, audit): each deduction adds cost or reads a row, so its result never comes before
what it was made from, the first pop of an item is final, and the search ends when the goal item is popped.

Long conversations.  The same deductions run inside blocks of ``BLOCK`` rows for every pair of states (``from p to q``), and
blocks are joined by the rule ``(p to r) and (r to q) give (p to q)``.  Two audits of the same rows and
the same cost are never one the beginning of the other (what is longer holds more inserts, which cost), so the least
parts make the least whole.  Rows are cut into range slices by (conversation, order), a task reduces the part of a conversation
that lies in its slice, and one more task joins the parts in order, at most one for each slice.  Texts take no part in this: they are
met again by row number.  The audit is one value of a row, so a conversation has less than 2^31 edits.

Faults.  A row without a character other than white space is blank; one whose role and text came earlier is a duplicate; one whose last
such character is none of ``. ! ?`` is truncated; the first that holds counts.

Edge cases: null roles and texts count as one space, a null conversation id is an id like others, null turns come first;
rows of one turn are ordered by role, then by a hash of the text, so equal rows are neighbours; repeated rows count each (all but
the first are duplicates); an empty role has no letter and cannot stay; a conversation without rows has no edits; an empty
table gives no rows; only ``conv_id, turn, role, text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import store_slices
from ..session import materialize

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
BLOCK = 64
#: state -> first letter of the next role -> state.  0: nothing yet, 1: after s, 2: after u, 3: after a.
STEPS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ACCEPTED = (0, 3)
GIVEN = {"u": "user", "a": "assistant"}
FINE, BLANK, DUPLICATE, TRUNCATED = "-", "b", "d", "t"
SPACE = r"[\x20\x09-\x0D]"

Value = tuple[int, str]


# --- lightest derivations ---------------------------------------------------------------------


def row_edits(letter: str, fault: str, state: int) -> Iterator[tuple[str, int, int]]:
    """``(edit, cost, next state)`` of what can be done with a row in a state."""
    yield DELETE, COST[DELETE], state
    if fault in (BLANK, DUPLICATE):
        return
    more = TRUNCATED_COST if fault == TRUNCATED else 0
    after = STEPS[state]
    if letter in after:
        yield KEEP, COST[KEEP] + more, after[letter]
    for given in GIVEN:
        if given in after:
            yield REROLE, COST[REROLE] + more, after[given]


@functools.lru_cache(maxsize=1 << 10)
def _arrivals(letter: str, fault: str, state: int) -> list[tuple[int, str, int]]:
    """``(state before, edit, cost)`` of what can be done with a row to reach a state."""
    return [(before, edit, cost) for before in STEPS for edit, cost, after in row_edits(letter, fault, before) if after == state]


def _deductions(rows: tuple[tuple[str, str], ...], place: int, state: int) -> Iterator[tuple[tuple[int, int], str, int]]:
    """``(item, edit, cost)``: the items that can be derived from ``(place, state)``, a state after the edit."""
    if place:
        for before, edit, cost in _arrivals(*rows[place - 1], state):
            yield (place - 1, before), edit, cost
    for before, after in STEPS.items():
        if state in (after.get(given) for given in GIVEN):
            yield (place, before), INSERT, COST[INSERT]


def lightest(rows: tuple[tuple[str, str], ...], ends: dict[int, Value], goals: tuple[int, ...] = (0,)) -> dict[int, Value]:
    """The least (cost, audit) of all ``rows`` from each goal state to one of ``ends``, which have weights of their own."""
    agenda = [(cost, 0, audit, (len(rows), state)) for state, (cost, audit) in ends.items()]
    heapq.heapify(agenda)
    final: dict[tuple[int, int], Value] = {}
    wanted = {(0, state) for state in goals}
    while agenda and wanted:
        cost, _, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = cost, audit
        wanted.discard(item)
        for derived, edit, more in _deductions(rows, *item):
            if derived not in final:
                heapq.heappush(agenda, (cost + more, len(rows) - derived[0], edit + audit, derived))
    return {state: final[0, state] for state in goals if (0, state) in final}


Part = dict[tuple[int, int], Value]


@functools.lru_cache(maxsize=1 << 14)
def _block(rows: tuple[tuple[str, str], ...]) -> Part:
    out = {}
    for end in STEPS:
        for start, value in lightest(rows, {end: (0, "")}, tuple(STEPS)).items():
            out[start, end] = value
    return out


def joined(one: Part, two: Part) -> Part:
    """The deduction of a longer part from two that follow each other."""
    out: Part = {}
    for (p, r), (cost, audit) in one.items():
        for (s, q), (more, rest) in two.items():
            if r == s and ((p, q) not in out or (cost + more, audit + rest) < out[p, q]):
                out[p, q] = cost + more, audit + rest
    return out


def part_of(rows: list[tuple[str, str]], block: int = BLOCK) -> Part:
    """Items ``(from, to)`` of any number of rows: blocks, joined two by two."""
    known = [(letter if letter in ("s", "u", "a") else "", fault) for letter, fault in rows]
    parts = [_block(tuple(known[i:i + block])) for i in range(0, len(known), block)]
    while len(parts) > 1:
        parts = [joined(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


@functools.lru_cache(maxsize=1)
def _endings() -> dict[int, Value]:
    """What is left to insert after the last row, from each state."""
    return lightest((), {state: (0, "") for state in ACCEPTED}, tuple(STEPS))


def best_repair(part: Part | None) -> Value:
    ends = _endings()
    return min(((cost + ends[q][0], audit + ends[q][1]) for (p, q), (cost, audit) in part.items() if p == 0), default=(0, "")) if part else (0, "")


def given_roles(audit: str, start: int = 0, odd: bool = False) -> list[str]:
    """The role letter of each output turn of ``audit``; the first of an odd number is s, then u and a take turns.  ``start`` turns came before."""
    return ["s" if odd and i == 0 else "ua"[(i - odd) % 2] for i in range(start, start + sum(c != DELETE for c in audit))]


# --- rows to faults ---------------------------------------------------------------------------


def damage(turns: DataFrame) -> DataFrame:
    """Drops, empties, truncates, repeats or reroles rows, by a checksum of conversation and turn."""
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return turns.withColumn("kind", kind).filter("kind != 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _fault(text: Column, first: Column) -> Column:
    seen = F.rtrim(F.regexp_replace(text, SPACE, " "))
    return F.when(seen == "", BLANK).when(~first, DUPLICATE).when(~F.substring(seen, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(FINE)


def _flagged(rows: DataFrame) -> DataFrame:
    """``(row_id, conv_id, turn, role, mark, fault)`` of stored, numbered rows; ``mark`` is a hash of the text.

    The first row of each (conversation, role, text) is found by aggregates and met again by its number,
    so many equal rows are no hot key.
    """
    mark = F.md5(F.col("text").cast("binary"))
    firsts = rows.groupBy("conv_id", "role", mark.alias("mark")).agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "row_id")).alias("first")).select(F.col("first.row_id"), F.lit(True).alias("is_first"))
    return rows.join(firsts, "row_id", "left").select(
        "row_id", "conv_id", "turn", "role", mark.alias("mark"), _fault(F.col("text"), F.coalesce("is_first", F.lit(False))).alias("fault"))


ORDER = ["turn", "role", "mark", "row_id"]


def _sorted_parts(sliced: DataFrame, extra: list[Column]) -> DataFrame:
    """Rows of one conversation and slice next to each other and in order, in one task."""
    return sliced.repartition("conv_id", "slice").sortWithinPartitions("conv_id", "slice", *extra, *[F.col(c).asc_nulls_first() for c in ORDER])


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], columns: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of each key, as they follow each other over batches."""
    current, held = None, []
    for batch in batches:
        named = {c: batch.column(c).to_pylist() for c in (*keys, *columns)}
        for key, row in zip(zip(*[named[k] for k in keys]), zip(*[named[c] for c in columns])):
            if key != current:
                if held:
                    yield current, held
                current, held = key, []
            held.append(row)
    if held:
        yield current, held


PART_COLUMNS = "conv_id long, slice int, n_rows long, turns long, first_turn long, last_turn long, blank long, duplicate long, truncated long, illegal long, " \
    "first_letter string, last_letter string, pairs array<int>, costs array<long>, audits array<string>"
LEGAL = ("su", "ua", "au")


def _illegal(letters: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(letters, letters[1:]))


def _parts(sliced: DataFrame) -> DataFrame:
    """One row for the part of a conversation in a slice: counts, and the items of its rows."""
    names = [c.split()[0] for c in PART_COLUMNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(out):
            return pa.RecordBatch.from_pylist(out, schema=schema)

        out = []
        for (conv_id, number), rows in _groups(batches, ["conv_id", "slice"], ["turn", "letter", "fault"]):
            turns = [t for t, _, _ in rows if t is not None]
            letters, faults = [x for _, x, _ in rows], [f for _, _, f in rows]
            items = sorted(part_of(list(zip(letters, faults))).items())
            out.append({
                "conv_id": conv_id, "slice": number, "n_rows": len(rows), "turns": len(set(turns)), "first_turn": min(turns, default=None),
                "last_turn": max(turns, default=None), "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE),
                "truncated": faults.count(TRUNCATED), "illegal": _illegal(letters), "first_letter": letters[0], "last_letter": letters[-1],
                "pairs": [4 * p + q for (p, q), _ in items], "costs": [c for _, (c, _) in items], "audits": [a for _, (_, a) in items]})
            if len(out) >= 1000:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32()),
             "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in PART_COLUMNS.split(", ")])
    letter = F.substring("role", 1, 1).alias("letter")
    return _sorted_parts(sliced, []).select("conv_id", "slice", "turn", letter, "fault").mapInArrow(run, PART_COLUMNS).select(*names)


SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


class _Conversation:
    """Joins the parts of a conversation as they come.  Of earlier parts it keeps the items from the start and each one's number of rows."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.items, self.sizes = conv_id, None, []
        self.figures = dict.fromkeys(SUMMARY, 0)
        self.letter, self.turns, self.low, self.high = None, 0, None, None

    def add(self, part: dict) -> None:
        own = {divmod(pair, 4): (c, a) for pair, c, a in zip(part["pairs"], part["costs"], part["audits"])}
        self.items = {k: v for k, v in own.items() if k[0] == 0} if self.items is None else joined(self.items, own)
        self.sizes.append((part["slice"], part["n_rows"]))
        for c in ("blank", "duplicate", "truncated", "illegal"):
            self.figures[c] += part[c]
        if self.letter is not None:
            self.figures["illegal"] += _illegal([self.letter, part["first_letter"]])
        self.letter = part["last_letter"]
        if part["first_turn"] is not None:
            self.turns += part["turns"] - (self.high == part["first_turn"])
            self.low, self.high = part["first_turn"] if self.low is None else self.low, part["last_turn"]

    def pieces(self) -> list[dict]:
        """A row for each part: the edits up to its last row (after it, for the last part) and how many turns come before."""
        self.figures["gaps"] = self.high - self.low + 1 - self.turns if self.turns else 0
        self.figures["cost"], audit = best_repair(self.items)
        odd, at, before, out = (len(audit) - audit.count(DELETE)) % 2 == 1, 0, 0, []
        for i, (number, n_rows) in enumerate(self.sizes):
            end = at
            while n_rows:
                n_rows -= audit[end] != INSERT
                end += 1
            piece = audit[at:end] if i + 1 < len(self.sizes) else audit[at:]
            first = {**self.figures, "audit": audit} if i == 0 else {}
            out.append({"conv_id": self.conv_id, "slice": number, "piece": piece, "before": before, "odd": odd, **first})
            at, before = end, before + len(piece) - piece.count(DELETE)
        return out


def _whole(parts: DataFrame) -> DataFrame:
    """One row for each part, with the edits of its rows (``piece``), the turns given before it, and on the first part the figures of the conversation."""
    schema = pa.schema([("conv_id", pa.int64()), ("slice", pa.int32()), ("piece", pa.string()), ("before", pa.int64()), ("odd", pa.bool_()),
                        *[(c, pa.int64()) for c in SUMMARY], ("audit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, whole = [], None
        for batch in batches:
            for part in batch.to_pylist():
                if whole is None or part["conv_id"] != whole.conv_id:
                    out += whole.pieces() if whole else []
                    whole = _Conversation(part["conv_id"])
                whole.add(part)
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
        out += whole.pieces() if whole else []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    ddl = "conv_id long, slice int, piece string, before long, odd boolean, " + ", ".join(f"{c} long" for c in SUMMARY) + ", audit string"
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "slice").mapInArrow(run, ddl)


def _edits(sliced: DataFrame, pieces: DataFrame) -> DataFrame:
    """``(conv_id, place, row_id, edit, letter)`` of every row and every inserted turn (``row_id`` null), in order of ``place``."""
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("row_id", pa.int64()), ("edit", pa.string()), ("letter", pa.string())])
    rows = sliced.select("conv_id", "slice", *ORDER, F.lit(None).cast("string").alias("piece"), F.lit(None).cast("long").alias("before"),
                         F.lit(None).cast("boolean").alias("odd"))
    nothing = [F.lit(None).cast(sliced.schema[c].dataType).alias(c) for c in ORDER]
    heads = pieces.select("conv_id", "slice", *nothing, "piece", "before", "odd")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (conv_id, number), held in _groups(batches, ["conv_id", "slice"], ["piece", "before", "odd", "row_id"]):
            piece, before, odd, _ = held[0]
            roles, ids = iter(given_roles(piece, before, odd)), iter(r[3] for r in held[1:])
            for i, edit in enumerate(piece):
                out.append({"conv_id": conv_id, "place": (number << 40) + i, "row_id": None if edit == INSERT else next(ids), "edit": edit,
                            "letter": None if edit == DELETE else next(roles)})
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    both = _sorted_parts(rows.unionByName(heads), [F.col("piece").isNull()])
    return both.select("conv_id", "slice", "row_id", "piece", "before", "odd").mapInArrow(run, "conv_id long, place long, row_id long, edit string, letter string")


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edits and the figures of every conversation in ``turns`` (conv_id, turn, role, text).

    Edits: ``(conv_id, place, edit, turn, role, text)``, one row for every turn and every inserted one, in order of ``place`` within a
    conversation; role and text are those after the repair (deleted rows keep theirs).  Figures: ``(conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit)``.
    """
    numbered = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit(" ")).alias("role"),
                            F.coalesce("text", F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("row_id"))
    rows = materialize(numbered, "repair-rows")
    sliced = store_slices(_flagged(rows), ["conv_id"], [F.col(c).asc_nulls_first() for c in ORDER], "repair-slices")
    pieces = materialize(_whole(materialize(_parts(sliced), "repair-parts")), "repair-pieces")
    role = F.when(F.col("edit").isin(REROLE, INSERT), F.when(F.col("letter") == "u", GIVEN["u"]).otherwise(GIVEN["a"])).otherwise(F.col("role"))
    edits = materialize(_edits(sliced, pieces), "repair-edits")
    met = edits.filter(F.col("edit") != INSERT).join(rows.select("row_id", "turn", "role", "text"), "row_id")
    added = edits.filter(F.col("edit") == INSERT).select("*", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"))
    edits = met.unionByName(added).select("conv_id", "place", "edit", "turn", role.alias("role"), "text")
    return edits, pieces.filter("audit IS NOT NULL").select("conv_id", *SUMMARY, "audit")


def repaired_digests(edits: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)``: the hash of ``role:text`` of the turns that stay, joined by newlines.

    Such a hash can only be taken in order, so the turns of a conversation pass through one task, as a stream that holds none of them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, ids, sums = None, None, [], []
        for batch in batches:
            for conv_id, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist()):
                if digest is None or conv_id != current:
                    if digest is not None:
                        ids.append(current)
                        sums.append(digest.hexdigest())
                    current, digest = conv_id, hashlib.sha256(line.encode("utf-8", "surrogatepass"))
                else:
                    digest.update(b"\n" + line.encode("utf-8", "surrogatepass"))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sums)], ["conv_id", "repaired_sha256"])
                ids, sums = [], []
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])

    lines = edits.filter(F.col("edit") != DELETE).select("conv_id", "place", F.concat_ws(":", "role", "text").alias("line"))
    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "line").mapInArrow(run, "conv_id long, repaired_sha256 string")


def repair_statistics(turns: DataFrame) -> DataFrame:
    """One row for every conversation of ``turns``, repaired after ``damage``."""
    edits, figures = repair(damage(turns))
    every = turns.select(F.col("conv_id").cast("long")).distinct()
    digests = repaired_digests(edits)
    found = every.join(figures.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    found = found.join(digests.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    zero = F.lit(0).cast("long")
    return found.select("conv_id", *[F.coalesce(c, zero).alias(c) for c in SUMMARY], F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
