"""N-gram Jaccard join: token-group count vectors in R-trees, exact sets for what survives.

A document's set is its distinct word shingles.  The shingles are hashed into ``GROUPS`` groups; how
many fall into each is a point.  Two sets overlap in at most the sum of the coordinate minima of
their points, and a box of an R-tree bounds that for all its points by its upper corner.  Pairs
whose bound reaches the overlap that the similarity needs are bounded once more by vectors of ``FINE_GROUPS`` groups and then verified on the sets themselves.

The trees are partitioned, because one tree over a whole corpus prunes nothing (in so many
dimensions every box covers the middle) and would be quadratic.  Two sets of similarity s share a
token among the first n - ceil(s n) + 1 of each in any common order, so each token leads a bucket of
the sets that have it there, and a bucket is indexed and searched on its own.  No link is lost by that
at any order; the order puts tokens that many documents share last, so that common passages do
not lead buckets.  A pair need only be found at its first common token, which gives the position test.

Equal sets are one class from the start.  Links are needed for components only, so there are two
rounds: in the first, each member of a bucket names its nearest candidate and the one of least
number, mostly the same ones in every bucket; what is verified there joins classes to components.  In the
second, all candidate pairs of different components are verified, whatever their number; pairs
inside a component could change nothing.  Buckets are cut into blocks of ``BLOCK`` members; the second
round meets every pair of blocks, so no bucket is too large for a task and no pair is left out.

Only candidate sets are ever stored; tokens are recomputed from the text.

Edge cases: a null or wordless text has an empty set and is its own component; fewer words than the
shingle are one shingle; repeated rows are equal sets; a null doc_id takes part but never names a
component (a component without any other id is null); ties cannot matter, links are symmetric.
Hashes have 64 bits (classes 128).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .batches import column_values

WIDTH = 5
PERCENT = 80
GROUPS = 128
BLOCK = 2048
FINE_GROUPS = 1024
FANOUT = 16
ONE_LEAF = 48
COMMON_ROWS = 1 << 22
COMMON_SHARE = 0.002
MAX_COMMON = 100_000
FILTER_WORDS = 1 << 18
SALTS = 64

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += _U(32)
_BYTE = _mix((_LOWER + _U(1)) * _U(0x9E3779B97F4A7C15))
_powers = np.ones(1, dtype=np.uint64)


def _power_table(n: int) -> np.ndarray:
    """Powers of the base, grown to the longest word seen."""
    global _powers
    if len(_powers) < n:
        table = np.full(max(n, 256), 0x9E3779B97F4A7C15 | 1, dtype=np.uint64)
        table[0] = 1
        _powers = np.multiply.accumulate(table)
    return _powers


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hash of each word in order, A-Z lower-cased."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    word = np.concatenate(([False], ~_SPACE[data], [False]))
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    offset = np.arange(len(data))
    first = np.zeros(len(data), dtype=np.int64)
    first[starts] = np.diff(starts, prepend=0)
    offset -= np.cumsum(first)
    inside = word[1:-1]
    terms = np.where(inside, _BYTE[data] * _power_table(int(lengths.max()))[np.where(inside, offset, 0)], _U(0))
    return _mix(np.add.reduceat(terms, starts) + lengths.astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    words = word_hashes(text)
    n = min(width, len(words))
    if not n:
        return words
    total = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for i in range(n):
        total = (total ^ words[i:i + len(total)]) * _U(0x9E3779B97F4A7C15)
        total ^= total >> _U(29)
    return np.unique(_mix(total + _U(n)))


def digest(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit digests of a set."""
    one, two = _mix(tokens).sum(dtype=np.uint64), _mix(tokens ^ _U(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    both = _mix(np.array([one + _U(len(tokens)), two], dtype=np.uint64)).view(np.int64)
    return int(both[0]), int(both[1])


def count_vector(tokens: np.ndarray, groups: int = GROUPS, kind: type = np.uint16) -> np.ndarray:
    """Tokens in each group; if a count overflows, every coordinate is the greatest number, which bounds nothing."""
    counts, most = np.bincount((tokens & _U(groups - 1)).astype(np.int64), minlength=groups), np.iinfo(kind).max
    return counts.astype(kind) if counts.max() < most else np.full(groups, most, dtype=kind)


def overlap_bounds(vectors: np.ndarray, sizes: np.ndarray | int, vector: np.ndarray) -> np.ndarray:
    """Most that sets with the count vectors ``vectors`` (or in boxes with these corners) share with a set of ``vector``.

    ``sizes`` is a bound that always holds; it counts where both vectors overflowed, for two such vectors bound nothing.
    """
    most = np.iinfo(vectors.dtype).max
    bound = np.minimum(vectors, vector).sum(axis=-1, dtype=np.int64)
    return np.where((vectors[..., 0] == most) & (vector[..., 0] == most), sizes, bound)


def needed_overlap(a, b, percent: int = PERCENT):
    """Least size of the intersection of sets of sizes a and b: 100 i >= percent (a + b - i)."""
    return -(-(percent * (a + b)) // (100 + percent))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


# --- R-tree of one bucket ---------------------------------------------------------------------


class CountTree:
    """Bulk-loaded R-tree of count vectors.  Boxes keep their upper corner and least set size: a query needs no more."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((vectors[:, 0], vectors.argmax(axis=1), sizes))
        self.vectors, self.sizes = vectors[self.order], sizes[self.order]
        self.levels = []
        corner, least = self.vectors, self.sizes
        while len(corner) > FANOUT:
            starts = np.arange(0, len(corner), FANOUT)
            corner, least = np.maximum.reduceat(corner, starts), np.minimum.reduceat(least, starts)
            self.levels.append((corner, least))

    def candidates(self, vector: np.ndarray, size: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the points that can be similar enough, and the bounds of their overlaps."""
        places = np.arange(len(self.levels[-1][0]) if self.levels else len(self.vectors))
        for depth in range(len(self.levels) - 1, -1, -1):
            corner, least = self.levels[depth]
            bound = overlap_bounds(corner[places], size, vector)
            places = places[bound >= needed_overlap(least[places], size, percent)]
            below = len(self.levels[depth - 1][0]) if depth else len(self.vectors)
            places = (places[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            places = places[places < below]
        bound = overlap_bounds(self.vectors[places], size, vector)
        keep = bound >= needed_overlap(self.sizes[places], size, percent)
        return self.order[places[keep]], bound[keep]


def _bucket_pairs(bucket: dict[str, np.ndarray], rounds: int, percent: int) -> list[tuple[int, int]]:
    """Pairs of rows of one bucket (or of two blocks of it) to be verified."""
    ids, sizes, places, label, side = (bucket[c] for c in ("class", "n", "place", "label", "side"))
    vectors, sizes = bucket["vector"], sizes.astype(np.int64)
    left = sizes - places
    if len(ids) <= ONE_LEAF:
        bounds = overlap_bounds(vectors[:, None], sizes[:, None], vectors[None])
        near = [(np.flatnonzero(r), b[r]) for r, b in zip(bounds >= needed_overlap(sizes[:, None], sizes[None], percent), bounds)]
    else:
        tree = CountTree(vectors, sizes)
        near = (tree.candidates(vectors[i], int(sizes[i]), percent) for i in range(len(ids)))
    found = {}
    for i, (js, bound) in enumerate(near):
        keep = label[js] != label[i]
        if not keep.any():
            continue
        keep &= np.minimum(left[js], left[i]) >= needed_overlap(sizes[js], int(sizes[i]), percent)
        if rounds == 2:  # sides 0 and 1 are two blocks: only pairs between them; a block by itself has side 2
            keep &= (side[js] != side[i]) | (side[i] == 2)
            keep &= ids[js] > ids[i]
        found[i] = (js[keep], bound[keep] / (sizes[js[keep]] + sizes[i]))
    if rounds == 2:
        return [(i, int(j)) for i, (near, _) in found.items() for j in near]
    pairs = set()
    for i, (near, score) in found.items():
        if len(near):
            for j in {int(near[np.argmax(score)]), int(near[np.argmin(ids[near])])}:
                pairs.add((min(i, j), max(i, j)))
    return sorted(pairs)


def _two_by_two(rows: dict[str, np.ndarray], at: np.ndarray, rounds: int, percent: int) -> list[tuple[int, int]]:
    """The same for all buckets of two rows at once, which are most; they start at ``at``."""
    keep = rows["label"][at] != rows["label"][at + 1]
    if rounds == 2:
        keep &= (rows["side"][at] != rows["side"][at + 1]) | (rows["side"][at] == 2)
    at = at[keep]
    need = needed_overlap(rows["n"][at].astype(np.int64), rows["n"][at + 1], percent)
    keep = np.minimum(rows["n"][at] - rows["place"][at], rows["n"][at + 1] - rows["place"][at + 1]) >= need
    at, need = at[keep], need[keep]
    bound = overlap_bounds(rows["vector"][at], rows["n"][at], rows["vector"][at + 1])
    return [(i, i + 1) for i in at[bound >= need].tolist()]


def _search(rows: DataFrame, rounds: int, percent: int) -> DataFrame:
    """``(a, b)`` with a < b from rows (token, cell, class, n, place, label, side, vector), one tree per (token, cell)."""
    names = ["class", "n", "place", "label", "side"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for last, batch in _with_last(batches):
            table = pa.Table.from_batches([batch]) if batch is not None else None
            rest = table if rest is None else (pa.concat_tables([rest, table]) if table is not None else rest)
            if rest is None or not rest.num_rows:
                continue
            token, cell = rest["token"].to_numpy(), rest["cell"].to_numpy()
            edges = np.concatenate(([0], np.flatnonzero((token[1:] != token[:-1]) | (cell[1:] != cell[:-1])) + 1, [rest.num_rows] if last else []))
            edges = edges.astype(np.int64)
            if len(edges) < 2:  # all rows so far are of one bucket, and more of it may follow
                continue
            whole = rest.slice(0, int(edges[-1]))
            columns = {c: whole[c].to_numpy() for c in names}
            columns["vector"] = np.frombuffer(b"".join(whole["vector"].to_pylist()), dtype=np.uint16).reshape(whole.num_rows, -1)
            length = np.diff(edges)
            pairs = _two_by_two(columns, edges[:-1][length == 2], rounds, percent)
            for start, end in zip(edges[:-1][length > 2].tolist(), edges[1:][length > 2].tolist()):
                part = {c: v[start:end] for c, v in columns.items()}
                pairs += [(start + i, start + j) for i, j in _bucket_pairs(part, rounds, percent)]
            if pairs:
                at = np.array(pairs)
                one, two = columns["class"][at[:, 0]], columns["class"][at[:, 1]]
                both = np.unique(np.stack([np.minimum(one, two), np.maximum(one, two)]), axis=1)  # buckets of one task repeat pairs
                yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])
            rest = rest.slice(int(edges[-1]))

    ordered = rows.repartition("token", "cell").sortWithinPartitions("token", "cell").select("token", "cell", *names, "vector")
    return ordered.mapInArrow(run, "a long, b long")


def _with_last(batches):
    """(False, batch) for each batch, then (True, None)."""
    for batch in batches:
        yield False, batch
    yield True, None


# --- the join ---------------------------------------------------------------------------------


def _described(docs: DataFrame, width: int, groups: int) -> DataFrame:
    """``(doc_id, n, d1, d2, vector, fine)`` of every row, vectors of empty sets null; and tokens that many documents share.

    Each task counts its tokens, ``COMMON_ROWS`` at a time, and names those in more than ``COMMON_SHARE`` of
    the documents it has read meanwhile (and in eight at least), in rows with ``token`` and the count ``n``.
    """
    names = ["doc_id", "n", "d1", "d2", "vector", "fine", "token"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, n_docs = [], 0, 0

        def counted():
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= max(8, COMMON_SHARE * n_docs)
            none = [pa.nulls(int(often.sum()), kind) for kind in (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())]
            return pa.RecordBatch.from_arrays([none[0], pa.array(n[often].astype(np.int64)), *none[1:], pa.array(tokens[often].view(np.int64))], names)

        for batch in batches:
            sets = [shingle_set(t, width) for t in column_values(batch.column("text"))]
            keys = np.array([digest(s) for s in sets], dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1]),
                pa.array([count_vector(s, groups).tobytes() if len(s) else None for s in sets], pa.binary()),
                pa.array([count_vector(s, FINE_GROUPS, np.uint8).tobytes() if len(s) else None for s in sets], pa.binary()), pa.nulls(len(sets), pa.int64())], names)
            for tokens in sets:
                held.append(tokens)
                rows, n_docs = rows + len(tokens), n_docs + 1
                if rows >= COMMON_ROWS:
                    yield counted()
                    held, rows, n_docs = [], 0, 0
        if held:
            yield counted()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, d1 long, d2 long, vector binary, fine binary, token long")


def common_tokens(described: DataFrame, most: int = MAX_COMMON) -> np.ndarray:
    """The ``most`` most frequent of the named tokens (0.8 MB), the most frequent last; they come last in the token order.

    Any order gives right results, so nothing depends on what is missed here.
    """
    named = described.filter("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("n"))
    top = named.orderBy(F.desc("n"), "token").limit(most).toPandas()
    return top["token"].to_numpy(dtype=np.int64).view(np.uint64)[::-1].copy()


def prefix(tokens: np.ndarray, common: np.ndarray, percent: int = PERCENT, by_value: np.ndarray | None = None) -> np.ndarray:
    """The leading tokens in the common order: by hash, then the common ones by frequency.

    ``common`` is the order of those, ``by_value`` what sorts it by value.
    """
    wanted = prefix_length(len(tokens), percent)
    if not len(common):
        return tokens[:wanted]
    by_value = np.argsort(common) if by_value is None else by_value
    place = np.minimum(np.searchsorted(common[by_value], tokens), len(common) - 1)
    is_common = common[by_value][place] == tokens
    rare = tokens[~is_common]
    if len(rare) >= wanted:
        return rare[:wanted]
    return np.concatenate((rare, common[np.sort(by_value[place[is_common]])]))[:wanted]


def _prefix_rows(docs: DataFrame, order: np.ndarray, width: int, percent: int) -> DataFrame:
    """``(token, class, n, place, salt)``, one row for each leading token of each class seen by a task.

    Only common tokens can lead in many sets; their rows are dealt over ``SALTS`` parts by class.
    """
    common = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        by_value = np.argsort(common.value)
        values = common.value[by_value]
        for batch in batches:
            rows = []
            for text in column_values(batch.column("text")):
                tokens = shingle_set(text, width)
                if not len(tokens):
                    continue
                key = digest(tokens)[0]
                if key in seen:
                    continue
                if len(seen) >= 1_000_000:  # copies across the gap only cost a repeated row
                    seen.clear()
                seen.add(key)
                lead = prefix(tokens, common.value, percent, by_value)
                is_common = values[np.minimum(np.searchsorted(values, lead), len(values) - 1)] == lead if len(values) else np.zeros(len(lead), dtype=bool)
                salt = np.where(is_common, 1 + key % SALTS, 0)
                rows.append((lead.view(np.int64), np.full(len(lead), key), np.full(len(lead), len(tokens)), np.arange(len(lead)), salt))
            if rows:
                columns = [np.concatenate([r[i] for r in rows]) for i in range(5)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns[:2]] + [pa.array(c.astype(np.int32)) for c in columns[2:]],
                                                 ["token", "class", "n", "place", "salt"])

    return docs.select("text").mapInArrow(run, "token long, class long, n int, place int, salt int")


def _shared_rows(leading: DataFrame) -> DataFrame:
    """``(token, class, n, place, members)``: each class once for each leading token that another class has, too.

    A token is counted in its parts; the sums of the common ones, at most ``MAX_COMMON`` rows, are sent to all tasks.
    """
    part = Window.partitionBy("token", "salt")
    counted = materialize(leading.repartition("token", "salt").dropDuplicates(["token", "salt", "class"]).withColumn(
        "members", F.count(F.lit(1)).over(part)).filter("members > 1 OR salt > 0"), "jaccard-rows")
    common = materialize(counted.filter("salt > 0").groupBy("token").agg(F.count(F.lit(1)).alias("all_members")), "jaccard-common")
    return counted.join(F.broadcast(common), "token", "left").withColumn("members", F.coalesce("all_members", "members")).filter("members > 1").drop(
        "salt", "all_members")


def _bounded(pairs: DataFrame, vectors: DataFrame, percent: int) -> DataFrame:
    """The pairs that the finer count vectors leave."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) for c in ("a_fine", "b_fine"))
            a, b, n, m = (batch.column(c).to_numpy() for c in ("a", "b", "a_n", "b_n"))
            bound = np.minimum(one, two).sum(axis=1, dtype=np.int64)
            # A vector that overflowed is as large as the other.
            bound = np.where((one[:, 0] == 255) | (two[:, 0] == 255), np.minimum(n, m), bound)
            keep = bound >= needed_overlap(n, m, percent)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])

    for side in "ab":
        pairs = pairs.join(vectors.select(F.col("class").alias(side), F.col("n").alias(f"{side}_n"), F.col("fine").alias(f"{side}_fine")), side)
    return pairs.select("a", "b", "a_n", "b_n", "a_fine", "b_fine").mapInArrow(run, "a long, b long")


def _possible(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """Texts of the documents in ``reps``, and a few others, without a shuffle: one bit for each id's hash.

    The bits are at most ``FILTER_WORDS`` rows at any number of ids; more ids only let more texts through.
    """
    def word(key):
        return F.pmod(key, F.lit(FILTER_WORDS)).cast("int")

    def bit(key):
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(key, 58).cast("int"))

    def key(doc_id):
        return F.xxhash64(F.coalesce(doc_id, F.lit(-(2**63))))

    bits = reps.groupBy(word(key(F.col("rep"))).alias("word")).agg(F.bit_or(bit(key(F.col("rep")))).alias("bits"))
    hashed = docs.select(key(F.col("doc_id").cast("long")).alias("key"), "text")
    return hashed.join(F.broadcast(bits), word(F.col("key")) == F.col("word")).filter(F.col("bits").bitwiseAND(bit(F.col("key"))) != 0).select("text")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Of the stored pairs (a, b) those similar enough, by their sets, which are computed anew for these classes only."""
    wanted = pairs.select(F.col("a").alias("d1")).union(pairs.select("b")).distinct()
    texts = _possible(docs, classes.join(wanted, "d1", "left_semi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, width) for t in column_values(batch.column("text"))]
            chosen = {digest(s)[0]: s for s in sets if len(s)}
            yield pa.RecordBatch.from_arrays([
                pa.array(list(chosen), pa.int64()), pa.array([s.view(np.int64) for s in chosen.values()], pa.list_(pa.int64()))], ["d1", "tokens"])

    sets = texts.mapInArrow(run, "d1 long, tokens array<long>").join(wanted, "d1", "left_semi").dropDuplicates(["d1"])
    sets = materialize(sets, "jaccard-sets")
    both = pairs.join(sets.select(F.col("d1").alias("b"), F.col("tokens").alias("b_set")), "b").join(
        sets.select(F.col("d1").alias("a"), F.col("tokens").alias("a_set")), "a")
    shared = F.size(F.array_intersect("a_set", "b_set"))
    return both.filter(shared * (100 + percent) >= (F.size("a_set") + F.size("b_set")) * percent).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``(id, root)`` of every id in ``links`` (a, b): root is the least id it is connected with.

    Large-star and small-star steps by turns until the links stay the same.  Least neighbours
    are partial aggregates, so a hub is no hot task; each step is stored.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        edges = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        edges = materialize(edges, "large-star")
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        down = edges.join(least, "u")
        edges = down.select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        edges = materialize(edges, "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())


def _blocks(rows: DataFrame, rounds: int, block: int) -> DataFrame:
    """Add ``cell`` and ``side``.  Round 1: one block each; round 2: a cell for every pair of blocks of a token."""
    cut = F.ceil(F.col("members") / block)
    own = F.pmod(F.xxhash64("token", "class"), cut).cast("int")
    if rounds == 1:
        return rows.withColumn("cell", own).withColumn("side", F.lit(2))
    cells = F.transform(F.sequence(F.lit(0), cut.cast("int") - 1), lambda other: F.struct(
        (F.least(other, F.col("own")) * cut + F.greatest(other, F.col("own"))).cast("int").alias("cell"),
        F.when(other == F.col("own"), 2).when(other > F.col("own"), 0).otherwise(1).alias("side")))
    return rows.withColumn("own", own).withColumn("x", F.explode(cells)).select(*rows.columns, "x.cell", "x.side")


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, groups: int = GROUPS, block: int = BLOCK) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``."""
    stored = materialize(_described(docs, width, groups), "jaccard-docs")
    described = stored.filter("token IS NULL").drop("token")
    filled = described.filter("n > 0")
    classes = materialize(filled.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")), "jaccard-classes")
    vectors = filled.groupBy(F.col("d1").alias("class")).agg(F.first("n").alias("n"), F.first("vector").alias("vector"), F.first("fine").alias("fine"))

    rows = _shared_rows(_prefix_rows(docs, common_tokens(stored), width, percent))

    first = _blocks(rows.withColumn("label", F.col("class")), 1, block).join(vectors.select("class", "vector"), "class")
    pairs = materialize(_bounded(_search(first, 1, percent).distinct(), vectors, percent), "jaccard-near")
    links = materialize(_verified(pairs, classes, docs, width, percent), "jaccard-links")
    roots = materialize(components(links), "jaccard-roots")

    labelled = rows.join(roots.withColumnRenamed("id", "class"), "class", "left").withColumn("label", F.coalesce("root", "class")).drop("root")
    # Tokens whose members are not all of one component yet.
    mixed = labelled.groupBy("token").agg(F.min("label").alias("l"), F.max("label").alias("m")).filter("l != m").select("token")
    second = _blocks(labelled.join(mixed, "token", "left_semi"), 2, block).join(vectors.select("class", "vector"), "class")
    rest = _search(second, 2, percent).distinct().join(pairs, ["a", "b"], "left_anti")
    more = materialize(_bounded(rest, vectors, percent), "jaccard-rest")
    all_links = links.union(_verified(more, classes, docs, width, percent))
    roots = components(all_links)

    # Least doc_id of each component, by class first.
    of_class = classes.join(roots.withColumnRenamed("id", "d1"), "d1", "left").withColumn("root", F.coalesce("root", "d1"))
    least = of_class.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = materialize(of_class.join(least, "root").select("d1", "d2", "component_id"), "jaccard-named")
    out = described.select("doc_id", "n", "d1", "d2").join(named, ["d1", "d2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
