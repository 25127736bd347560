"""Packing token sequences by best fit and a swap-based local search.

A document is its token ids and one closing id.  Longer ones are cut into pieces of ``capacity``,
the first piece taking what is left over; only first pieces have to be packed.  They are dealt at
random into groups of ``group_rows``; each group is packed by best fit, longest first, and improved:
between two underfull sequences one piece moves, or one is exchanged for one, or two for one, when
that makes the fuller of the two fuller, until nothing more can be done.  Each step increases the
sum of squared fills, so the search ends; sequences that run empty go.

Groups are bounded, so one task never holds more than one; per group at most about one sequence is
left underfull.  What moves is (doc_id, piece, length, checksum), never texts or ids.

Ids come from the byte-level vocabulary by its ranks; that gives the ids of the same vocabulary's
merge list (tested) in a fifth of the time.

Edge cases: a null text is an empty one and packed as its closing id alone; repeated rows are
packed each; the string of a special token in a text is that token, as the merge list's library
reads it; an empty table gives no rows.  Memory per task: one batch of texts and one group.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import running_total, store_slices
from ..session import materialize
from .batches import column_values

CAPACITY = 2048
CLOSING_ID = 0
GROUP_ROWS = 16_384
_encodings: dict[str, object] = {}


def encoding(ranks_path: str, special: tuple[tuple[str, int], ...]):
    """The vocabulary of a ranks file, loaded once per worker."""
    if ranks_path not in _encodings:
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encodings[ranks_path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=dict(special))
    return _encodings[ranks_path]


def cut_points(n: int, capacity: int = CAPACITY) -> list[int]:
    """Starts of the pieces of ``n`` ids; all but the first piece are full."""
    first = n % capacity
    return [0, *range(first or capacity, n, capacity)] if n else []


def tokenize_pieces(docs: DataFrame, ranks_path: str, special: tuple[tuple[str, int], ...] = (("<|endoftext|>", 50256),), capacity: int = CAPACITY,
                    keep_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` and, if asked for, ``ids`` of every piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(ranks_path, special).encode_to_numpy
        for batch in batches:
            out = []
            for doc_id, text in zip(column_values(batch.column("doc_id")), column_values(batch.column("text"))):
                ids = np.append(encode(text or "", allowed_special="all"), CLOSING_ID).astype("<u4")
                starts = cut_points(len(ids), capacity)
                for i, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    out.append((doc_id, i, start, end - start, zlib.crc32(ids[start:end].tobytes()), *([ids[start:end].astype(np.int32)] if keep_ids else [])))
            columns = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), *([("ids", pa.list_(pa.int32()))] if keep_ids else [])]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, (_, kind) in enumerate(columns)], [name for name, _ in columns])

    ids = ", ids array<int>" if keep_ids else ""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, piece int, start long, length long, ids_crc32 long{ids}")


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Longest first, each into the fullest sequence that still has room."""
    by_room: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some sequence has room r
    bins = []
    for i in sorted(range(len(lengths)), key=lambda j: -lengths[j]):
        n = lengths[i]
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            target = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, target = capacity, []
            bins.append(target)
        target.append(i)
        if room > n:
            by_room[room - n].append(target)
            rooms |= 1 << (room - n)
    return bins


def _improve(poor: list[int], rich: list[int], room: int, lengths: list[int]) -> tuple[list[int], list[int]] | None:
    """Items to send from ``poor`` to ``rich`` and back so that ``rich`` grows by the most, at most ``room``."""
    best, found = 0, None
    for i in poor:
        if best < lengths[i] <= room:
            best, found = lengths[i], ([i], [])
    theirs = sorted(rich, key=lambda j: lengths[j])
    sizes = [lengths[j] for j in theirs]
    # Two items of a length do for all pairs; lengths that differ are few, as together they fit in a sequence.
    kept: dict[int, list[int]] = {}
    for i in poor:
        same = kept.setdefault(lengths[i], [])
        if len(same) < 2:
            same.append(i)
    own = [i for same in kept.values() for i in same]
    offers = [([i], lengths[i]) for i in own] + [([i, j], lengths[i] + lengths[j]) for a, i in enumerate(own) for j in own[:a]]
    for items, n in offers:
        # The least of theirs with n - its length <= room gives the largest gain.
        lo, hi = 0, len(sizes)
        while lo < hi:
            mid = (lo + hi) // 2
            if sizes[mid] < n - room:
                lo = mid + 1
            else:
                hi = mid
        if lo < len(sizes) and n - sizes[lo] > best:
            best, found = n - sizes[lo], (items, [theirs[lo]])
        if best == room:
            break
    return found


def local_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Empty the least full sequences into the other underfull ones.

    All its items and pairs of items are tried in exchanges with one other sequence at a time, and
    all sequences.
    """
    fill = [sum(lengths[i] for i in b) for b in bins]
    full = [b for b, f in zip(bins, fill) if f == capacity]
    open_ = sorted(([f, b] for b, f in zip(bins, fill) if f < capacity), key=lambda x: x[0])
    while len(open_) > 1 and sum(capacity - f for f, _ in open_[1:]) >= open_[0][0]:
        poor = open_[0]
        changed = False
        for rich in reversed(open_[1:]):
            while poor[1] and rich[0] < capacity:
                found = _improve(sorted(poor[1], key=lambda i: -lengths[i]), rich[1], capacity - rich[0], lengths)
                if not found:
                    break
                go, come = found
                gain = sum(lengths[i] for i in go) - sum(lengths[i] for i in come)
                if gain <= 0 or rich[0] + gain <= poor[0]:  # the squares must grow
                    break
                poor[1] = [i for i in poor[1] if i not in go] + come
                rich[1] = [i for i in rich[1] if i not in come] + go
                poor[0] -= gain
                rich[0] += gain
                changed = True
            if not poor[1]:
                break
        full += [b for f, b in open_ if f == capacity]
        open_ = sorted((x for x in open_ if x[1] and x[0] < capacity), key=lambda x: x[0])
        if not changed:
            break
    return full + [b for _, b in open_]


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces with columns doc_id, piece, length."""
    columns = pieces.columns
    fields = ", ".join(f"`{f.name}` {'string' if f.name == 'doc_id' else f.dataType.simpleString()}" for f in pieces.schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def placed(group: pd.DataFrame) -> pd.DataFrame:
            lengths = group["length"].tolist()
            bins = local_search(best_fit(lengths, capacity), lengths, capacity)
            number, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
            for b, items in enumerate(bins):
                at = 0
                for i in items:
                    number[i], offset[i] = b, at
                    at += lengths[i]
            return group.assign(sequence_id=group["base"].iloc[0] * group_rows + number, offset=offset)[[*columns, "sequence_id", "offset"]]

        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            heads = rest["base"].to_numpy()
            edges = [0, *(np.flatnonzero(heads[1:] != heads[:-1]) + 1).tolist()]
            for start, end in zip(edges, edges[1:]):
                yield placed(rest.iloc[start:end].reset_index(drop=True))
            rest = rest.iloc[edges[-1]:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield placed(rest)

    open_ = pieces.filter(F.col("length") < capacity)
    n = open_.count()
    groups = -(-n // group_rows) or 1
    # Dealt round robin after a sort by hash: equal groups whatever the keys, however often they repeat.
    numbered = open_.withColumn("_hash", F.xxhash64(*[F.col(c) for c in columns if c != "ids"])).withColumn("_row", F.monotonically_increasing_id())
    order = [F.col("_hash"), F.col("_row")]
    sliced = running_total(store_slices(numbered, [], order, "pack-order"), [], order, F.lit(1), "place")
    dealt = sliced.withColumn("base", F.col("place") % groups).drop("place", "slice", "_hash", "_row")
    small = dealt.withColumn("doc_id", F.col("doc_id").cast("string")).repartition("base").sortWithinPartitions("base", "length", *[c for c in columns if c not in ("ids", "length")]).mapInPandas(
        run, f"{fields}, sequence_id long, offset long").withColumn("doc_id", F.col("doc_id").cast(pieces.schema["doc_id"].dataType))
    # A full piece is a sequence; numbers below 0 are theirs.
    whole = pieces.filter(F.col("length") == capacity)
    named = whole.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return small.unionByName(named)


def pack_documents(docs: DataFrame, ranks_path: str, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, one row per piece."""
    return pack(materialize(tokenize_pieces(docs, ranks_path, capacity=capacity), "pieces"), capacity, group_rows)
