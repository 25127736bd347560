"""Alignment of two tokenizers' tokens through sparse incidence matrices.

A text is encoded by a byte-level vocabulary (A) and a piece vocabulary (B).  Each side cuts the same bytes,
so it is a matrix of tokens by bytes with a one where a token covers a byte.  The row products A * B'
(Gustavson: each row of A gathers the rows of B' that its columns name, equal columns are summed) hold
the overlap links and, as values, the bytes that two tokens share.  Offsets where tokens of both sides end cut the
tokens into groups; tokens by groups are two more incidence matrices, whose product holds the shared-group links.
The matrices are compressed sparse rows in numpy.  Documents are worked on in chunks of about ``CHUNK``
bytes as one block-diagonal matrix, products in blocks of ``PRODUCTS`` terms.

``align`` returns tokens, groups and links of each document.  ``link_statistics`` returns one row of figures for each
document with corpus-wide counts of id pairs: every chunk sends each of its distinct pairs once, with
its count; totals come back to the chunk, whose links are stored as places in its list of pairs.  No
pair has more than one row a chunk, so no pair is a hot key, and no text is encoded twice.

Edge cases: a text that is null or empty, or that either tokenizer does not give back byte for byte, has no
tokens, groups or links (its digest is ''); repeated rows count each; a null doc_id is kept; ties for the highest
count all count; strings of special tokens are plain text; an empty table gives no rows; only
``doc_id`` and ``text`` are read, so further columns cannot clash.  A document is encoded whole
in one task, a very long one as a chunk of its own (some hundred bytes of memory for each of its bytes).
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

CHUNK = 1 << 20
ENCODE = 1 << 18
PRODUCTS = 1 << 20
LIST_ROWS = 1 << 16

# How byte-level vocabularies of this family cut a text before they merge, and characters whose kinds (letter, number, space)
# are the same in all Unicode tables.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SETTLED = re.compile(r"[\t\n\r -~¡-ɏ‐-‧]*")
#: Ranks take time by the square of a run.
LONG_RUN = re.compile(r"\S{1000}|\s{1000}")


# --- sparse rows ------------------------------------------------------------------------------


class Rows:
    """A matrix in compressed sparse rows: row i holds ``columns[start[i]:start[i + 1]]`` with their values."""

    def __init__(self, start: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int):
        self.start, self.columns, self.values, self.width = start, columns, values, width

    def __len__(self) -> int:
        return len(self.start) - 1

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.start))

    def transposed(self) -> Rows:
        order = np.argsort(self.columns, kind="stable")
        start = np.concatenate(([0], np.cumsum(np.bincount(self.columns, minlength=self.width))))
        return Rows(start, self.row_of()[order], self.values[order], len(self))


def ones(start: np.ndarray, columns: np.ndarray, width: int) -> Rows:
    return Rows(start, columns, np.ones(len(columns), dtype=np.int32), width)


def tokens_by_bytes(lengths: np.ndarray) -> Rows:
    """Tokens that follow each other, by the bytes they cover."""
    start = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    return ones(start, np.arange(start[-1]), int(start[-1]))


def tokens_by_groups(ends: np.ndarray, cuts: np.ndarray) -> Rows:
    """Each token by the one group it lies in: the first that ends no earlier."""
    return ones(np.arange(len(ends) + 1), np.searchsorted(cuts, ends), len(cuts))


def product_blocks(left: Rows, right: Rows, most: int = PRODUCTS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(row, column, value)`` of left * right by rows, in blocks of about ``most`` terms (a longer row is one block)."""
    terms = np.diff(right.start)[left.columns]
    before = np.concatenate(([0], np.cumsum(terms)))[left.start]  # terms of the rows before each row
    row_of, first = left.row_of(), 0
    while first < len(left):
        last = max(first + 1, int(np.searchsorted(before, before[first] + most, side="right")) - 1)
        part = slice(left.start[first], left.start[last])
        count = terms[part]
        n = int(count.sum())
        skipped = np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(right.start[left.columns[part]], count) + np.arange(n) - skipped
        row, column = np.repeat(row_of[part], count), right.columns[at]
        value = np.repeat(left.values[part], count) * right.values[at]
        if n:
            step = (row[1:] - row[:-1]) * right.width + (column[1:] - column[:-1])
            if (step < 0).any():
                order = np.lexsort((column, row))
                row, column, value = row[order], column[order], value[order]
                step = (row[1:] - row[:-1]) * right.width + (column[1:] - column[:-1])
            new = np.flatnonzero(np.concatenate(([True], step != 0)))
            yield row[new], column[new], np.add.reduceat(value, new)
        first = last


def product(left: Rows, right: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    blocks = list(product_blocks(left, right))
    if not blocks:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*blocks))


# --- vocabularies -----------------------------------------------------------------------------


class TokenBytes:
    """The bytes of every id of a vocabulary, end to end."""

    def __init__(self, entries: list[bytes]):
        self.lengths = np.array([len(e) for e in entries], dtype=np.int64)
        self.start = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(entries), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        lengths = self.lengths[ids]
        inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return self.data[np.repeat(self.start[ids], lengths) + inside]


def byte_alphabet() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones as they are, the others in order from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level_entry(token: str, alphabet: dict[str, int]) -> bytes:
    return bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()


def piece_entry(piece: str) -> bytes:
    as_byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
    return bytes([int(as_byte[1], 16)]) if as_byte else piece.replace("▁", " ").encode()


class Encoders:
    """Both tokenizers with their vocabularies in bytes."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        entries = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in self.a.get_vocab().items():
            entries[i] = byte_level_entry(token, alphabet)
        self.a_bytes = TokenBytes(entries)
        self.b_bytes = TokenBytes([piece_entry(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())])
        self.ranks = self._as_ranks(a_path, entries)
        most = max(len(entries), self.b.get_piece_size())
        powers = 10 ** np.arange(len(str(most)) - 1, -1, -1, dtype=np.int64)
        self.digits = (np.arange(most)[:, None] // powers % 10 + ord("0")).astype(np.uint8)
        self.shown = powers <= np.maximum(np.arange(most), 1)[:, None]

    @staticmethod
    def _as_ranks(a_path: str, entries: list[bytes]):
        """The vocabulary as byte ranks, if each merge makes the next higher id and all single bytes come first."""
        import tiktoken

        with open(a_path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        made = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
        bytes_first = all(len(entries[i]) == 1 for i in range(256)) and len(set(entries[:256])) == 256
        if not bytes_first or made != list(range(256, 256 + len(made))):
            return None
        return tiktoken.Encoding("byte-level", pat_str=CUT, mergeable_ranks={entries[i]: i for i in range(256 + len(made))}, special_tokens={})

    def _encode_a(self, texts: list[str]) -> list[np.ndarray]:
        """Ids on side A.  The same merges run three times as fast as byte ranks, where those say the same: texts of settled characters without long runs."""
        out: list = [None] * len(texts)
        for i, text in enumerate(texts):
            if self.ranks and SETTLED.fullmatch(text) and not LONG_RUN.search(text):
                out[i] = np.array(self.ranks.encode_ordinary(" " + text), dtype=np.int32)
        whole = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(whole, self.a.encode_batch_fast([" " + texts[i] for i in whole], add_special_tokens=False)):
            out[i] = np.array(e.ids, dtype=np.int32)
        return out

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text on both sides; encoded a few at a time, so that few ids are Python objects."""
        a, b, held, size = [], [], [], 0
        for i, text in enumerate(texts):
            held.append(text)
            size += len(text)
            if size >= ENCODE or i + 1 == len(texts):
                a += self._encode_a(held)
                b += [np.array(ids, dtype=np.int32) for ids in self.b.encode(held, num_threads=1)]
                held, size = [], 0
        return a, b


@functools.lru_cache(maxsize=2)
def encoders(a_path: str, b_path: str) -> Encoders:
    return Encoders(a_path, b_path)


# --- a chunk of documents ---------------------------------------------------------------------


class Chunk:
    """Tokens of some documents as one block-diagonal matrix; documents without tokens have empty blocks."""

    def __init__(self, texts: list[str | None], tools: Encoders):
        self.tools, self.n = tools, len(texts)
        given = np.array([i for i, t in enumerate(texts) if t], dtype=np.int64)
        a, b = tools.encode([texts[i] for i in given])
        data = [b" " + texts[i].encode("utf-8", "surrogatepass") for i in given]
        whole = [self._gives_back(tools.a_bytes, a, data), self._gives_back(tools.b_bytes, b, data)]
        keep = np.flatnonzero(whole[0] & whole[1])
        none = np.zeros(0, dtype=np.int32)
        self.a, self.b = (np.concatenate([none, *[side[i] for i in keep]]) for side in (a, b))
        self.a_first, self.b_first = (self._first(given[keep], [len(side[i]) for i in keep]) for side in (a, b))
        self.a_ends = np.cumsum(tools.a_bytes.lengths[self.a])
        self.b_ends = np.cumsum(tools.b_bytes.lengths[self.b])
        self.cuts = np.intersect1d(self.a_ends, self.b_ends, assume_unique=True)
        bytes_of = self._first(given[keep], [len(data[i]) for i in keep])
        self.group_first = np.searchsorted(self.cuts, bytes_of, side="right")

    def _first(self, at: np.ndarray, counts: list[int]) -> np.ndarray:
        """Where each document's part starts, and the end of the last."""
        per_document = np.zeros(self.n, dtype=np.int64)
        per_document[at] = counts
        return np.concatenate(([0], np.cumsum(per_document)))

    @staticmethod
    def _gives_back(vocabulary: TokenBytes, ids: list[np.ndarray], data: list[bytes]) -> np.ndarray:
        out = np.zeros(len(data), dtype=bool)
        for i, (own, text) in enumerate(zip(ids, data)):
            joined = vocabulary.joined(own)
            out[i] = len(joined) == len(text) and joined.tobytes() == text and bool((vocabulary.lengths[own] > 0).all())
        return out

    def overlap_links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(a, b, bytes)``: places of the tokens that overlap, and by how much."""
        a = tokens_by_bytes(self.tools.a_bytes.lengths[self.a])
        return product(a, tokens_by_bytes(self.tools.b_bytes.lengths[self.b]).transposed())

    def group_links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(a, b, 1)`` of all tokens that share a group."""
        return product(tokens_by_groups(self.a_ends, self.cuts), tokens_by_groups(self.b_ends, self.cuts).transposed())

    def group_texts(self) -> list[bytes]:
        """Per document ``a1,a2|b1;a3|b2,b3``: the ids of each group in decimal."""
        # A token comes after all of earlier groups and those of its own side before it; B tokens also after A tokens of their group.
        a_to, b_to = (np.searchsorted(ends, self.cuts, side="right") for ends in (self.a_ends, self.b_ends))
        b_counts = np.diff(b_to, prepend=0)
        n, last = len(self.a) + len(self.b), a_to + b_to - 1  # last: each group's last place
        side = np.zeros(n, dtype=bool)
        b_place = np.arange(len(self.b)) + np.repeat(a_to, b_counts)
        side[b_place] = True
        ids = np.empty(n, dtype=np.int32)
        ids[b_place], ids[~side] = self.b, self.a
        after = np.full(n, ord(","), dtype=np.uint8)
        after[last - b_counts] = ord("|")
        after[last] = ord(";")
        letters = np.empty((n, self.tools.digits.shape[1] + 1), dtype=np.uint8)
        letters[:, :-1], letters[:, -1] = self.tools.digits[ids], after
        shown = np.ones(letters.shape, dtype=bool)
        shown[:, :-1] = self.tools.shown[ids]
        ends = np.concatenate(([0], np.cumsum(shown.sum(axis=1))))[self.a_first + self.b_first]
        flat = letters[shown].tobytes()
        return [flat[s:max(s, e - 1)] for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list]]:
    """``(ids, texts)`` of about ``size`` bytes of text; a longer text is the last of its chunk."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids.append(doc_id)
            texts.append(text)
            held += 64 + len(text or "")
            if held >= size:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def align(docs: DataFrame, a_path: str, b_path: str, links: str = "overlap", chunk: int = CHUNK) -> DataFrame:
    """``(doc_id, a_ids, b_ids, groups, links)`` of every row.

    ``groups`` are ``(a_from, a_to, b_from, b_to)``, ``links`` are ``(a, b, bytes)``: places of tokens in their lists, and the bytes they share
    (``links="overlap"``) or 1 for each pair of tokens of one group (``links="group"``; as many as a group's sides multiplied).
    """
    schema = ("doc_id long, a_ids array<int>, b_ids array<int>, groups array<struct<a_from: int, a_to: int, b_from: int, b_to: int>>, "
              "links array<struct<a: int, b: int, bytes: int>>")

    def lists(values, first, kind):
        return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, kind) if isinstance(values, np.ndarray) else values)

    def structs(**columns):
        return pa.StructArray.from_arrays([pa.array(c.astype(np.int32)) for c in columns.values()], list(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = encoders(a_path, b_path)
        for ids, texts in _chunks(batches, chunk):
            c = Chunk(texts, tools)
            a, b, shared = c.overlap_links() if links == "overlap" else c.group_links()
            link_first = np.searchsorted(a, c.a_first)
            a_to, b_to = np.searchsorted(c.a_ends, c.cuts) + 1, np.searchsorted(c.b_ends, c.cuts) + 1
            a_base, b_base = (np.repeat(first[:-1], np.diff(c.group_first)) for first in (c.a_first, c.b_first))
            groups = structs(a_from=np.concatenate(([0], a_to[:-1]))[:len(a_to)] - a_base, a_to=a_to - a_base,
                             b_from=np.concatenate(([0], b_to[:-1]))[:len(b_to)] - b_base, b_to=b_to - b_base)
            a_base, b_base = (np.repeat(first[:-1], np.diff(link_first)) for first in (c.a_first, c.b_first))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), lists(c.a, c.a_first, pa.int32()), lists(c.b, c.b_first, pa.int32()), lists(groups, c.group_first, None),
                 lists(structs(a=a - a_base, b=b - b_base, bytes=shared), link_first, None)], ["doc_id", "a_ids", "b_ids", "groups", "links"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


FIGURES = ["n_a", "n_b", "n_groups", "n_links"]


def _chunk_rows(docs: DataFrame, a_path: str, b_path: str, chunk: int) -> DataFrame:
    """Rows of documents (figures, digest, links as places in the chunk's list of pairs) and rows of those lists (``pairs``, ``counts``)."""
    schema = pa.schema([("chunk", pa.int64()), ("doc_id", pa.int64()), *[(c, pa.int64()) for c in FIGURES], ("groups_sha256", pa.string()),
                        ("links", pa.binary()), ("first", pa.int64()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])

    def batch(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = encoders(a_path, b_path)
        width = len(tools.b_bytes.lengths)
        number = TaskContext.get().partitionId() << 33
        for ids, texts in _chunks(batches, chunk):
            c = Chunk(texts, tools)
            a, b, _ = c.overlap_links()
            link_first = np.searchsorted(a, c.a_first)
            pairs, place, counts = np.unique(c.a[a].astype(np.int64) * width + c.b[b], return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")  # frequent pairs first: small numbers, which compress
            rank = np.empty(len(order), dtype=np.uint16 if len(order) <= 1 << 16 else np.uint32)
            rank[order] = np.arange(len(order))
            links, step = rank[place].tobytes(), rank.dtype.itemsize
            digests = [hashlib.sha256(t).hexdigest() if t else "" for t in c.group_texts()]
            figures = {name: pa.array(np.diff(first)) for name, first in zip(FIGURES, (c.a_first, c.b_first, c.group_first, link_first))}
            bounds = (link_first * step).tolist()
            yield batch(len(ids), chunk=pa.array(np.full(len(ids), number)), doc_id=pa.array(ids, pa.int64()), groups_sha256=pa.array(digests, pa.string()),
                        links=pa.array([links[s:e] for s, e in zip(bounds[:-1], bounds[1:])], pa.binary()), **figures)
            for first in range(0, len(order), LIST_ROWS):
                part = order[first:first + LIST_ROWS]
                yield batch(1, chunk=pa.array([number], pa.int64()), first=pa.array([first], pa.int64()),
                            pairs=pa.array([pairs[part]], pa.list_(pa.int64())), counts=pa.array([counts[part]], pa.list_(pa.int64())))
            number += 1

    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    ddl = ", ".join(f"{f.name} {kinds.get(f.type, 'array<long>')}" for f in schema)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ddl)


def link_statistics(docs: DataFrame, a_path: str, b_path: str, chunk: int = CHUNK) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every row."""
    stored = materialize(_chunk_rows(docs, a_path, b_path, chunk), "align-chunks")
    width = encoders(a_path, b_path).b.get_piece_size()

    listed = stored.filter("pairs IS NOT NULL").select(F.col("chunk").alias("of_chunk"), "first", F.posexplode(F.arrays_zip("pairs", "counts")).alias("i", "p"))
    entries = listed.select("of_chunk", (F.col("first") + F.col("i")).alias("place"), F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    totals = materialize(entries.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", (F.col("pair") % width).cast("int")), "align-pairs")
    # One row for each id of the vocabulary at most.
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    priced = totals.join(F.broadcast(highest), "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))

    described = stored.filter("pairs IS NULL").select("chunk", "doc_id", *FIGURES, "groups_sha256", "links")
    linked, bare = described.filter("n_links > 0"), described.filter("n_links = 0")
    names = ["doc_id", *FIGURES, "n_best", "count_sum", "groups_sha256"]

    def add_up(rows: pa.Table, prices: pa.Table) -> pa.Table:
        total, best = np.zeros(prices.num_rows, dtype=np.int64), np.zeros(prices.num_rows, dtype=np.int64)
        place = prices["place"].to_numpy()
        total[place], best[place] = prices["total"].to_numpy(), prices["best"].to_numpy().astype(np.int64)
        kind = np.uint16 if prices.num_rows <= 1 << 16 else np.uint32
        sums = [(int(best[at].sum()), int(total[at].sum())) for at in (np.frombuffer(x, dtype=kind) for x in rows["links"].to_pylist())]
        return pa.table({"doc_id": rows["doc_id"], **{c: rows[c] for c in FIGURES}, "n_best": pa.array([s[0] for s in sums], pa.int64()),
                         "count_sum": pa.array([s[1] for s in sums], pa.int64()), "groups_sha256": rows["groups_sha256"]})

    prices = entries.join(priced, "pair").select("of_chunk", "place", "total", "best")
    summed = linked.groupBy("chunk").cogroup(prices.groupBy("of_chunk")).applyInArrow(
        add_up, ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in names))
    none = F.lit(0).cast("long")
    return summed.unionByName(bare.select("doc_id", *FIGURES, none.alias("n_best"), none.alias("count_sum"), "groups_sha256"))
