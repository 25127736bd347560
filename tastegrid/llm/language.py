"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, every run of other characters is one gap, and the 1- to 3-grams of that
sequence are hashed into ``buckets``.  Learning is one pass that counts (language, bucket) inside
each task and sums the counts in Spark, which stores them.  The log-probability matrix is broadcast;
scoring gathers a text's distinct buckets with their counts and multiplies them with the matrix in numpy.

Every label is learned.  One pass scores ``PASS`` languages (64 MB of matrix, ``BUCKETS`` columns), ``SLICE``
of them at once; where there are more, the best language so far and the sum of all likelihoods
relative to it are stored with the rows and the next pass goes on from there.
Texts are cut into pieces of ``PIECE`` characters for counting, so memory does not grow with them.

Edge cases: a text that is null or has no letter is ``und`` with score 0, as is everything when
nothing was learned; a language is learned only from documents with letters; of equal scores
the first language in text order wins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .batches import column_values, slices

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
PASS = 1024
SLICE = 256
SMOOTHING = 0.5
PIECE = 1 << 18
UNKNOWN = "und"

_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """Lower-case letter of each code point, 0 where it is none; made once per worker."""
    global _letters
    if _letters is None:
        table = np.zeros(0x110000, dtype=np.uint32)
        for point in range(0x110000):
            char = chr(point)
            if char.isalpha():
                low = char.lower()
                table[point] = ord(low) if len(low) == 1 else point
        _letters = table
    return _letters


def letter_codes(text: str) -> np.ndarray:
    """Lower-case letters as code points with one 0 for each gap, one at either end; empty if there is no letter."""
    codes = _letter_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    if not codes.any():
        return codes[:0]
    codes = np.concatenate(([0], codes, [0])).astype(np.uint32)
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0
    keep[0] = True
    return codes[keep]


def bucket_counts(codes: np.ndarray, buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS) -> np.ndarray:
    """How often each bucket is hit by the n-grams of ``codes``."""
    counts = np.zeros(buckets, dtype=np.int64)
    shift = np.uint32(32 - (buckets - 1).bit_length())
    for n in orders:
        for start in range(0, max(len(codes) - n + 1, 0), PIECE):
            piece = codes[start:start + PIECE + n - 1]
            width = len(piece) - n + 1
            hashed = np.full(width, n, dtype=np.uint32)
            for i in range(n):
                hashed = (hashed ^ piece[i:i + width]) * _MULTIPLIERS[i]
                hashed ^= hashed >> np.uint32(15)
            counts += np.bincount((hashed * _MULTIPLIERS[0]) >> shift, minlength=buckets)
    return counts


def count_grams(examples: DataFrame, buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """``(lang, bucket, n)``, stored, from columns text and lang; bucket -1 has the number of documents with letters."""
    labelled = examples.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    most = SLICE

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, docs = {}, {}

        def counted():
            for lang, n in docs.items():
                hit = np.flatnonzero(totals[lang])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(hit) + 1), pa.string()), pa.array(np.append(hit, -1).astype(np.int32)),
                                                  pa.array(np.append(totals[lang][hit], n))], ["lang", "bucket", "n"])
            totals.clear()
            docs.clear()

        for batch in batches:
            for text, lang in zip(column_values(batch.column("text")), column_values(batch.column("lang"))):
                codes = letter_codes(text)
                if not len(codes):
                    continue
                if lang not in docs:
                    if len(docs) == most:
                        yield from counted()
                    totals[lang], docs[lang] = np.zeros(buckets, dtype=np.int64), 0
                totals[lang] += bucket_counts(codes, buckets, orders)
                docs[lang] += 1
        yield from counted()

    summed = labelled.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    return materialize(summed, "language-counts")


def learn(counts: DataFrame, docs: dict[str, int], known: list[str], buckets: int = BUCKETS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The languages ``known``, their log priors among all of ``docs`` and the matrix (bucket, language)."""
    matrix = np.zeros((buckets, len(known)), dtype=np.float32)
    for start in range(0, len(known), SLICE):
        part = known[start:start + SLICE]
        place = {x: i for i, x in enumerate(part)}
        words = counts.filter((F.col("bucket") >= 0) & F.col("lang").isin(part)).toPandas()
        held = np.zeros((buckets, len(part)))
        held[words["bucket"], words["lang"].map(place).astype(int)] = words["n"]
        matrix[:, start:start + len(part)] = np.log((held + SMOOTHING) / (held.sum(axis=0) + SMOOTHING * buckets))
    priors = np.log(np.array([docs[x] for x in known]) / sum(docs.values())) if known else np.zeros(0)
    return known, priors, matrix


def score_text(text: str | None, known: list[str], priors: np.ndarray, matrix: np.ndarray, orders: tuple[int, ...] = ORDERS,
               best: tuple[str | None, float | None, float | None] = (None, None, None), width: int = SLICE) -> tuple[str | None, float | None, float | None]:
    """Most probable language so far, its log-likelihood, and the sum of all likelihoods relative to it; ``best`` is that of earlier languages."""
    codes = letter_codes(text) if text else ()
    if not len(codes) or not known:
        return best
    lang, top, total = best
    counts = bucket_counts(codes, len(matrix), orders)
    hit = np.flatnonzero(counts)
    times = counts[hit].astype(np.float64)
    for start in range(0, len(known), width):
        joint = priors[start:start + width] + times @ matrix[hit, start:start + width].astype(np.float64)
        place = int(np.argmax(joint))
        most, added = float(joint[place]), float(np.exp(joint - joint[place]).sum())
        if top is None or most > top:
            total = added + (total * math.exp(top - most) if top is not None else 0.0)
            lang, top = known[start + place], most
        else:
            total += added * math.exp(most - top)
    return lang, top, total


def identify(docs: DataFrame, examples: DataFrame, keep: list[Column | str], buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` with ``lang_pred`` and ``score``."""
    counts = count_grams(examples, buckets, orders)
    heads = {r["lang"]: r["n"] for r in counts.filter("bucket = -1").select("lang", "n").collect()}
    known = sorted(heads)
    parts = [known[i:i + PASS] for i in range(0, len(known), PASS)] or [[]]
    rows = docs.select(*keep)
    kept = rows.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    if any(isinstance(k, str) and k == "text" for k in keep):  # one copy of the text is enough
        text, own = kept.index("text"), ""
    else:
        rows, text, own = docs.select(*keep, F.col("text").alias("_text")), len(kept), "_text string, "
    for part in parts:
        model = docs.sparkSession.sparkContext.broadcast(learn(counts, heads, part, buckets))
        if part is parts[-1]:
            return rows.mapInArrow(_scorer(model, orders, kept, text, True), f"{fields}, lang_pred string, score double")
        rows = materialize(rows.mapInArrow(_scorer(model, orders, kept, text, False), f"{fields}, {own}_lang string, _top double, _total double"), "language-pass")


def _scorer(model, orders: tuple[int, ...], kept: list[str], text: int, last: bool):
    """``text`` is the place of the text: among the columns ``kept`` or right behind them; the results of an earlier pass come last."""
    n, width = len(kept), SLICE
    own = max(n, text + 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):  # Arrow keeps 64-bit ids exact beside nulls
            texts = batch.column(text).to_pylist()
            before = zip(*[batch.column(own + i).to_pylist() for i in range(3)]) if batch.num_columns > own else [(None, None, None)] * len(texts)
            found = [score_text(t, *model.value, orders, b, width) for t, b in zip(texts, before)]
            if last:
                added = [pa.array([UNKNOWN if f[0] is None else f[0] for f in found], pa.string()), pa.array([1.0 / f[2] if f[2] else 0.0 for f in found], pa.float64())]
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], *added], [*kept, "lang_pred", "score"])
            else:
                added = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:own], *added], [*kept, *["_text"][:own - n], "_lang", "_top", "_total"])

    return score
