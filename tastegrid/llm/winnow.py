"""Document fingerprints by winnowing.

The rolling hashes of all k-grams of code points are taken; of every ``window`` neighbouring ones the
least is chosen, the rightmost of equal ones, and kept with its position.  Two texts that share
``window + k - 1`` characters in a row share a chosen hash; matches shorter than k are never seen.

Hashes are polynomials over the code points modulo 2^64, mixed and cut to 32 bits.

Edge cases: a text shorter than k is one gram; an empty or null text has no fingerprint (empty
arrays and text); two empty fingerprints are alike (1), an empty and another are not (0).  Equal texts
have equal fingerprints.  Memory is a fixed multiple of the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 25
WINDOW = 40
BUCKETS_PER_PARTITION = 4
_RESULT = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram_hashes(text: str, k: int = K) -> np.ndarray:
    """32-bit hashes of the k-grams in order; of the whole text if it is shorter."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    if not len(codes):
        return codes
    k = min(k, len(codes))
    # A gram's polynomial by doubling: that of 2n points is that of the first n times base^n plus that of the next n.
    width, have, done = 1, codes, None
    powers, taken = {1: _BASE}, 0
    rest = k
    while rest:
        if rest & 1:
            n = len(codes) - taken - width + 1
            piece = have[taken:taken + n]
            done = piece if done is None else done[:n] * np.uint64(powers[width]) + piece
            taken += width
        rest >>= 1
        if rest:
            have = have[:len(have) - width] * np.uint64(powers[width]) + have[width:]
            powers[2 * width] = powers[width] * powers[width] & _MASK
            width *= 2
    return _mix(done) >> np.uint64(32)


def winnow(text: str | None, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes and their positions, in order of position."""
    hashes = gram_hashes(text or "", k)
    if not len(hashes):
        return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
    n = len(hashes)
    low = np.uint64(0xFFFFFFFF)
    least = (hashes << np.uint64(32)) | (low - np.arange(n, dtype=np.uint64))  # a later position makes a lesser value
    window, width = min(window, n), 1
    while width * 2 <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        least = np.minimum(least[:width - window], least[window - width:])
    chosen = least[np.concatenate(([True], least[1:] != least[:-1]))]
    return (chosen >> np.uint64(32)).astype(np.uint32), (low - (chosen & low)).astype(np.int64)


def as_text(hashes: np.ndarray, positions: np.ndarray) -> str:
    """``hash@position`` joined by blanks, the hash in 8 hexadecimal digits."""
    return " ".join([f"{h:08x}@{p}" for h, p in zip(hashes.tolist(), positions.tolist())])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of chosen hashes, each without repeats."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """``(doc_id, hashes array<long>, positions array<long>)`` of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [winnow(t, k, window) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "hashes": [f[0].astype(np.int64) for f in found], "positions": [f[1] for f in found]})

    found = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(run, "doc_id string, hashes array<long>, positions array<long>")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the front of ``following``."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def _with_guests(docs: DataFrame) -> DataFrame:
    """``(bucket, guest, place, doc_id, text)``: in each bucket, sorted by (guest, descending place, descending text),
    the row after a document is the one that follows it in the whole table; after the last comes the first.

    Buckets are ranges of ids, four for each shuffle partition.  The first row of a bucket is sent
    once more, as a guest, to the bucket before it: one further row per bucket.  What the driver
    holds is one number per bucket; texts move once.
    """
    spark = docs.sparkSession
    place = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    rows = docs.select(place.alias("place"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.filter(F.col("doc_id").isNotNull()).approxQuantile("place", [i / buckets for i in range(1, buckets)], 1 / (8 * buckets))
    edges = [float("-inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    bucketed = Bucketizer(splits=edges, inputCol="place", outputCol="bucket").transform(rows)
    bucketed = bucketed.withColumn("bucket", F.col("bucket").cast("int"))
    firsts = sorted((r["bucket"], r["place"]) for r in bucketed.groupBy("bucket").agg(F.max("place").alias("place")).collect())
    used = [b for b, _ in firsts]
    hosts = spark.createDataFrame([(b, p, h) for (b, p), h in zip(firsts, used[1:] + used[:1])], "bucket int, place double, host int")
    guests = (
        bucketed.join(F.broadcast(hosts), ["bucket", "place"])
        .groupBy("host", "place", "doc_id").agg(F.max("text").alias("text"))
        .select(F.col("host").alias("bucket"), F.lit(True).alias("guest"), "place", "doc_id", "text")
    )
    return bucketed.select("bucket", F.lit(False).alias("guest"), "place", "doc_id", "text").unionByName(guests)


def compare_with_following(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the document that follows it.

    Documents follow each other by descending doc_id (null ids last, equal ids by descending
    text), the first after the last; a lone document follows itself.  ``(doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = None
        for batch in batches:
            out = []
            for bucket, guest, doc_id, text in zip(batch["bucket"], batch["guest"], batch["doc_id"], batch["text"]):
                mark = winnow(text, k, window)
                if before is not None and before[0] == bucket:
                    _, their_id, their_text, their_mark = before
                    other = edited(their_text, text)
                    other_mark = winnow(other, k, window)
                    out.append((their_id, len(their_text), hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(), as_text(*their_mark), as_text(*other_mark),
                                likeness(np.unique(their_mark[0]), np.unique(other_mark[0])), likeness(np.unique(their_mark[0]), np.unique(mark[0]))))
                before = None if guest else (bucket, doc_id, text, mark)
            yield pd.DataFrame(out, columns=list(_RESULT))

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = _with_guests(docs).repartition(n, "bucket").sortWithinPartitions("bucket", "guest", F.desc("place"), F.desc("doc_id"), F.desc("text"))
    # Ids travel as text: pandas has no exact 64-bit numbers beside nulls.
    compared = ordered.select("bucket", "guest", F.col("doc_id").cast("string"), "text").mapInPandas(
        run, "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return compared.withColumn("doc_id", F.col("doc_id").cast("long"))
