"""Toxic spans by a linear-chain conditional random field.

Tokens are words; each is outside (0) or inside (1) a toxic span.  The field scores a token by hashed features of
its word (whole, first 2 to 8 letters, last 3) and of the words beside it, and pairs of neighbouring states
by four weights.  Forward and backward sums give each token's marginal; a document's marginals add up to its score, and tokens
above ``SPAN`` are its offending offsets.

Labels name documents, not tokens, so tokens are labelled first.  Over all labelled training documents (equal texts count
once) each word feature is counted in toxic and in clean documents.  A feature is bad if its log-likelihood ratio beats the number of
features that were tried and at least ``PURE`` of its documents are toxic; a token of a toxic document is inside if one of its
features is bad, all other tokens are outside.

The field is fitted on ``SAMPLE`` documents of each label at most (by the hash of the id; counts above cover all), by stochastic gradients on whole
documents; a third of them is kept back for the two weights that turn a document's sum into a probability.  The model is
``2 ** BITS`` numbers (1 MB) at any size of the corpus; counts have ``2 ** COUNT_BITS`` buckets, of which the driver gets the bad ones.

Edge cases: a null or wordless text has no tokens and the score of a sum of zero; without toxic or without clean training documents
every score is the share of toxic ones (0 without any); labels of an id that differ count as toxic; null labels count as none; repeated rows are scored
each; very long texts are scored whole; an empty table gives no rows; further columns are kept only where asked for by ``keep``, under their own names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

BITS = 18
COUNT_BITS = 22
SAMPLE = 1500
EPOCHS = 8
RATE = 0.3
PENALTY = 1e-4
PURE = 0.9
SPAN = 0.5
WORD = re.compile(r"[^\W_]+")
MOST_WORDS = 1 << 18


def word_features(word: str) -> list[str]:
    """What the word itself tells: its lower-cased form, its beginnings, its end."""
    low = word.lower()
    return ["w" + low, "e" + low[-3:], *[f"{n}{low[:n]}" for n in range(2, min(9, len(low)))]]


def _hash(name: str, bits: int) -> int:
    return xxhash.xxh3_64_intdigest(name) & ((1 << bits) - 1)


class Memo(dict):
    """Values by word, computed once; emptied when ``MOST_WORDS`` are held."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, word):
        if len(self) >= MOST_WORDS:
            self.clear()
        value = self[word] = self.compute(word)
        return value


def counted_buckets(word: str) -> np.ndarray:
    mask, of_name = (1 << COUNT_BITS) - 1, xxhash.xxh3_64_intdigest
    return np.array([of_name(f) & mask for f in word_features(word)], dtype=np.int64)


# --- the chain --------------------------------------------------------------------------------


def weight_of(score: float) -> float:
    return math.exp(min(max(score, -40.0), 40.0))


def chain_sums(own: list[float], pairs: list[float]) -> tuple[list[float], list[float]]:
    """Forward and backward ratios: a sum over state 1 divided by that over state 0 is all that a chain of two states has to hand on.

    ``own`` are the tokens' weights of state 1 against 0, ``pairs`` the weights of 00, 01, 10, 11 (no logs).
    """
    p00, p01, p10, p11 = pairs
    if not own:
        return [], []
    ratio = own[0]
    forward, backward = [ratio], [1.0]
    for w in own[1:]:
        ratio = w * (p01 + p11 * ratio) / (p00 + p10 * ratio)
        forward.append(ratio)
    ratio = 1.0
    for w in own[:0:-1]:
        w *= ratio
        ratio = (p10 + p11 * w) / (p00 + p01 * w)
        backward.append(ratio)
    backward.reverse()
    return forward, backward


def chain_marginals(scores: list[float], pairs: list[float]) -> tuple[list[float], list[float], list[float]]:
    """Forward ratios, backward ratios and marginals of state 1 from logs of the tokens' weights."""
    forward, backward = chain_sums([weight_of(s) for s in scores], pairs)
    return forward, backward, [f * b / (1.0 + f * b) for f, b in zip(forward, backward)]


def evidence(marginals: list[float]) -> float:
    """Minus the logarithm of the chance that no token is toxic, were the tokens independent."""
    return -sum(math.log1p(-min(m, 0.99)) for m in marginals if m > 1e-9)


@dataclass
class Model:
    """Weights of a fitted field and of the document score; ``share`` is the score of all if nothing could be learned."""

    share: float = 0.0
    weights: np.ndarray | None = None
    pairs: list[float] = field(default_factory=lambda: [1.0] * 4)
    slope: float = 1.0
    offset: float = 0.0

    def tagger(self):
        """A function from a text to its tokens' marginals."""
        weights, mask, of_name = self.weights.tolist(), (1 << BITS) - 1, xxhash.xxh3_64_intdigest
        bias = weights[_hash("bias", BITS)]

        def of_word(word):
            score = bias
            for name in word_features(word):
                score += weights[of_name(name) & mask]
            low = word.lower()
            return weight_of(score), weight_of(weights[of_name("<" + low) & mask]), weight_of(weights[of_name(">" + low) & mask])

        memo = Memo(of_word)

        def tag(text: str) -> list[float]:
            words = [memo[w] for w in WORD.findall(text)]
            if not words:
                return []
            own, before, after = zip(*words)
            forward, backward = chain_sums([o * b * a for o, b, a in zip(own, (1.0, *before), (*after[1:], 1.0))], self.pairs)
            return [r / (1.0 + r) for r in [f * b for f, b in zip(forward, backward)]]

        return tag

    def kept_tagger(self):
        """The same function for all tasks of a worker, so words met before stay known."""
        if not hasattr(self, "_kept"):
            self._kept = self.tagger()
        return self._kept

    def document_score(self, marginals: list[float]) -> float:
        return 1.0 / (1.0 + math.exp(-min(max(self.slope * math.log(evidence(marginals) + 1e-3) + self.offset, -40.0), 40.0)))


# --- fitting ----------------------------------------------------------------------------------


def sequence_features(words: list[str], memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of all tokens, and each one's token."""
    bias = _hash("bias", BITS)
    own = [memo[w] for w in words]
    buckets, tokens = [], []
    for i, (features, _, _) in enumerate(own):
        row = [*features, bias]
        if i:
            row.append(own[i - 1][1])
        if i + 1 < len(own):
            row.append(own[i + 1][2])
        buckets += row
        tokens += [i] * len(row)
    return np.array(buckets, dtype=np.int64), np.array(tokens, dtype=np.int64)


def gradient(states: np.ndarray, scores: np.ndarray, log_pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the log-likelihood of ``states``: by token score and by the four pair weights (observed less expected)."""
    p = np.exp(log_pairs)
    forward, backward, marginal = (np.array(x) for x in chain_marginals(scores.tolist(), p.tolist()))
    by_pair = np.bincount(2 * states[:-1] + states[1:], minlength=4).astype(float)
    if len(states) > 1:
        own = np.exp(np.clip(scores[1:], -40.0, 40.0)) * backward[1:]
        weight = np.stack([np.full(len(own), p[0]), p[1] * own, p[2] * forward[:-1], p[3] * forward[:-1] * own])
        by_pair -= (weight / weight.sum(axis=0)).sum(axis=1)
    return states - marginal, by_pair


def fit_chain(documents: list[tuple[list[str], np.ndarray]], epochs: int = EPOCHS, rate: float = RATE, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Weights and logs of pair weights from (words, states), by AdaGrad steps of one document each."""
    memo = Memo(lambda w: ([_hash(f, BITS) for f in word_features(w)], _hash("<" + w.lower(), BITS), _hash(">" + w.lower(), BITS)))
    weights, pairs = np.zeros(1 << BITS), np.zeros(4)
    weights[_hash("bias", BITS)] = -2.0
    sums, pair_sums = np.full(1 << BITS, 1e-2), np.full(4, 1e-2)
    rng = np.random.default_rng(13)
    known = [(*sequence_features(words, memo), states) for words, states in documents if words]
    for _ in range(epochs):
        for i in rng.permutation(len(known)):
            buckets, tokens, states = known[i]
            scores = np.bincount(tokens, weights[buckets], minlength=len(states))
            by_token, by_pair = gradient(states, scores, pairs)
            touched, place = np.unique(buckets, return_inverse=True)
            step = np.bincount(place, by_token[tokens]) - penalty * weights[touched]
            sums[touched] += step * step
            weights[touched] += rate * step / np.sqrt(sums[touched])
            pair_sums += by_pair * by_pair
            pairs += rate * by_pair / np.sqrt(pair_sums)
            pairs -= pairs[0]  # only differences count
    return weights.astype(np.float32), pairs


def fit_score(sums: np.ndarray, toxic: np.ndarray, share: float) -> tuple[float, float]:
    """Slope (0.1 at least) and offset of the logistic score on the log of the evidence; labels weigh as in the whole table."""
    x = np.log(sums + 1e-3)
    weight = np.where(toxic == 1, share / max(toxic.mean(), 1e-9), (1 - share) / max(1 - toxic.mean(), 1e-9)) / len(x)
    slope, offset = 1.0, 0.0
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(slope * x + offset, -40, 40)))
        off, curve = weight * (toxic - chance), weight * chance * (1 - chance)
        g = np.array([(off * x).sum() - 1e-3 * slope, off.sum()])
        h = np.array([[(curve * x * x).sum() + 1e-3, (curve * x).sum()], [(curve * x).sum(), curve.sum() + 1e-9]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        slope, offset = max(0.1, slope + step[0]), offset + step[1]
    return float(slope), float(offset)


def _feature_counts(rows: DataFrame) -> DataFrame:
    """``(bucket, bad, good)``: toxic and clean documents with a feature, reduced in each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(counted_buckets)
        counts = np.zeros((2, 1 << COUNT_BITS), dtype=np.int64)
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = set(WORD.findall(text or ""))
                if words:
                    counts[toxic, np.unique(np.concatenate([memo[w] for w in words]))] += 1
        seen = np.flatnonzero(counts.any(axis=0))
        for first in range(0, len(seen), 1 << 16):
            part = seen[first:first + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[1, part]), pa.array(counts[0, part])], ["bucket", "bad", "good"])

    counted = rows.select("text", "toxic").mapInArrow(run, "bucket long, bad long, good long")
    return counted.groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def bad_buckets(counts: DataFrame, share: float) -> set[int]:
    """Buckets whose documents are toxic too often for chance."""
    both = F.col("bad") + F.col("good")
    ratio = F.col("bad") * F.log(F.col("bad") / (both * share)) + F.when(F.col("good") > 0, F.col("good") * F.log(F.col("good") / (both * (1 - share)))).otherwise(0.0)
    tried = counts.agg(F.count(F.lit(1))).first()[0]
    kept = counts.filter((F.col("bad") > 0) & (F.col("bad") >= PURE * both) & (ratio > math.log(max(tried, 1)) + 4))
    return {r[0] for r in kept.select("bucket").toLocalIterator()}


def labelled_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, text, toxic)`` of documents with a label; of equal texts the one of the least id."""
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("of")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    marks = docs.filter("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("mark")).join(known, F.col("doc_id") == F.col("of"))
    chosen = marks.groupBy("mark").agg(F.min("of").alias("of"), F.max("toxic").alias("toxic")).select("mark", "of", "toxic")
    return docs.select("doc_id", "text").join(chosen, (F.col("doc_id") == F.col("of")) & (F.xxhash64("text") == F.col("mark"))).dropDuplicates(["of", "mark"]).select("doc_id", "text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from documents (doc_id, text) that may be learned from and labels (doc_id, toxic)."""
    rows = materialize(labelled_documents(docs, labels), "toxicity-labelled")
    n, bad = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < bad < n:
        return Model(share=bad / n if n else 0.0)
    share = bad / n
    buckets = bad_buckets(materialize(_feature_counts(rows), "toxicity-counts"), share)
    if not buckets:
        return Model(share=share)
    memo = Memo(lambda w: not buckets.isdisjoint(counted_buckets(w).tolist()))
    chosen = []
    for toxic in (0, 1):
        for r in rows.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toLocalIterator():
            words = WORD.findall(r["text"])
            chosen.append((r["text"], toxic, words, np.array([int(toxic and memo[w]) for w in words], dtype=np.int64)))
    kept_back = [c for i, c in enumerate(chosen) if i % 3 == 0]
    weights, log_pairs = fit_chain([(words, states) for i, (_, _, words, states) in enumerate(chosen) if i % 3])
    model = Model(share, weights, np.exp(log_pairs).tolist())
    tag = model.tagger()
    sums = np.array([evidence(tag(text)) for text, *_ in kept_back])
    model.slope, model.offset = fit_score(sums, np.array([toxic for _, toxic, *_ in kept_back]), share)
    return model


# --- scoring ----------------------------------------------------------------------------------


def tag_toxicity(docs: DataFrame, model: Model, keep: list[str | Column] = ("doc_id",), spans: bool = True) -> DataFrame:
    """The columns of ``keep``, ``score`` and, if wanted, ``spans (start, end, marginal)``: runs of tokens above ``SPAN`` in code points, with the highest marginal."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*keep)
    names = kept.columns
    schema = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes) + ", score double" + (", spans array<struct<start: long, end: long, marginal: double>>" if spans else "")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        tag = own.kept_tagger() if own.weights is not None else None
        for batch in batches:
            scores, runs = [], []
            for text in batch.column(len(names)).to_pylist():
                marginals = tag(text or "") if tag else []
                scores.append(own.document_score(marginals) if tag else own.share)
                if spans:
                    found, last = [], None
                    places = [m.span() for m in WORD.finditer(text or "")] if any(m > SPAN for m in marginals) else []
                    for i, m in enumerate(marginals):
                        if m > SPAN:
                            if last == i - 1 and found:
                                found[-1]["end"], found[-1]["marginal"] = places[i][1], max(m, found[-1]["marginal"])
                            else:
                                found.append({"start": places[i][0], "end": places[i][1], "marginal": m})
                            last = i
                    runs.append(found)
            columns = [*batch.columns[:len(names)], pa.array(scores, pa.float64()), *([pa.array(runs, kind)] if spans else [])]
            yield pa.RecordBatch.from_arrays(columns, [*names, "score", *(["spans"] if spans else [])])

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, schema)
