"""Toxicity scores by a counterfactual-regularised classifier.

A logistic model over word and word-beginning features. Beside the log loss on labelled texts it is
penalised for every change of score when an identity term of a text is swapped for another of its
kind, so that a neutral mention of a group does not raise the score by itself.

The model is learnt from a bounded sample of the labelled rows (``labelled_sample``): features are chosen
from counts that Spark makes over it, the weights fitted on the driver.

Defined cases: null and empty texts have no features and score the base rate; rows with a null
label, id or text teach nothing; of rows with the same id one teaches, that with the least hash of its text; without labels of both kinds every score is the share of label 1
(0 without labels); repeated labels of an id count once each; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.llm.common import stored

BUCKETS = 1 << 18
WORD = re.compile(r"[^\W\d_]+")
#: Terms that name groups, by kind; within a kind each is swapped for the next.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("she", "he"), ("her", "his"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european"), ("gay", "straight", "lesbian", "bisexual"),
    ("immigrants", "natives", "refugees"), ("old", "young"), ("disabled", "deaf", "blind"),
)


def swaps(terms: tuple = IDENTITY_TERMS) -> dict[str, str]:
    return {t: kind[(i + 1) % len(kind)] for kind in terms for i, t in enumerate(kind)}


def _bucket(feature: str) -> int:
    import xxhash

    return xxhash.xxh32_intdigest(feature) % BUCKETS


def word_features(word: str) -> tuple[int, ...]:
    """The word and its beginnings of 4 and 5 letters, which stand for all its endings."""
    out = [_bucket(word)]
    if len(word) > 4:
        out.append(_bucket("4" + word[:4]))
    if len(word) > 5:
        out.append(_bucket("5" + word[:5]))
    return tuple(out)


def _extractor(chosen: dict[int, int] | None = None, limit: int = 200_000):
    """``features(text)``: the distinct features of a text, as buckets or as their numbers in ``chosen``."""
    known: dict[str, tuple[int, ...]] = {}

    def features(words: set[str]) -> set[int]:
        out: set[int] = set()
        for w in words:
            got = known.get(w)
            if got is None:
                if len(known) >= limit:
                    known.clear()
                got = word_features(w)
                if chosen is not None:
                    got = tuple(chosen[b] for b in got if b in chosen)
                known[w] = got
            if got:
                out.update(got)
        return out

    return features


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def swapped(words: set[str], swap: dict[str, str]) -> set[str]:
    """The words of the text with every identity term swapped."""
    hit = words & swap.keys()
    return (words - hit) | {swap[w] for w in hit} if hit else words


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (toxic, text) to (bucket, ones, zeros): in how many texts each feature is."""
    features = _extractor()
    total = np.zeros((2, BUCKETS + 1), np.int64)  # the last: all texts
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            at = np.fromiter(features(words_of(text.as_py())), np.int64)
            total[int(label == 1)][at] += 1
            total[int(label == 1)][-1] += 1
    at = np.nonzero(total.sum(axis=0))[0]
    yield pa.RecordBatch.from_arrays(
        [pa.array(at, pa.int64()), pa.array(total[1][at]), pa.array(total[0][at])], names=["bucket", "ones", "zeros"]
    )


def _sample_batches(
    batches: Iterator[pa.RecordBatch], chosen: dict[int, int], swap: dict[str, str]
) -> Iterator[pa.RecordBatch]:
    """Rows (toxic, text) to (toxic, features, features after the swap; null without an identity term)."""
    features = _extractor(chosen)
    for batch in batches:
        plain, other = [], []
        for text in batch.column(1):
            words = words_of(text.as_py())
            changed = swapped(words, swap)
            plain.append(sorted(features(words)))
            other.append(sorted(features(changed)) if changed is not words else None)
        kind = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(plain, kind), pa.array(other, kind)], names=["toxic", "plain", "other"])


def _sparse(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(r) for r in rows], np.int64)
    return np.concatenate([np.asarray(r, np.int64) for r in rows]) if sizes.sum() else np.zeros(0, np.int64), np.repeat(np.arange(len(rows)), sizes)


def fit(
    labels: np.ndarray, plain: list, other: list, size: int, penalty: float = 1.0, ridge: float = 1e-3, steps: int = 300
) -> tuple[np.ndarray, float]:
    """Weights and intercept: log loss + ``penalty`` times the mean squared change of the margin under
    the swap + ridge, by Adam over all rows; positive and negative rows weigh the same in total."""
    n, y = len(labels), labels.astype(float)
    at, row = _sparse(plain)
    pairs = [k for k, o in enumerate(other) if o is not None]
    at_a, row_a = _sparse([plain[k] for k in pairs])
    at_b, row_b = _sparse([other[k] for k in pairs])
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w, b = np.zeros(size + 1), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        margin = np.bincount(row, w[at], n) + w[size]
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) * weight
        grad = np.bincount(at, error[row], size + 1)
        grad[size] += error.sum()
        if pairs:
            change = np.bincount(row_a, w[at_a], len(pairs)) - np.bincount(row_b, w[at_b], len(pairs))
            change *= 2 * penalty / len(pairs)
            grad += np.bincount(at_a, change[row_a], size + 1) - np.bincount(at_b, change[row_b], size + 1)
        grad[:size] += ridge * w[:size]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:size], float(w[size])


def labelled_sample(
    docs: DataFrame, labels: DataFrame, max_rows: int = 24_000, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic"
) -> DataFrame:
    """Rows (id, toxic, text) of about ``max_rows`` labelled documents at most, both labels alike, drawn by
    a hash of the id, one row per id. Labels are drawn before texts are looked up, so the side that is broadcast is
    bounded by ``max_rows``, and only the texts of the sample are shuffled, equal rows of a task as one. An id with
    several labels counts as toxic if one is."""
    known = labels.where(F.col(doc_id).isNotNull() & F.col(toxic).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("id")).agg(F.max((F.col(toxic) == 1).cast("int")).alias("toxic"))
    sizes = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    share = {k: min(1.0, max_rows / 2 / max(1, sizes.get(k, 0))) for k in (0, 1)}
    draw = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 20))
    drawn = known.where(draw < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]) * (1 << 20))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).where("text is not null")
    texts = texts.withColumn("hash", F.xxhash64("text"))
    least = texts.join(F.broadcast(drawn), "id").groupBy("id").agg(F.max("toxic").alias("toxic"), F.min("hash").alias("hash"))
    least = stored(least, "toxicity-sample")
    return texts.join(F.broadcast(least), ["id", "hash"]).select("id", "toxic", "text").distinct()


def train(
    rows: DataFrame, max_features: int = 4096, min_texts: int = 8, terms: tuple = IDENTITY_TERMS, penalty: float = 1.0
) -> SimpleNamespace:
    """A model from rows (id, toxic, text), such as ``labelled_sample`` gives. Features are the
    ``max_features`` whose presence tells the labels apart most surely, and those of the identity terms."""
    known = rows.where("toxic is not null and text is not null and id is not null")
    # counts per feature; feature ``BUCKETS`` counts the texts
    counted = known.select("toxic", "text").mapInArrow(_count_batches, "bucket long, ones long, zeros long")
    sums = counted.groupBy("bucket").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    sums = {r[0]: (r[1], r[2]) for r in sums.where(f"ones + zeros >= {min_texts} or bucket = {BUCKETS}").collect()}
    n1, n0 = sums.pop(BUCKETS, (0, 0))
    if not n1 or not n0:
        return SimpleNamespace(chosen={}, weights=np.zeros(0), intercept=None, base=float(n1 > 0))
    at = np.array(list(sums), np.int64)
    c1, c0 = np.array(list(sums.values()), float).reshape(-1, 2).T
    p1, p0, p = (c1 + 0.5) / (n1 + 1), (c0 + 0.5) / (n0 + 1), (c1 + c0 + 1) / (n1 + n0 + 2)
    sure = np.abs(p1 - p0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    swap = swaps(terms)
    named = {b for t in swap for b in word_features(t)}
    best = at[np.argsort(-sure, kind="stable")[:max_features]].tolist()
    chosen = {b: k for k, b in enumerate(dict.fromkeys([*best, *sorted(named)]))}
    sample = known.select("toxic", "text").mapInArrow(
        partial(_sample_batches, chosen=chosen, swap=swap), "toxic int, plain array<int>, other array<int>"
    ).toArrow()
    plain, other = sample.column("plain").to_pylist(), sample.column("other").to_pylist()
    weights, intercept = fit(sample.column("toxic").to_numpy(), plain, other, len(chosen), penalty)
    return SimpleNamespace(chosen=chosen, weights=weights, intercept=intercept, base=n1 / (n1 + n0))


def _score_batches(batches: Iterator[pa.RecordBatch], model: SimpleNamespace) -> Iterator[pa.RecordBatch]:
    features = _extractor(model.chosen)
    for batch in batches:
        scores = []
        for text in batch.column(batch.num_columns - 1):
            if model.intercept is None:
                scores.append(model.base)
                continue
            at = np.fromiter(features(words_of(text.as_py())), np.int64)
            scores.append(float(1 / (1 + np.exp(-np.clip(model.weights[at].sum() + model.intercept, -30, 30)))))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*batch.schema.names[:-1], "score"])


def score(docs: DataFrame, model: SimpleNamespace, *keep: str, text: str = "text") -> DataFrame:
    """``keep`` with ``score``, the model's probability of label 1 for the whole text."""
    rows = docs.select(*keep, F.col(text).cast("string").alias("text"))
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(partial(_score_batches, model=model), schema)
