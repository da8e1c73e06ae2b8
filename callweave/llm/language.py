"""Language identification by error-correcting output codes.

Every language has a codeword. For each bit a binary classifier over hashed byte n-grams says how
strongly a text looks like the languages with that bit set: its weights are log ratios of
smoothed n-gram shares, counted by Spark over all training rows. Decoding weighs each bit by
its reliability and takes the codeword with the least exponential loss; a text whose two nearest
codewords are close is flagged as ambiguous.

Defined cases: a null text or one without a letter is ``und`` with score 0; rows with a null
language teach nothing; one language is always predicted, none gives ``und``; texts may be of any
length and count in whole; an empty table gives no rows; other columns never clash, as only the
key columns travel.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


BUCKETS = 1 << 13
#: Bytes that are no letters become a space; bytes of longer characters stay.
LETTER_BYTES = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def gram_counts(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Counts of hashed byte 1- to 4-grams of the lower-cased text, runs of non-letters as one space."""
    data = b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(LETTER_BYTES).split())
    x = np.frombuffer(b" " + data + b" ", np.uint8).astype(np.uint32)
    total = np.zeros(buckets, np.int64)
    gram = x
    for n in range(1, 5):
        if n > 1:
            gram = gram[:-1] * np.uint32(257) + x[n - 1 :]
        spread = gram * np.uint32(2654435761) + np.uint32(n * 40503)
        total += np.bincount((spread >> np.uint32(32 - buckets.bit_length() + 1)).astype(np.int64), minlength=buckets)
    return total


def has_letter(text: str | None) -> bool:
    return bool(text) and (any(map(str.isalpha, text[:64])) or any(map(str.isalpha, text)))


def codewords(classes: int) -> np.ndarray:
    """One row of +1 and -1 per class: all splits in two for up to six classes, else seeded
    random words, far longer than needed to tell the classes apart, without constant bits."""
    if classes <= 6:
        bits = np.arange(1, 1 << max(0, classes - 1))
        words = ((bits[None, :] << 1) >> np.arange(classes)[::-1][:, None]) & 1
        return np.where(words, 1, -1)
    rng = np.random.default_rng(7)
    length = 16 * int(np.ceil(np.log2(classes)))
    best = None
    for _ in range(64):
        words = np.where(rng.random((classes, length)) < 0.5, 1, -1)
        words = words[:, np.abs(words.sum(axis=0)) < classes]
        apart = ((words.shape[1] - words @ words.T) // 2 + np.eye(classes, dtype=int) * length).min()
        if best is None or apart > best[0]:
            best = apart, words
    return best[1]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) to (lang, counts) summed per task; a counts row per language of the task."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            if has_letter(text):
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS + 1, np.int64)
                sums[lang][:-1] += gram_counts(text)
                sums[lang][-1] += 1
    for lang, total in sums.items():
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at)), pa.array(at, pa.int64()), pa.array(total[at])], names=["lang", "bucket", "n"]
        )


def train(rows: DataFrame, alpha: float = 0.5) -> SimpleNamespace:
    """Codes, weights and bit reliabilities from all rows (lang, text) with a language.

    What reaches the driver has one number per language and bucket, whatever the rows."""
    known = rows.where("lang is not null and text is not null").select(F.col("lang").cast("string"), "text")
    counted = known.mapInArrow(_count_batches, "lang string, bucket long, n long")
    got = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r[0] for r in got})
    counts = np.zeros((len(langs), BUCKETS + 1))
    for lang, bucket, n in got:
        counts[langs.index(lang), bucket] = n
    counts = counts[:, :-1]
    if len(langs) < 2:
        return SimpleNamespace(langs=langs, codes=np.zeros((len(langs), 0)), weights=np.zeros((BUCKETS, 0)), trust=np.zeros(0))
    share = (counts + alpha) / (counts + alpha).sum(axis=1, keepdims=True)
    codes = codewords(len(langs))
    weights = np.stack(
        [np.log(share[codes[:, b] > 0].mean(axis=0)) - np.log(share[codes[:, b] < 0].mean(axis=0)) for b in range(codes.shape[1])], axis=1
    )
    # a bit's margin per gram on the languages' own texts: how far the two sides lie apart
    margin = (counts / counts.sum(axis=1, keepdims=True)) @ weights
    gap = np.array(
        [margin[codes[:, b] > 0, b].min() - margin[codes[:, b] < 0, b].max() for b in range(codes.shape[1])]
    )
    middle = np.array(
        [(margin[codes[:, b] > 0, b].min() + margin[codes[:, b] < 0, b].max()) / 2 for b in range(codes.shape[1])]
    )
    trust = np.maximum(gap, 1e-3)
    return SimpleNamespace(langs=langs, codes=codes, weights=weights, trust=trust, middle=middle)


def decode(margins: np.ndarray, model: SimpleNamespace) -> tuple[int, float, bool]:
    """``(class, score, ambiguous)`` by loss-weighted decoding of the bits' mean margins."""
    unit = np.clip((margins - model.middle) / model.trust * 2, -6, 6)
    weight = model.trust / model.trust.sum()
    loss = (np.exp(-model.codes * unit) * weight).sum(axis=1)
    order = np.argsort(loss, kind="stable")
    share = np.exp(-4 * (loss - loss[order[0]]))
    return int(order[0]), float(share[order[0]] / share.sum()), bool(loss[order[1]] < 1.25 * loss[order[0]])


def _predict_batches(batches: Iterator[pa.RecordBatch], model: SimpleNamespace) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, scores, unsure = [], [], []
        for text in batch.column(batch.num_columns - 1):
            text = text.as_py()
            if not model.langs or not has_letter(text):
                got = "und", 0.0, True
            elif len(model.langs) == 1:
                got = model.langs[0], 1.0, False
            else:
                counts = gram_counts(text)
                k, score, close = decode(counts @ model.weights / counts.sum(), model)
                got = model.langs[k], score, close
            for column, value in zip((langs, scores, unsure), got):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_())],
            names=[*batch.schema.names[:-1], "lang_pred", "score", "ambiguous"],
        )


def predict(docs: DataFrame, model: SimpleNamespace, *keep: str, text: str = "text") -> DataFrame:
    """``keep`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``."""
    rows = docs.select(*keep, F.col(text).cast("string").alias("text"))
    schema = T.StructType(
        [
            *(rows.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType()),
        ]
    )
    return rows.mapInArrow(partial(_predict_batches, model=model), schema)
