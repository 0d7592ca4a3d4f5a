"""Language identification by averaged hashed subword embeddings.

A text is the average of the embeddings of its byte n-grams (n = 1 to 3, hashed to BUCKETS rows), and a
linear softmax tells the language. Both layers are trained by stochastic gradient descent in numpy on a
bounded sample of labelled rows, PER_LANGUAGE for each language; their features are made by
tasks. A quarter of the sample is kept from training: on it a temperature is fitted that calibrates the probabilities,
and a threshold under which a prediction is not accepted. As all steps after training are linear before
the softmax, embeddings and weights are multiplied once into a small table that the tasks get.

Edge cases: a null text and one without a letter are `und`, with score 0 and not accepted. Documents with
no language are predicted but not learned from. With no labelled row everything is `und`. Rows that repeat an id are
rows of their own; an empty table gives no rows. Columns other than doc_id, text and lang are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import buffers, checked_broadcast, chunks, columns, lower_ascii, text_bytes
from meterloom.llm.sampling import bounded_sample

BUCKETS = 1 << 15
DIMENSIONS = 16
ORDERS = (1, 2, 3)
#: Bound of the labelled rows of each language that are learned from.
PER_LANGUAGE = 800
EPOCHS = 6
RATE = 2.0
#: Share of accepted predictions that must be right on the calibration rows.
WANTED = 0.99

_LETTER = re.compile(r"[^\W\d_]")


def subwords(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: (bucket of the n-gram that begins at each byte, whether it ends within its text).

    Letters of A-Z are lower-cased; other ASCII characters that are no letters count as spaces."""
    low = lower_ascii(data)
    low = np.where((low < 128) & ~((low >= 97) & (low <= 122)), 32, low).astype(np.uint64)
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    code = np.zeros(len(data), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        shifted = np.full(len(data), 0, np.uint64)
        shifted[: len(data) - order + 1] = low[order - 1 :]
        code = code << np.uint64(8) | shifted
        if order in ORDERS:
            mixed = (code + np.uint64(order << 24)) * np.uint64(0x9E3779B97F4A7C15)
            yield (mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), left >= order


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The buckets of each text and their shares of its n-grams."""
    for batch in chunks(batches, limit=2 << 20):
        data, offsets = buffers(text_bytes(batch.column("text")))
        parts = list(subwords(data, offsets))
        buckets, shares = [], []
        for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False):
            n = np.bincount(np.concatenate([x[a:b][ok[a:b]] for x, ok in parts]), minlength=1)
            at = np.flatnonzero(n)
            buckets.append(at.astype(np.int32))
            shares.append((n[at] / max(1, n.sum())).astype(np.float32))
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id").cast(pa.int64()),
                "lang": batch.column("lang").cast(pa.string()),
                "buckets": pa.array(buckets, pa.list_(pa.int32())),
                "shares": pa.array(shares, pa.list_(pa.float32())),
            }
        )


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_labels: int, seed: int = 3) -> np.ndarray:
    """Scores of each bucket for each label (embeddings times weights), by stochastic gradient descent."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.3, (BUCKETS, DIMENSIONS))
    weights = rng.normal(0, 0.3, (DIMENSIONS, n_labels))
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at, share = rows[i]
            if not len(at):
                continue
            hidden = share @ embed[at]
            slope = softmax(hidden @ weights)
            slope[labels[i]] -= 1
            rate = RATE * (1 - done / steps)
            back = weights @ slope
            weights -= rate * np.outer(hidden, slope)
            embed[at] -= rate * np.outer(share, back)
            done += 1
    return embed @ weights


def calibrate(scores: np.ndarray, labels: np.ndarray, wanted: float = WANTED) -> tuple[float, float]:
    """(factor of the scores of least log loss, probability from which enough predictions are right)."""
    if not len(labels):
        return 1.0, 0.0
    factors = np.exp(np.linspace(-2, 3, 51))
    losses = [-np.log(softmax(scores * f)[np.arange(len(labels)), labels] + 1e-12).mean() for f in factors]
    factor = float(factors[int(np.argmin(losses))])
    sure = softmax(scores * factor)
    order = np.argsort(-sure.max(axis=1), kind="stable")
    right = np.cumsum(sure.argmax(axis=1)[order] == labels[order]) / np.arange(1, len(labels) + 1)
    enough = np.flatnonzero(right >= wanted)
    return factor, float(sure.max(axis=1)[order][enough[-1]]) if len(enough) else 1.0


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray, float, float]:
    """(languages, scores of each bucket, factor, threshold); labelled has doc_id, text, lang."""
    chosen = checked_broadcast(bounded_sample(labelled.select(F.col("doc_id").alias("id"), F.col("lang").alias("l")), "l", "id", per_language).select("id").distinct())
    found = labelled.join(chosen, F.col("doc_id") == F.col("id"), "left_semi").mapInArrow(_features, "doc_id long, lang string, buckets array<int>, shares array<float>").toArrow()
    order = np.argsort(found.column("doc_id").to_numpy(zero_copy_only=False), kind="stable")
    found = found.take(pa.array(order))
    names = sorted(set(found.column("lang").to_pylist()))
    labels = np.array([names.index(x) for x in found.column("lang").to_pylist()], np.int64)
    rows = [(np.array(a.values), np.array(b.values, np.float64)) for a, b in zip(found.column("buckets"), found.column("shares"), strict=True)]
    if not rows:
        return [], np.zeros((BUCKETS, 0)), 1.0, 0.0
    held = np.arange(len(rows)) % 4 == 3
    table = train([r for r, h in zip(rows, held, strict=True) if not h], labels[~held], len(names))
    scores = np.array([b @ table[a] for (a, b), h in zip(rows, held, strict=True) if h]).reshape(-1, len(names))
    factor, threshold = calibrate(scores, labels[held])
    return names, table.astype(np.float32), factor, threshold


def _predicted(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table, factor, threshold = shared.value
        for batch in chunks(batches, limit=1 << 20):
            texts = batch.column("text").to_pylist()
            data, offsets = buffers(text_bytes(batch.column("text")))
            total, n = np.zeros((batch.num_rows, len(names))), np.zeros(batch.num_rows)
            for bucket, inside in subwords(data, offsets):
                rows = table[bucket] * inside[:, None]
                sums = np.concatenate([np.zeros((1, len(names))), np.cumsum(rows, axis=0, dtype=np.float64)])
                total += sums[offsets[1:]] - sums[offsets[:-1]]
                ends = np.concatenate([[0], np.cumsum(inside)])
                n += ends[offsets[1:]] - ends[offsets[:-1]]
            known = np.array([bool(names) and t is not None and _LETTER.search(t) is not None for t in texts], bool)
            if names:
                sure = softmax(total / np.maximum(n, 1)[:, None] * factor)
                best, top = sure.argmax(axis=1), sure.max(axis=1)
            else:
                best, top = np.zeros(len(texts), int), np.zeros(len(texts))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "lang_pred": pa.array([names[b] if k else "und" for b, k in zip(best, known, strict=True)], pa.string()),
                    "score": pa.array(np.where(known, top, 0.0)),
                    "accepted": pa.array(known & (top >= threshold)),
                }
            )

    return run


def identify(docs: DataFrame, labelled: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """A row per document: doc_id, lang_pred, score, accepted."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(columns(labelled, "doc_id", "text", "lang"), per_language))
    return columns(docs, "doc_id", "text").mapInArrow(_predicted(shared), "doc_id long, lang_pred string, score double, accepted boolean")


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op8_language_id(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs, docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull()))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")
