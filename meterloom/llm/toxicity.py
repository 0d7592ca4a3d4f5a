"""Toxicity by cumulative-link ordinal regression on sparse text features.

Grades 0 < 1 < ... are told apart by ordered thresholds on one score: P(grade > j) = sigmoid(w.x - t_j),
with the same weights for all thresholds. x has a one for each distinct hashed word of a text (lower
case, without ASCII punctuation around it) and each prefix of its words, PREFIX code points long, so that the
forms of a word count together; what occurs twice or more has another one. Weights are fitted by AdaGrad in numpy on a bounded sample of labelled
rows, PER_GRADE for each grade, whose features are made by tasks. Only words and prefixes have a weight whose
counts in grade 0 and in the higher grades differ by a likelihood ratio of Z standard errors; how rare they are doesn't matter. The expected severity is the sum of
P(grade > j). The cut that calls a document toxic is the one of best F1 on a quarter of the sample that is kept from fitting.

Edge cases: null and empty texts have no word and get severity 0 and grade 0. Documents without label are scored but
not learned from. With no labelled row, or one grade only, everything has severity 0. Rows that repeat an id
are rows of their own; an empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import Words, buffers, checked_broadcast, chunks, columns, lower_ascii, text_bytes
from meterloom.llm.sampling import bounded_sample

#: Least and most code points of the prefixes that are features.
PREFIX = (4, 8)
#: Slots of the table that rules most codes out before they are compared.
FILTER = 1 << 20
TWICE = 1 << 31
#: Bound of the labelled rows of each grade that are learned from.
PER_GRADE = 2000
Z = 5.0
EPOCHS = 8
RATE = 0.3
DECAY = 1e-3

_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True


def features(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, code) of each distinct word and prefix of each text, ordered by text, and whether a text has a word.

    Codes have 31 bits, and TWICE marks a second code of what occurs again; only those in wanted, if given (sorted)."""
    data, offsets = buffers(text_bytes(texts))
    low = lower_ascii(data)
    words = Words(low, offsets)
    letter = np.concatenate([[0], np.cumsum(_LETTER[low])])
    # bytes up to the first letter and after the last are left out
    place = np.flatnonzero(_LETTER[low])
    has = letter[words.end] > letter[words.start]
    start = place[letter[words.start[has]]]
    end = place[letter[words.end[has]] - 1] + 1
    doc = words.doc[has].astype(np.int64)
    known = np.bincount(doc, minlength=len(offsets) - 1) > 0
    maybe = None
    if wanted is not None:
        maybe = np.zeros(FILTER, bool)
        maybe[(wanted & ~TWICE) % FILTER] = True
    prime = np.uint64(0x100000001B3)
    code, points = np.zeros(len(start), np.uint64), np.zeros(len(start), np.int16)
    longest = int((end - start).max()) if len(start) else 0
    live, found = np.arange(len(start)), [np.zeros(0, np.int64)]

    def take(at: np.ndarray, factor: int) -> None:
        codes = (code[at] * np.uint64(factor) >> np.uint64(33)).astype(np.int64)
        if maybe is not None:
            hit = maybe[codes % FILTER]
            at, codes = at[hit], codes[hit]
        found.append(doc[at] << 32 | codes)

    for k in range(longest):
        live = live[end[live] - start[live] > k]
        byte = low[start[live] + k]
        points[live] += (byte & 0xC0) != 0x80
        code[live] = (code[live] ^ byte) * prime + np.uint64(k)
        # a code point ends where the next byte begins another
        after = low[np.minimum(start[live] + k + 1, end[live] - 1)]
        whole = (end[live] - start[live] == k + 1) | ((after & 0xC0) != 0x80)
        take(live[whole & (points[live] >= PREFIX[0]) & (points[live] <= PREFIX[1])], 0xD6E8FEB86659FD93)
    take(np.arange(len(start)), 0x9E3779B97F4A7C15)
    pairs, times = np.unique(np.concatenate(found), return_counts=True)
    pairs = np.sort(np.concatenate([pairs, pairs[times > 1] | TWICE]))
    doc, codes = pairs >> 32, pairs & 0xFFFFFFFF
    if wanted is not None:
        hit = np.isin(codes, wanted)
        doc, codes = doc[hit], codes[hit]
    return doc, codes, known


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, limit=1 << 20):
        doc, code, _ = features(batch.column("text"))
        edge = np.searchsorted(doc, np.arange(batch.num_rows + 1))
        rows = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(code.astype(np.uint32).view(np.int32)))
        yield pa.record_batch({"doc_id": batch.column("doc_id").cast(pa.int64()), "grade": batch.column("grade").cast(pa.int32()), "codes": rows})


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def telling(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """The codes that tell the two sides apart, sorted: the root of the likelihood ratio of their counts is Z or more.

    Unlike the difference in standard errors it holds for counts of a few texts too, so that rare words need no floor but that."""
    sizes = [int((toxic == side).sum()) for side in (False, True)]
    codes, place = np.unique(np.concatenate([*rows, np.zeros(0, np.int64)]), return_inverse=True)
    side = np.repeat(toxic, [len(r) for r in rows]).astype(bool)
    counts = [np.bincount(place[side == s], minlength=len(codes)) for s in (False, True)]
    mean = (counts[0] + counts[1]) / max(1, sum(sizes))
    ratio = np.zeros(len(codes))
    for c, n in zip(counts, sizes, strict=True):
        for seen, of in ((c, mean), (n - c, 1 - mean)):
            ratio += 2 * seen * np.log(np.where(seen > 0, seen, 1) / np.where(seen > 0, np.maximum(n * of, 1e-12), 1))
    return codes[ratio >= Z * Z]


def train(rows: list[np.ndarray], grades: np.ndarray, n_features: int, n_grades: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(weights, ordered thresholds): the first threshold and the logs of the gaps are fitted, so order holds."""
    rng = np.random.default_rng(seed)
    weights, seen = np.zeros(n_features), np.full(n_features, 1e-2)
    first, gaps = 0.0, np.zeros(n_grades - 2)
    cut_seen = np.full(n_grades - 1, 1e-2)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at, y = rows[i], int(grades[i])
            cuts = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
            over = sigmoid(weights[at].sum() - cuts)  # P(grade > j)
            edges = np.concatenate([[1.0], over, [0.0]])
            p = max(edges[y] - edges[y + 1], 1e-9)
            slope = over * (1 - over) / p
            # d loss / d (score - cut_j)
            d = np.zeros(n_grades - 1)
            if y > 0:
                d[y - 1] -= slope[y - 1]
            if y < n_grades - 1:
                d[y] += slope[y]
            g = d.sum() + DECAY * weights[at]
            seen[at] += g * g
            weights[at] -= RATE * g / np.sqrt(seen[at])
            back = np.concatenate([[-d.sum()], [-d[j + 1 :].sum() * np.exp(gaps[j]) for j in range(n_grades - 2)]])
            cut_seen += back * back
            first -= RATE * back[0] / np.sqrt(cut_seen[0])
            gaps -= RATE * back[1:] / np.sqrt(cut_seen[1:])
    return weights, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])


def best_cut(severity: np.ndarray, toxic: np.ndarray) -> float:
    """The severity from which calling documents toxic has the best F1; midway between neighbours."""
    if not toxic.any():
        return 0.5
    order = np.argsort(-severity, kind="stable")
    hits = np.cumsum(toxic[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + toxic.sum())
    # equal severities can't be parted
    f1[:-1][severity[order][:-1] == severity[order][1:]] = 0
    k = len(f1) - 1 - int(np.argmax(f1[::-1]))
    below = severity[order][k + 1] if k + 1 < len(order) else 0.0
    return float((severity[order][k] + below) / 2)


def fit(docs: DataFrame, labels: DataFrame, per_grade: int = PER_GRADE) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(telling codes, sorted; their weights; thresholds; cut); labels: doc_id, grade."""
    graded = labels.filter(F.col("grade").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.max("grade").cast("int").alias("grade"))
    chosen = checked_broadcast(bounded_sample(graded, "grade", "id", per_grade))
    found = docs.join(chosen, F.col("doc_id") == F.col("id")).select("doc_id", "grade", "text").mapInArrow(_features, "doc_id long, grade int, codes array<int>").toArrow()
    found = found.take(pa.array(np.argsort(found.column("doc_id").to_numpy(zero_copy_only=False), kind="stable")))
    grades = found.column("grade").to_numpy(zero_copy_only=False).astype(np.int64)
    if len(np.unique(grades)) < 2:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0), 0.5
    return learn([x.values.to_numpy().view(np.uint32).astype(np.int64) for x in found.column("codes")], grades)


def learn(rows: list[np.ndarray], grades: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    held = np.arange(len(rows)) % 4 == 3
    if len(np.unique(grades[~held])) < 2:
        held[:] = False
    codes = telling([r for r, h in zip(rows, held, strict=True) if not h], grades[~held] > 0)
    rows = [np.searchsorted(codes, r[np.isin(r, codes)]) for r in rows]
    weights, cuts = train([r for r, h in zip(rows, held, strict=True) if not h], grades[~held], len(codes), int(grades.max()) + 1)
    judged = held if grades[held].any() else np.ones(len(rows), bool)
    severity = np.array([sigmoid(weights[r].sum() - cuts).sum() for r, h in zip(rows, judged, strict=True) if h])
    return codes, weights, cuts, best_cut(severity, grades[judged] > 0)


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, weights, cuts, cut = shared.value
        for batch in chunks(batches):
            doc, code, known = features(batch.column("text"), codes)
            total = np.bincount(doc, weights[np.searchsorted(codes, code)], batch.num_rows)
            over = sigmoid(total[:, None] - cuts[None, :]) * known[:, None]
            severity = over.sum(axis=1)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "severity": pa.array(severity),
                    "grade": pa.array((over > 0.5).sum(axis=1), pa.int32()),
                    "toxic": pa.array(known & (severity >= cut)),
                }
            )

    return run


def grade(docs: DataFrame, labels: DataFrame, per_grade: int = PER_GRADE) -> DataFrame:
    """A row per document: doc_id, severity (expected), grade, toxic; labels: doc_id, grade."""
    narrow = columns(docs, "doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(fit(narrow, labels, per_grade))
    return narrow.mapInArrow(_scored(shared), "doc_id long, severity double, grade int, toxic boolean")


def op9_toxicity(spark, sf_dir) -> DataFrame:
    """Grade 1: toxic; grade 2: toxic and of bad quality."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels = labels.select("doc_id", (F.col("toxic") * (2 - F.coalesce("quality", F.lit(1)))).alias("grade"))
    return grade(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)
