"""Cross-entropy difference of two matched n-gram models.

Target and background model are interpolated models of ORDER bytes over one vocabulary, the 256 bytes and
the line ends that begin a text; both are counted over whole texts in the same way, the background over
all documents and the target over those chosen. A document's score is the mean over its bytes of the
target model's loss less the background's: the lower, the nearer to the target.

The n-grams of highest order are counted without bound, by shuffle, and never meet on the driver. Documents are dealt
into chunks of about CHUNK bytes; a chunk asks once for the losses of each of its distinct n-grams, and they
come back to its documents by chunk, so a frequent n-gram costs a row a chunk and not one a document. Only the lower orders,
the trigrams, are gathered and broadcast: 256^3 cells at most at every input size (of 12 bytes), in fact some ten thousand.

Edge cases: a null or empty text has no byte; its losses and score are null. If no document is chosen,
the target's counts are all zero and its losses are those of the uniform model. Rows that repeat an id count as often
as they occur. An empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm.common import buffers, checked_broadcast, chunks, columns, lower_ascii, stored, text_bytes

#: Counts that a lower order's estimate weighs.
PRIOR = 8.0
#: Bytes of an n-gram of the highest order.
ORDER = 5
#: Text bytes of a chunk of documents, about; a longer document is a chunk of its own.
CHUNK = 16 << 20
#: Text bytes whose n-grams are made at a time.
PIECE = 4 << 20


def grams(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> np.ndarray:
    """For each byte, itself and the order - 1 before it in its text (line ends before the first), the last lowest."""
    low = lower_ascii(data).astype(np.int64)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    code = low.copy()
    for k in range(1, order):
        before = np.full(len(data), 10, np.int64)
        before[k:] = low[:-k]
        before[place < k] = 10
        code |= before << 8 * k
    return code


def _runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes)
    at = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[at], np.diff(np.append(at, len(codes)))


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents with the number of their chunk."""
    chunk, size = TaskContext.get().partitionId() << 32, 0
    for batch in chunks(batches):
        yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, chunk)), *batch.columns], names=["chunk", *batch.schema.names])
        size += (pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0) + 64 * batch.num_rows
        if size >= CHUNK:
            chunk, size = chunk + 1, 0


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of each chunk; a chunk whose rows are read by several tasks has rows of each."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    now = None

    def merged():
        codes, every, chosen = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        at = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        return codes[at], np.add.reduceat(every[order], at), np.add.reduceat(chosen[order], at)

    def rows():
        codes, every, chosen = merged()
        return pa.record_batch({"chunk": pa.array(np.full(len(codes), now)), "code": pa.array(codes), "n": pa.array(every), "t": pa.array(chosen)})

    for batch in chunks(batches, limit=PIECE):
        chunk = batch.column("chunk").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True):
            if chunk[a] != now:
                if held:
                    yield rows()
                now, held = chunk[a], []
            part = batch.slice(a, b - a)
            data, offsets = buffers(text_bytes(part.column("text")))
            if not len(data):
                continue
            codes = grams(data, offsets)
            found, n = _runs(codes)
            some, m = _runs(codes[np.repeat(part.column("target").to_numpy(zero_copy_only=False).astype(bool), np.diff(offsets))])
            chosen = np.zeros(len(found), np.int64)
            chosen[np.searchsorted(found, some)] = m
            held.append((found, n.astype(np.int64), chosen))
            if len(held) > 8:
                held = [merged()]
    if held:
        yield rows()


class Trigrams:
    """Probabilities of the counted trigrams, by the lower orders where they are rare."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, prior: float = PRIOR):
        counts = counts.astype(np.float64)
        uni = np.bincount(codes & 255, counts, 256)
        bi = np.bincount(codes & 0xFFFF, counts, 1 << 16)
        context = np.bincount(codes >> 8, counts, 1 << 16)
        before = np.bincount(codes >> 8 & 255, counts, 256)
        p1 = (uni + 1) / (uni.sum() + 256)
        p2 = ((bi.reshape(256, 256) + prior * p1) / (before[:, None] + prior)).ravel()
        self.p3 = (counts + prior * p2[codes & 0xFFFF]) / (context[codes >> 8] + prior)


def _lossy(shared, prior: float):
    """The losses of each n-gram from its counts, those of its context and the lower orders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, target, background = shared.value
        for batch in batches:
            code, n, t, cn, ct = (batch.column(c).to_numpy() for c in ("code", "n", "t", "cn", "ct"))
            at = np.searchsorted(known, code & 0xFFFFFF)
            losses = [-np.log((x + prior * p[at]) / (c + prior)) for x, c, p in ((t, ct, target.p3), (n, cn, background.p3))]
            yield pa.record_batch({"code": batch.column("code"), "lt": pa.array(losses[0], pa.float32()), "lb": pa.array(losses[1], pa.float32())})

    return run


def losses(gathered: DataFrame, prior: float = PRIOR) -> DataFrame:
    """code, lt, lb: the target's and the background's loss of each n-gram; gathered: code, n, t.

    A context has 256 n-grams at most, so its window is bounded."""
    counts = stored(gathered.groupBy("code").agg(F.sum("n").alias("n"), F.sum("t").alias("t")), "lm-counts")
    lower = counts.groupBy(F.col("code").bitwiseAND(0xFFFFFF).alias("code")).agg(F.sum("n").alias("n"), F.sum("t").alias("t")).toArrow()
    codes, n, t = (lower.column(c).to_numpy().astype(np.int64) for c in ("code", "n", "t"))
    order = np.argsort(codes)
    codes = codes[order]
    shared = gathered.sparkSession.sparkContext.broadcast((codes, Trigrams(codes, t[order], prior), Trigrams(codes, n[order], prior)))
    context = Window.partitionBy(F.shiftright("code", 8))
    stats = counts.select("code", "n", "t", F.sum("n").over(context).alias("cn"), F.sum("t").over(context).alias("ct"))
    return stats.mapInArrow(_lossy(shared, prior), "code long, lt float, lb float")


def _scored(docs: pa.Table, found: pa.Table) -> pa.Table:
    code = found.column("code").to_numpy()
    order = np.argsort(code, kind="stable")
    code = code[order]
    each = [found.column(c).to_numpy()[order].astype(np.float64) for c in ("lt", "lb")]
    out = []
    for batch in chunks(docs.to_batches(), limit=PIECE):
        data, offsets = buffers(text_bytes(batch.column("text")))
        size = np.diff(offsets)
        at = np.searchsorted(code, grams(data, offsets))
        sums = [np.concatenate([[0.0], np.cumsum(x[at])]) for x in each]
        target, background = ((x[offsets[1:]] - x[offsets[:-1]]) / np.maximum(size, 1) for x in sums)
        empty = size == 0
        out.append(
            pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "n_tokens": pa.array(size, pa.int64()),
                    "target_loss": pa.array(target, mask=empty),
                    "background_loss": pa.array(background, mask=empty),
                    "score": pa.array(target - background, mask=empty),
                }
            )
        )
    return pa.Table.from_batches(out, SCORED)


SCORED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), *((c, pa.float64()) for c in ("target_loss", "background_loss", "score"))])


def score(docs: DataFrame, target: DataFrame, prior: float = PRIOR) -> DataFrame:
    """A row per document: doc_id, n_tokens, target_loss, background_loss, score; target has the doc_id of the target's documents."""
    chosen = checked_broadcast(target.select(F.col("doc_id").alias("id")).distinct())
    marked = columns(docs, "doc_id", "text").join(chosen, F.col("doc_id") == F.col("id"), "left")
    marked = marked.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("id").isNotNull().alias("target"))
    dealt = stored(marked.mapInArrow(_dealt, "chunk long, doc_id long, text string, target boolean"), "lm-documents")
    gathered = stored(dealt.mapInArrow(_gathered, "chunk long, code long, n long, t long"), "lm-grams")
    answered = gathered.select("chunk", "code").join(losses(gathered, prior), "code").select("chunk", "code", "lt", "lb")
    texts = dealt.select("chunk", "doc_id", "text")
    fields = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"
    return texts.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(_scored, fields)


def op7_lm_scoring(spark, sf_dir) -> DataFrame:
    """Documents labelled good and not toxic are the target."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels.filter("quality = 1 AND toxic = 0"))
