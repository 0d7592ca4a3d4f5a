"""Helpers of the text operators: shared scratch tables, input columns, Arrow batches, words."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes handled at a time inside a task.
CHUNK_BYTES = 8 << 20

#: ASCII white space, the word separators of every operator here: [\x20\x09-\x0D].
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

WHITE = np.zeros(256, bool)
WHITE[list(SPACES)] = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the folder that all executors share, spark.checkpoint.dir; a temporary one only where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = tempfile.mkdtemp(prefix="meterloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """df written to the shared folder and read again: lineage ends there, and a lost executor loses nothing of it."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def columns(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that further ones, whatever their names, can't clash with an operator's own."""
    return docs.select(*(F.col(f"`{n}`") for n in names))


def parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: A table is broadcast up to this many bytes, counted before.
BROADCAST_BYTES = 16 << 20


def checked_broadcast(df: DataFrame, text: str | None = None) -> DataFrame:
    """df with a broadcast hint if its rows (32 bytes each and the text column's) fit in BROADCAST_BYTES, else df: then Spark joins by shuffle and splits skewed partitions."""
    extra = F.coalesce(F.sum(F.octet_length(text)), F.lit(0)) if text else F.lit(0)
    size = df.agg((F.count("*") * 32 + extra).alias("n")).first()["n"]
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def text_bytes(array: pa.Array | pa.ChunkedArray) -> pa.LargeBinaryArray:
    """The texts' UTF-8 bytes, empty where null."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    return pc.fill_null(array.cast(pa.large_string()), "").cast(pa.large_binary())


def buffers(array: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, start of each text and the end of the last)."""
    n = len(array)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + n + 1]
    data = array.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each has about limit bytes of text at most, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


class Words:
    """The words of several texts, [^\\x20\\x09-\\x0D]+, in order; doc, start, end per word (positions in data)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        white = WHITE[data]
        edge = np.ones(len(data) + 1, bool)
        if len(data):
            edge[1:-1] = white[1:] != white[:-1]
        inner = offsets[1:-1]
        edge[inner] = True  # a text's end is a word's end
        cut = np.flatnonzero(edge)
        start, end = cut[:-1], cut[1:]
        keep = ~white[start] if len(start) else np.zeros(0, bool)
        self.data, self.offsets = data, offsets
        self.start, self.end = start[keep], end[keep]
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        self.per_doc = np.bincount(self.doc, minlength=len(offsets) - 1)
        self.first = np.concatenate([[0], np.cumsum(self.per_doc)])

    def __len__(self) -> int:
        return len(self.start)

    def array(self, data: np.ndarray | None = None) -> pa.LargeBinaryArray:
        """The words as an Arrow array, from data (as long as the texts) instead of their own bytes if given."""
        data = self.data if data is None else data
        size = self.end - self.start
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        inside = np.zeros(len(data) + 1, np.int8)
        np.add.at(inside, self.start, 1)
        np.add.at(inside, self.end, -1)
        kept = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(kept.tobytes())])


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values between each pair of neighbouring offsets."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
