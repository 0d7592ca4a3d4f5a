"""Exact dedup over an extendible-hash index on shared files.

Texts are equal when their bytes are, once ASCII white space is deleted. A first scan writes one narrow
row per document: 64-bit hash key, SHA-256, sizes. Their loads by key prefix size the directory: it
starts at the depth that the total asks for, and every overfull bucket is split by one more bit,
doubling the directory where its own depth is reached. A second scan combines copies inside each task,
so that a text with a third of all rows reaches its bucket once a task; owner tasks then take
consecutive ranges of buckets in key order, chain different texts of one key, compare bytes, and write
the buckets' pages to the shared folder. Documents find their entry by key and SHA-256.

Edge cases: a null text counts as empty, and all empty texts are one group. Null ids lose ties. Rows
that repeat an id and a text are copies of one another; the one written first to the key table stays.
An empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import SPACES, chunks, columns, stored, text_bytes

#: Normalised bytes of different texts that a bucket takes before it is split.
BUCKET_BYTES = 4 << 20
#: Bytes of the buckets that one owner task takes.
OWNER_BYTES = 8 << 20
#: Bytes of texts that a task holds while it combines copies.
COMBINE_BYTES = 48 << 20
#: Bits of a key; a bucket as deep as this is never split.
KEY_BITS = 64

KEYS = "doc_id long, n_points long, n_bytes long, key long, sha binary"
ENTRIES = "owner int, bucket int, key long, body binary, n_points long, doc_id long, copies long"
INDEX = "bucket int, depth int, key long, chain int, sha binary, keep_id long, keep_points long, group_size long"


def normalised(array: pa.Array) -> list[bytes]:
    return [t.translate(None, SPACES) for t in text_bytes(array).to_pylist()]


def hash_key(body: bytes) -> int:
    """XXH64 as a signed 64-bit integer; its top bits address the directory."""
    return xxhash.xxh64_intdigest(body) - (1 << 63)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        bodies = normalised(batch.column("text"))
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id").cast(pa.int64()),
                "n_points": pc.fill_null(pc.utf8_length(batch.column("text")), 0).cast(pa.int64()),
                "n_bytes": pa.array([len(b) for b in bodies], pa.int64()),
                "key": pa.array([hash_key(b) for b in bodies], pa.int64()),
                "sha": pa.array([hashlib.sha256(b).digest() for b in bodies], pa.binary()),
            }
        )


class Directory:
    """Buckets of an extendible-hash index: starts (top bits of each bucket's first key), depths and owners."""

    def __init__(self, leaves: list[tuple[int, int, int]], owner_bytes: int):
        """leaves: (first key prefix at KEY_BITS, local depth, load in bytes), in any order."""
        leaves = sorted(leaves)
        self.depth = max((d for _, d, _ in leaves), default=0)
        self.starts = np.array([s for s, _, _ in leaves], np.uint64)
        self.depths = np.array([d for _, d, _ in leaves], np.int32)
        before = np.concatenate([[0], np.cumsum([n for _, _, n in leaves])[:-1]]) if leaves else np.zeros(0)
        self.owners = (before // owner_bytes).astype(np.int32)
        _, self.owners = np.unique(self.owners, return_inverse=True)
        self.n_owners = int(self.owners.max()) + 1 if len(leaves) else 1

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        """Bucket number of signed keys."""
        return np.searchsorted(self.starts, unsigned(keys), side="right") - 1


def unsigned(keys: np.ndarray) -> np.ndarray:
    return keys.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)


def grow_directory(keys: DataFrame, bucket_bytes: int, owner_bytes: int) -> Directory:
    """Splits overfull buckets until every one is within bucket_bytes or holds one key.

    The driver gets a row for each bucket, i.e. one for about bucket_bytes of different texts."""
    loads = keys.groupBy("key").agg(F.max("n_bytes").alias("n"))
    total = loads.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    depth, full = max(0, int(total // bucket_bytes).bit_length()), None
    leaves: list[tuple[int, int, int]] = []
    while True:
        prefix = F.shiftrightunsigned(F.col("key").bitwiseXOR(F.lit(-(1 << 63))), KEY_BITS - depth) if depth else F.lit(0).cast("long")
        rows = loads.select(prefix.alias("p"), "n")
        if full is not None:
            parents = keys.sparkSession.createDataFrame([(p,) for p in full], "parent long")
            rows = rows.join(parents, F.shiftright("p", 1) == F.col("parent"), "left_semi")
        found = rows.groupBy("p").agg(F.sum("n").alias("n"), F.count("*").alias("m")).collect()
        full = []
        for p, n, m in found:
            if n > bucket_bytes and m > 1 and depth < KEY_BITS - 1:
                full.append(p)
            else:
                leaves.append(((p << (KEY_BITS - depth)) & ((1 << 64) - 1) if depth else 0, depth, n))
        if not full:
            return Directory(leaves, owner_bytes)
        depth += 1


def combiner(directory: Directory, limit: int):
    """A task's copies of a text become one entry; entries leave when their texts exceed limit, those met again last."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0
        for batch in chunks(batches):
            points = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
            for body, n, doc in zip(normalised(batch.column("text")), points, batch.column("doc_id").to_pylist(), strict=True):
                rank = (-n, doc is None, doc)
                if (entry := held.get(body)) is None:
                    held[body] = [rank, 1]
                    size += len(body) + 200
                else:
                    entry[1] += 1
                    if _before(rank, entry[0]):
                        entry[0] = rank
            if size > limit:
                once = {b: e for b, e in held.items() if e[1] == 1}
                if len(once) < len(held) // 2:
                    once = held
                yield from _entries(once, directory)
                held = {} if once is held else {b: e for b, e in held.items() if b not in once}
                size = sum(len(b) + 200 for b in held)
        yield from _entries(held, directory)

    return combine


def _before(a: tuple, b: tuple) -> bool:
    return a[:2] < b[:2] or a[:2] == b[:2] and a[2] is not None and a[2] < b[2]


def _entries(held: dict, directory: Directory) -> Iterator[pa.RecordBatch]:
    items = list(held.items())
    for at in range(0, len(items), 2000):
        part = items[at : at + 2000]
        keys = np.array([hash_key(b) for b, _ in part], np.int64)
        bucket = directory.bucket(keys)
        yield pa.record_batch(
            {
                "owner": pa.array(directory.owners[bucket], pa.int32()),
                "bucket": pa.array(bucket, pa.int32()),
                "key": pa.array(keys, pa.int64()),
                "body": pa.array([b for b, _ in part], pa.binary()),
                "n_points": pa.array([-e[0][0] for _, e in part], pa.int64()),
                "doc_id": pa.array([e[0][2] for _, e in part], pa.int64()),
                "copies": pa.array([e[1] for _, e in part], pa.int64()),
            }
        )


def owning(directory: Directory):
    """Reads entries in key order; texts of one key are chained and told apart by their bytes."""

    def page(key, chain):
        bucket = int(directory.bucket(np.array([key]))[0])
        for slot, (body, entry) in enumerate(chain.items()):
            (negative, _, doc), copies = entry
            yield bucket, int(directory.depths[bucket]), key, slot, hashlib.sha256(body).digest(), doc, -negative, copies

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, chain, out = None, {}, []
        for batch in batches:
            for key, body, n, doc, copies in zip(*(batch.column(c).to_pylist() for c in ("key", "body", "n_points", "doc_id", "copies")), strict=True):
                if key != last:
                    if chain:
                        out.extend(page(last, chain))
                    last, chain = key, {}
                rank = (-n, doc is None, doc)
                if (entry := chain.get(body)) is None:  # a dict finds equal bytes only
                    chain[body] = [rank, copies]
                else:
                    entry[1] += copies
                    if _before(rank, entry[0]):
                        entry[0] = rank
            if len(out) > 5000:
                yield _pages(out)
                out = []
        if chain:
            out.extend(page(last, chain))
        yield _pages(out)

    return own


def _pages(out: list[tuple]) -> pa.RecordBatch:
    kinds = (("bucket", pa.int32()), ("depth", pa.int32()), ("key", pa.int64()), ("chain", pa.int32()), ("sha", pa.binary()), ("keep_id", pa.int64()), ("keep_points", pa.int64()), ("group_size", pa.int64()))
    cols = list(zip(*out, strict=True)) if out else [[]] * len(kinds)
    return pa.record_batch({n: pa.array(list(c), k) for (n, k), c in zip(kinds, cols, strict=True)})


def build_index(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, owner_bytes: int = OWNER_BYTES) -> tuple[DataFrame, DataFrame]:
    """(key table with a row number per document, index pages), both stored in the shared folder."""
    narrow = columns(docs, "doc_id", "text")
    keys = stored(narrow.mapInArrow(_keys, KEYS).withColumn("row", F.monotonically_increasing_id()), "dedup-keys")
    directory = grow_directory(keys, bucket_bytes, owner_bytes)
    entries = narrow.mapInArrow(combiner(directory, COMBINE_BYTES), ENTRIES)
    owned = entries.repartitionById(directory.n_owners, F.col("owner")).sortWithinPartitions("key")
    index = stored(owned.mapInArrow(owning(directory), INDEX), "dedup-index")
    return keys, index


def exact_dedup(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, owner_bytes: int = OWNER_BYTES) -> DataFrame:
    """A row per document: doc_id, keep_id, group_size, kept, text_sha256, repeats (rows with the kept id and text)."""
    keys, index = build_index(docs, bucket_bytes, owner_bytes)
    rows = keys.groupBy("key", "sha", "doc_id", "n_points").agg(F.min("row").alias("keep_row"), F.count("*").alias("repeats"))
    rows = rows.select(F.col("key").alias("k"), F.col("sha").alias("s"), F.col("doc_id").alias("d"), F.col("n_points").alias("p"), "keep_row", "repeats")
    same = (F.col("key") == F.col("k")) & (F.col("sha") == F.col("s")) & F.col("keep_id").eqNullSafe(F.col("d")) & (F.col("keep_points") == F.col("p"))
    entries = index.join(rows, same).select(F.col("key").alias("k"), F.col("sha").alias("s"), "keep_id", "group_size", "keep_row", "repeats")
    found = keys.join(entries, (F.col("key") == F.col("k")) & (F.col("sha") == F.col("s")), "left")
    return found.select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "repeats"
    )


def keep_first(docs: DataFrame, verdict: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns: one of each group, also where ids are null or repeated."""
    heads = verdict.filter("kept").select(F.col("doc_id").alias("__kept"), F.col("text_sha256").alias("__head"))
    if verdict.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return docs.join(heads, docs["doc_id"].eqNullSafe(F.col("__kept")), "left_semi")
    body = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]", "")
    named = docs.withColumn("__sha", F.sha2(body, 256))
    same = (F.col("__sha") == F.col("__head")) & named["doc_id"].eqNullSafe(F.col("__kept"))
    rows = stored(named.join(heads, same, "left_semi").withColumn("__row", F.monotonically_increasing_id()), "dedup-kept")
    points = F.length(F.coalesce("text", F.lit("")))
    first = rows.groupBy("doc_id", "__sha").agg(F.min(F.struct((-points).alias("less"), F.col("__row").alias("row"))).alias("first"))
    kept = rows.join(first.select(F.col("first.row").alias("__first")), F.col("__row") == F.col("__first"), "left_semi")
    return kept.select(*(f"`{c}`" for c in docs.columns))


def op1_exact_dedup(spark, sf_dir) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents),
     g AS (SELECT *, count(*) OVER (PARTITION BY body) AS group_size,
                  first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id) AS keep_id FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256,
       CAST(1 AS BIGINT) AS repeats FROM g
"""
