"""SimHash near-dedup with pivot distance tables.

A fingerprint is made of each whole text. Equal fingerprints are one node. Each distinct fingerprint
gets its Hamming distances to PIVOTS reference fingerprints, once. Two fingerprints within `radius` bits
agree on at least one of radius + 1 blocks of bits, so pairs meet only under a block's value; a block
with too many fingerprints is cut by radius + 1 blocks of its remaining bits, again and again, which
loses no pair. Under a key, pairs whose distances to any pivot differ by more than the radius are
discarded (triangle inequality), and the survivors are verified by counting differing bits. A key gives
a spanning forest of its links instead of all of them: components stay the same.

Edge cases: null and empty texts have fingerprint zero, linked like any other. Rows that repeat an id
are rows of their own. Null ids lie in a component as others; it is named by its smallest id that isn't
null. An empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import Words, buffers, chunks, columns, lower_ascii, parts, stored, text_bytes
from meterloom.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
PIVOTS = 24
#: Fingerprints under one key beyond which the key is lengthened.
KEY_ROWS = 400


def fingerprints(texts: pa.Array, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """64-bit SimHash of each whole text."""
    data, offsets = buffers(text_bytes(texts))
    words = Words(lower_ascii(data), offsets)
    n_docs = len(offsets) - 1
    size = words.end - words.start
    # words joined by one space each; starts in that row
    start = np.concatenate([[0], np.cumsum(size + 1)])
    joined = np.full(int(start[-1]), 32, np.uint8)
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, words.start, 1)
    np.add.at(inside, words.end, -1)
    target = np.ones(len(joined), bool)
    target[start[1:] - 1] = False
    joined[target] = words.data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    row = joined.tobytes()
    out = np.zeros(n_docs, np.uint64)
    digest = xxhash.xxh64_intdigest
    for doc in range(n_docs):
        a, b = int(words.first[doc]), int(words.first[doc + 1])
        if a == b:
            continue
        k = min(shingle, b - a)
        total, seen = np.zeros(64, np.int64), 0
        for at in range(a, b - k + 1, 100_000):
            to = min(at + 100_000, b - k + 1)
            begins, ends = start[at:to].tolist(), (start[at + k : to + k] - 1).tolist()
            h = np.array([digest(row[i:j], seed) for i, j in zip(begins, ends, strict=True)], np.uint64)
            total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            seen += len(h)
        bits = (2 * total > seen).astype(np.uint8)
        out[doc] = np.packbits(bits, bitorder="little").view(np.uint64)[0]
    return out


def _fingerprinted(shingle: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id").cast(pa.int64()), "fp": pa.array(fingerprints(batch.column("text"), shingle, seed).view(np.int64))}
            )

    return run


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: fixed, pseudo-random."""
    return np.array([xxhash.xxh64_intdigest(i.to_bytes(4, "little"), 7) for i in range(n)], np.uint64)


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pivot distances of each fingerprint, a byte each."""
    refs = pivots()
    for batch in batches:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        table = np.bitwise_count(fp[:, None] ^ refs[None, :]).astype(np.uint8)
        yield pa.record_batch({"fp": batch.column("fp"), "far": pa.array([r.tobytes() for r in table], pa.binary())})


def cut(mask: int, blocks: int) -> list[int]:
    """The set bits of mask dealt into blocks masks of neighbouring bits, the sizes as equal as can be."""
    bits = [i for i in range(64) if mask >> i & 1]
    edges = [round(k * len(bits) / blocks) for k in range(blocks + 1)]
    return [sum(1 << i for i in bits[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _lengthen(rows: DataFrame, radius: int) -> DataFrame:
    """A row for each block of the bits outside mask; mask and part are those of the longer key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, fps = batch.column("mask").to_numpy().view(np.uint64), batch.column("fp").to_numpy().view(np.uint64)
            for mask in np.unique(masks):
                rows = np.flatnonzero(masks == mask)
                for block in cut(~int(mask) & ((1 << 64) - 1), radius + 1):
                    longer = np.uint64(int(mask) | block)
                    yield pa.record_batch(
                        {
                            "mask": pa.array(np.full(len(rows), longer).view(np.int64)),
                            "part": pa.array((fps[rows] & longer).view(np.int64)),
                            "fp": pa.array(fps[rows].view(np.int64)),
                            "far": batch.column("far").take(pa.array(rows)),
                        }
                    )

    return rows.mapInArrow(run, "mask long, part long, fp long, far binary")


def keyed(nodes: DataFrame, radius: int, limit: int) -> DataFrame:
    """(mask, part, fp, far): every pair within the radius shares a (mask, part); no such key has more than limit rows unless its bits are used up."""
    left = _lengthen(nodes.select(F.lit(0).cast("long").alias("mask"), "fp", "far"), radius)
    done = None
    for _ in range(12):
        left = stored(left, "simhash-keys")
        sizes = left.groupBy("mask", "part").agg(F.count("*").alias("n")).filter(F.col("n") > limit)
        sizes = stored(sizes.select(F.col("mask").alias("m"), F.col("part").alias("p")), "simhash-large")
        match = (F.col("mask") == F.col("m")) & (F.col("part") == F.col("p"))
        if sizes.isEmpty():
            return left if done is None else done.unionByName(left)
        small = left.join(sizes, match, "left_anti")
        done = small if done is None else done.unionByName(small)
        left = _lengthen(left.join(sizes, match, "left_semi"), radius)
    return done.unionByName(left)


def forest(fps: np.ndarray, far: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (each node once, to the one that found it) that connect what links within the radius connect."""
    order = np.argsort(far[:, 0], kind="stable")
    fps, far = fps[order], far[order].astype(np.int16)
    free = np.ones(len(fps), bool)
    links = []
    for root in range(len(fps)):
        if not free[root]:
            continue
        free[root] = False
        queue = [root]
        while queue:
            i = queue.pop()
            a, b = np.searchsorted(far[:, 0], [far[i, 0] - radius, far[i, 0] + radius + 1])
            near = a + np.flatnonzero(free[a:b])
            for at in range(1, far.shape[1], 4):
                if not len(near):
                    break
                near = near[(np.abs(far[near, at : at + 4] - far[i, at : at + 4]) <= radius).all(axis=1)]
            near = near[np.bitwise_count(fps[near] ^ fps[i]) <= radius]
            free[near] = False
            links += [(int(fps[i]), int(fps[j])) for j in near]
            queue += near.tolist()
    return links


def _links(radius: int):
    def close(mask, part, rows):
        fps = np.array(rows[0], np.int64).view(np.uint64)
        if len(fps) < 2:
            return []
        far = np.frombuffer(b"".join(rows[1]), np.uint8).reshape(len(fps), -1)
        return forest(fps, far, radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; a key's rows are gathered and left again."""
        key, rows, out = None, ([], []), []
        for batch in batches:
            mask, part, fp = (batch.column(c).to_numpy() for c in ("mask", "part", "fp"))
            far = batch.column("far").to_pylist()
            edge = np.flatnonzero((mask[1:] != mask[:-1]) | (part[1:] != part[:-1])) + 1
            for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(fp)], strict=True):
                if a == b:
                    continue
                if (now := (mask[a], part[a])) != key:
                    out += close(*(key or (0, 0)), rows)
                    key, rows = now, ([], [])
                rows[0].extend(fp[a:b].tolist())
                rows[1].extend(far[a:b])
            if len(out) > 10_000:
                yield _pairs(out)
                out = []
        out += close(*(key or (0, 0)), rows)
        yield _pairs(out)

    return run


def _pairs(out: list[tuple[int, int]]) -> pa.RecordBatch:
    found = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.record_batch({"x": pa.array(found[:, 0]), "y": pa.array(found[:, 1])})


def links(marked: DataFrame, radius: int = RADIUS, key_rows: int = KEY_ROWS) -> DataFrame:
    """(x, y): fingerprints within the radius, enough of them to connect what all of them connect; marked: fp."""
    nodes = marked.select("fp").distinct().mapInArrow(_tables, "fp long, far binary")
    rows = keyed(nodes, radius, key_rows)
    return rows.repartition(parts(rows), "mask", "part").sortWithinPartitions("mask", "part").mapInArrow(_links(radius), "x long, y long")


def simhash_dedup(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED, key_rows: int = KEY_ROWS) -> DataFrame:
    """A row per document: doc_id, fingerprint (hex), component_id."""
    marked = stored(columns(docs, "doc_id", "text").mapInArrow(_fingerprinted(shingle, seed), "doc_id long, fp long"), "simhash")
    roots = components(links(marked, radius, key_rows))
    labels = marked.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots, F.col("fp") == F.col("node"), "left")
    labels = labels.select("fp", F.coalesce("root", "fp").alias("root"), "least")
    named = labels.groupBy("root").agg(F.min("least").alias("component_id")).select(F.col("root").alias("r"), "component_id")
    named = named.repartition(parts(named))  # both sides of the join are then exchanged for it, and Spark splits a large component
    labels = labels.join(named, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component_id")
    found = marked.join(labels, F.col("fp") == F.col("f"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_simhash_dedup(spark, sf_dir) -> DataFrame:
    return simhash_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
