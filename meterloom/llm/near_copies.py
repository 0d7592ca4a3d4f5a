"""Near copies by the Jaccard similarity of word shingles: every pair at `similarity` or more is linked, no other.

A text's shingles are the distinct runs of `shingle` words (ASCII lower case), or all its words if it has fewer.
Candidates come from two sides, and each is verified on both whole texts, once counts of shingles have ruled out most:

1. SimHash links (simhash_dedup) of the same shingles, and neighbours under the keys of 2. They join most of a
   large group at a cost in proportion to it.
2. Prefix keys: with shingles in any order that is the same for all texts, two texts of n and m shingles at
   similarity s share s/(1+s) (n+m) shingles, so the first that they share stands at most that many places before the end of each.
   Pairs meet under each key that lies in the first n - ceil(s n) + 1 places, unless step 1 has joined them already, or sizes or
   places exclude s: a key that stands too late can't be the first shared one. So no pair is lost. The order is that of hashed shingles
   with those last that a sample of the texts shows to be common: pages of one template meet under its shingles only if those
   stand early, and then they are similar.

A key's rows are those that may be the shorter text (index rows, dealt out by INDEX_ROWS) and all its rows (probes, copied to each deal and
streamed past), so a common key is spread over tasks, each of bounded memory. Keys of one text are dropped in the task that sorts them.

Texts with the same shingles are one node. Of each component of links one row stays: that with the smallest id, rows without id last.

Edge cases: null and empty texts have no shingle and are one node. Very long texts are shingled whole, each by one task. Rows that repeat an id are rows of their own,
told apart by a row number. An empty table gives no rows. Columns other than doc_id and text are only passed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm import simhash_dedup
from meterloom.llm.common import Words, buffers, checked_broadcast, chunks, lower_ascii, parts, stored, text_bytes
from meterloom.llm.components import components
from meterloom.operators.spread import bounded_join

SHINGLE = 5
SIMILARITY = 0.8
#: Texts that are looked at for common shingles: one of so many; and in how many of them a shingle is common.
SAMPLE, COMMON = 8, 25
#: Bound of the list of common shingles.
MOST_COMMON = 200_000
#: Counts by which pairs are ruled out before their texts are fetched: few for all pairs, then more for those left.
SLOTS, FINE = 64, 512
#: Tasks that keys known to be common are sorted by.
SALTS = 64
#: Rows that may be the shorter text, of one key and task.
INDEX_ROWS = 20_000
#: Text bytes handled at a time.
BATCH_BYTES = 1 << 20

#: A row under a key: salt (0 for keys not known to be common), number of shingles, place of the key.
_PLACE, _SIZE = 28, (1 << 28) - 1

_PRIME = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * _MIX
    return (x ^ x >> np.uint64(29)) * np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> list[np.ndarray]:
    """The distinct hashed shingles of each text, sorted."""
    data, offsets = buffers(text_bytes(texts))
    low = lower_ascii(data)
    words = Words(low, offsets)
    code, size = np.zeros(len(words), np.uint64), words.end - words.start
    live = np.arange(len(words))
    for k in range(int(size.max()) if len(size) else 0):
        live = live[size[live] > k]
        code[live] = (code[live] ^ low[words.start[live] + k]) * _PRIME + np.uint64(k)
    code = _mixed(code)
    rows = np.zeros(max(0, len(code) - shingle + 1), np.uint64)
    for k in range(shingle):
        rows = _mixed(rows ^ code[k : k + len(rows)])
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= shingle:
            out.append(np.unique(rows[a : b - shingle + 1]))
        else:
            one = np.zeros(min(1, b - a), np.uint64)
            for k in range(a, b):
                one = _mixed(one ^ code[k])
            out.append(one)
    return out


def slots(codes: np.ndarray, width: int = SLOTS) -> bytes:
    """How many shingles fall into each of width slots, 255 at most: two texts' counts differ by no more than their shingles do."""
    return np.minimum(np.bincount((codes >> np.uint64(40)).astype(np.int64) % width, minlength=width), 255).astype(np.uint8).tobytes()


def _possible(similarity: float, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(f"slots_{c}").to_pylist()), np.uint8).reshape(-1, width).astype(np.int16) for c in "ab")
            total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            good = np.abs(a - b).sum(axis=1) <= total * (1 - similarity) / (1 + similarity) + 1e-6
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


def _marked(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=BATCH_BYTES):
            sets = shingle_sets(batch.column("text"), shingle)
            first = np.array([x.sum(dtype=np.uint64) for x in sets], np.uint64)
            second = np.array([_mixed(x).sum(dtype=np.uint64) for x in sets], np.uint64)
            prints = simhash_dedup.fingerprints(batch.column("text"), shingle)
            cols = {k: pa.array(v.view(np.int64)) for k, v in (("s1", first), ("s2", second), ("fp", prints))}
            sizes = pa.array([len(x) for x in sets], pa.int64())
            yield pa.record_batch({"row": batch.column("row"), "id": batch.column("id")} | cols | {"n": sizes, "slots": pa.array([slots(x) for x in sets], pa.binary()), "fine": pa.array([slots(x, FINE) for x in sets], pa.binary())})

    return run


def _shingled(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=1 << 20):
            sets = shingle_sets(batch.column("text"), shingle)
            yield pa.record_batch({"key": pa.array(np.concatenate(sets).view(np.int64))})

    return run


def prefix(codes: np.ndarray, common: np.ndarray, similarity: float) -> np.ndarray:
    """The shingles under which a text meets others; codes: sorted."""
    n = len(codes)
    late = np.isin(codes, common, assume_unique=True)
    return np.concatenate([codes[~late], codes[late]])[: n - int(np.ceil(similarity * n - 1e-9)) + 1]


def needed(n: np.ndarray, m: np.ndarray, similarity: float) -> np.ndarray:
    """Shingles that texts of n and m must share, less a rounding error."""
    return similarity / (1 + similarity) * (n + m) - 1e-6


def _keys(shingle: int, similarity: float, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=BATCH_BYTES):
            sets = shingle_sets(batch.column("text"), shingle)
            keys = [prefix(x, shared.value, similarity) for x in sets]
            sizes = [len(x) for x in keys]
            row = np.repeat(batch.column("row").to_numpy(), sizes)
            n = np.repeat(np.array([len(x) for x in sets], np.int64), sizes)
            place = np.concatenate([np.arange(x) for x in sizes])
            flat = np.concatenate(keys)
            salt = np.where(np.isin(flat, shared.value), row % SALTS + 1, 0)
            yield pa.record_batch({"key": pa.array(flat.view(np.int64)), "cell": pa.array(salt << 2 * _PLACE | n << _PLACE | place), "row": pa.array(row)})

    return run


def _fit(left: np.ndarray, right: np.ndarray, similarity: float) -> np.ndarray:
    """Whether texts that share a key first in these cells may be similar."""
    n, m = left >> _PLACE & _SIZE, right >> _PLACE & _SIZE
    return np.minimum(n - (left & _SIZE), m - (right & _SIZE)) >= needed(n, m, similarity)


def _met(similarity: float):
    """Rows sorted by key and cell: those of keys that others have too, with the row before and the first under the key if they may be similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = tuple(np.zeros(0, np.int64) for _ in range(3))
        head, joined = (0, 0), False  # cell and row of the first under the last key; whether the held row has one before it

        def out(key, cell, row, same, heads) -> pa.RecordBatch:
            at = np.flatnonzero(same[:-1] | same[1:] | (cell >> 2 * _PLACE > 0))
            before = np.maximum(at - 1, 0)
            cols = {"key": pa.array(key[at]), "cell": pa.array(cell[at]), "row": pa.array(row[at])}
            for name, cells, rows in (("before", cell[before], row[before]), ("head", heads[0][at], heads[1][at])):
                good = same[at] & (rows != row[at]) & _fit(cells, cell[at], similarity)
                cols[name] = pa.array(rows, mask=~good)
            return pa.record_batch(cols)

        for batch in batches:
            if not batch.num_rows:
                continue
            key, cell, row = (np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("key", "cell", "row"), strict=True))
            group = cell >> 2 * _PLACE
            same = np.concatenate([[joined], (key[1:] == key[:-1]) & (group[1:] == group[:-1])])
            start = np.maximum.accumulate(np.where(same, -1, np.arange(len(key))))
            heads = [np.where(start < 0, old, x[start]) for old, x in zip(head, (cell, row), strict=True)]
            last = len(key) - 1
            if last:
                yield out(key[:last], cell[:last], row[:last], same, [x[:last] for x in heads])
            held, head, joined = (key[last:], cell[last:], row[last:]), (heads[0][last], heads[1][last]), bool(same[last])
        if len(held[0]):
            yield out(*held, np.array([joined, False]), [np.array([x]) for x in head])

    return run


def _meeting(similarity: float):
    """Pairs of different components under a key: its index rows come first and are held, its probes stream past."""

    def pairs(index: list[np.ndarray], probes: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        cell, row, root = index
        p_cell, p_row, p_root = probes
        size, p_size = cell >> _PLACE & _SIZE, p_cell >> _PLACE & _SIZE
        low, high = np.searchsorted(size, similarity * p_size - 1e-6), np.searchsorted(size, p_size, side="right")
        total = np.cumsum(high - low)
        at = 0
        while at < len(p_cell):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + (1 << 20), side="right")))
            count = (high - low)[at:to]
            right = np.repeat(np.arange(at, to), count)
            left = np.arange(len(right)) - np.repeat(np.cumsum(count) - count - low[at:to], count)
            good = (root[left] != p_root[right]) & ((size[left] < p_size[right]) | (row[left] < p_row[right]))
            left, right = left[good], right[good]
            good = _fit(cell[left], p_cell[right], similarity)
            yield row[left[good]], p_row[right[good]]
            at = to

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, index, found, count = None, [], [], 0

        def flushed() -> pa.RecordBatch:
            a, b = (np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
            both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            return _pairs(both[0], both[1])

        for batch in batches:
            key, deal, probe, *cols = (batch.column(c).to_numpy() for c in ("key", "deal", "probe", "cell", "row", "root"))
            new = (key[1:] != key[:-1]) | (deal[1:] != deal[:-1]) | (probe[1:] != probe[:-1])
            edge = [0, *(np.flatnonzero(new) + 1).tolist(), len(key)]
            for a, b in zip(edge, edge[1:], strict=False):
                if a == b:
                    continue
                if (now := (key[a], deal[a])) != group:
                    group, index = now, []
                some = [c[a:b] for c in cols]
                if not probe[a]:
                    index = [np.concatenate(x) for x in zip(index, some, strict=True)] if index else some
                elif index:
                    for x in pairs(index, some):
                        found.append(x)
                        count += len(x[0])
                        if count > 200_000 or len(found) > 5000:
                            yield flushed()
                            found, count = [], 0
        yield flushed()

    return run


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})


def _similar(shingle: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(iter([whole]), "text_a", 1 << 20):
                both = [shingle_sets(batch.column(c), shingle) for c in ("text_a", "text_b")]
                good = np.zeros(batch.num_rows, bool)
                for i, (x, y) in enumerate(zip(*both, strict=True)):
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    good[i] = same >= similarity * (len(x) + len(y) - same) - 1e-9
                yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


def verified(pairs: DataFrame, marked: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of rows whose whole texts are similar enough; only texts of pairs that their counts allow are moved."""
    joined = pairs.filter("a < b").distinct()
    for column, width in (("slots", SLOTS), ("fine", FINE)):
        for side in ("a", "b"):
            marks = marked.select(F.col("row").alias(f"{side}_row"), F.col("n").alias(f"n_{side}"), F.col(column).alias(f"slots_{side}"))
            joined = joined.join(marks, F.col(side) == F.col(f"{side}_row"))
        joined = joined.select("a", "b", "n_a", "n_b", "slots_a", "slots_b").mapInArrow(_possible(similarity, width), "a long, b long")
        joined = stored(joined, "near-possible")
    rows = stored(joined.select(F.col("a").alias("r")).union(joined.select("b")).distinct(), "near-rows")
    texts = texts.join(checked_broadcast(rows), F.col("row") == F.col("r"), "left_semi")
    for side in ("a", "b"):
        joined = joined.join(texts.select(F.col("row").alias(f"{side}_row"), F.col("text").alias(f"text_{side}")), F.col(side) == F.col(f"{side}_row"))
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(_similar(shingle, similarity), "a long, b long")


def _meetings(labelled: DataFrame, similarity: float, index_rows: int) -> DataFrame:
    """(a, b): pairs of rows of different components that a key lets be similar; labelled: key, cell, row, root."""
    size, place = F.shiftright("cell", _PLACE), F.col("cell").bitwiseAND(F.lit(_SIZE))
    shorter = size - place >= 2 * similarity / (1 + similarity) * size - 1e-6
    keys = labelled.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.when(shorter, 1)).alias("n"))
    keys = stored(keys.filter("low != high and n > 0").select("key", F.ceil(F.col("n") / index_rows).alias("deals")), "near-common-keys")
    open_rows = bounded_join(labelled, keys, ["key"], salt_by=["row"])
    index = open_rows.filter(shorter).withColumn("deal", F.pmod(F.xxhash64("row"), "deals")).withColumn("probe", F.lit(0))
    probes = open_rows.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1))).withColumn("probe", F.lit(1))
    both = index.unionByName(probes).select("key", "deal", "probe", "cell", "row", "root")
    return both.repartition(parts(both), "key", "deal").sortWithinPartitions("key", "deal", "probe", "cell").mapInArrow(_meeting(similarity), "a long, b long")


def near_copies(texts: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, index_rows: int = INDEX_ROWS) -> DataFrame:
    """(row, id, root): a row per row of texts (row, id, text); root: a row number, the same in a component."""
    marked = stored(texts.mapInArrow(_marked(shingle), "row long, id long, s1 long, s2 long, fp long, n long, slots binary, fine binary"), "near-marks")
    nodes = stored(marked.groupBy("s1", "s2").agg(F.min("row").alias("node")), "near-nodes")
    same = marked.select("row", "id", "s1", "s2", "fp").join(nodes.select(F.col("s1").alias("t1"), F.col("s2").alias("t2"), "node"), (F.col("s1") == F.col("t1")) & (F.col("s2") == F.col("t2")))
    same = stored(same.select("row", "id", "node", "fp"), "near-same")
    twins = checked_broadcast(same.filter("row != node").select(F.col("row").alias("twin")))
    own = texts.join(twins, F.col("row") == F.col("twin"), "left_anti")
    some = own.filter(F.pmod(F.xxhash64("row"), F.lit(SAMPLE)) == 0).mapInArrow(_shingled(shingle), "key long")
    counts = stored(some.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") >= COMMON), "near-common")
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    rare = counts.filter(F.col("n") >= max(COMMON, total // MOST_COMMON)).select("key").toArrow()
    common = np.sort(rare.column("key").to_numpy().view(np.uint64))
    shared = texts.sparkSession.sparkContext.broadcast(common)
    keys = own.mapInArrow(_keys(shingle, similarity, shared), "key long, cell long, row long")
    dealt = keys.repartition(parts(keys), "key", F.shiftright("cell", 2 * _PLACE)).sortWithinPartitions("key", "cell", "row")
    met = stored(dealt.mapInArrow(_met(similarity), "key long, cell long, row long, before long, head long"), "near-met")

    heads = same.filter("row = node").groupBy("fp").agg(F.min("row").alias("head"))
    equal = same.filter("row = node").join(heads.select(F.col("fp").alias("f"), "head"), F.col("fp") == F.col("f")).select(F.col("head").alias("a"), F.col("row").alias("b"))
    links = simhash_dedup.links(marked)
    hx, hy = (heads.select(F.col("fp").alias(f"f{c}"), F.col("head").alias(f"h{c}")) for c in "xy")
    links = links.join(hx, F.col("x") == F.col("fx")).join(hy, F.col("y") == F.col("fy")).select(F.least("hx", "hy").alias("a"), F.greatest("hx", "hy").alias("b"))
    first = equal.unionByName(links)
    for other in ("before", "head"):
        first = first.unionByName(met.filter(f"{other} is not null").select(F.least("row", other).alias("a"), F.greatest("row", other).alias("b")))
    found = stored(verified(first, marked, texts, shingle, similarity), "near-links")
    roots = components(found).withColumnRenamed("root", "r")
    labelled = met.select("key", "cell", "row").join(roots, F.col("row") == F.col("node"), "left")
    labelled = stored(labelled.select("key", F.col("cell").bitwiseAND(F.lit((1 << 2 * _PLACE) - 1)).alias("cell"), "row", F.coalesce("r", "row").alias("root")), "near-labelled")
    rest = stored(verified(_meetings(labelled, similarity, index_rows), marked, texts, shingle, similarity), "near-links")
    if not rest.isEmpty():
        roots = components(found.unionByName(rest)).withColumnRenamed("root", "r")
    roots = roots.select(F.col("node").alias("m"), "r")
    return same.join(roots, F.col("node") == F.col("m"), "left").select("row", "id", F.coalesce("r", "node").alias("root"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each component, with all its columns: that with the smallest id, or the first where none has an id."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")  # so that no name can clash
    numbered = stored(docs.select(whole, F.monotonically_increasing_id().alias("row")), "near-docs")
    texts = numbered.select("row", F.col("doc.doc_id").cast("long").alias("id"), F.col("doc.text").alias("text"))
    found = near_copies(texts, shingle, similarity)
    heads = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("head"), F.count("*").alias("n")).filter("n > 1")
    heads = heads.select(F.col("root").alias("r"), F.col("head.row").alias("kept")).repartition(parts(found))  # so that Spark may split a large component
    lost = found.join(heads, (F.col("root") == F.col("r")) & (F.col("row") != F.col("kept")))
    lost = checked_broadcast(stored(lost.select(F.col("row").alias("lost")), "near-lost"))
    kept = numbered.join(lost, F.col("row") == F.col("lost"), "left_anti")
    return kept.select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))
