"""Repeated substrings of `length` bytes, by difference-cover samples and suffix buckets.

The suffixes that could begin a repeated string are found by a sample first. D is a perfect difference
cover modulo V: the offsets of any two positions meet D together at some shift below V. So where two
strings of `length` bytes are equal, some sampled suffix of one and the same one of the other share
their first length - V + 1 bytes. Pass 1 compares only the samples, by 48-bit keys: they go to buckets by
range, and a bit a key comes back: tied or not. A suffix without a tied sample in reach begins no
repeated string; a false tie only costs it a place in pass 2.

Pass 2 decides about the others exactly. A suffix's bucket is drawn from the least hash of a GRAM-byte string
in its first `length` bytes, so equal strings share a bucket, and neighbours mostly share it too: a block sends a
stretch of neighbouring suffixes as one piece of text. A bucket holds whole texts of its suffixes; it
orders them by a hash and compares the bytes of each with the first of its equals, stretch by stretch. Hashes only say
what to compare, and where one collides, its suffixes are told apart by their bytes.
That is a departure from a suffix array: suffixes are ordered by hash and not by rank, and long ties are
resolved by bytes and not by ranks of the sample, as such ranks need the samples' bytes in one order first.

Pieces that repeat in a block are sent once. A bucket with more suffixes than it should hold (a line that very many
texts share in different surroundings) is split by a hash of the whole string. Memory is
bounded by a block of texts (BLOCK_BYTES, or one text) and by a bucket.

Edge cases: null and empty texts have no byte; texts shorter than `length` keep all; a very long text is one
block. Matches never cross documents and may overlap, in one text too. Rows that repeat an id are texts of
their own. An empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import checked_broadcast, chunks, columns, scratch, stored, text_bytes
from meterloom.llm.pieces import ragged

LENGTH = 200
#: A perfect difference cover: every difference modulo 133 is that of two elements (fixed values of the cover for 11).
V = 133
COVER = (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)
BLOCK_BYTES = 8 << 20
#: Text bytes a bucket of sample keys stands for.
KEY_BYTES = 16 << 20
#: Suffixes that a bucket of pass 2 stands for; one with twice as many is split.
BUCKET_BYTES = 4 << 20
#: Bytes of the strings whose least hash chooses a suffix's bucket.
GRAM = 64
SLICE = 1 << 19
#: Longest length that hashes are tabled for.
LONGEST = 4096
SAMPLE_BITS = 48


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mixing table of bytes, powers of the base, powers of its inverse), modulo 2^64."""
    table = np.frombuffer(b"".join(hashlib.blake2b(bytes([i]), digest_size=8).digest() for i in range(256)), np.uint64)
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    out = [table]
    for factor in (base, inverse):
        power = np.full(SLICE + LONGEST, factor, np.uint64)
        power[0] = 1
        out.append(np.cumprod(power))
    return tuple(out)


def window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of data[i : i + size] for each i where it fits; at most SLICE + LONGEST - 1 bytes."""
    table, power, inverse = _powers()
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * power[: len(data)], out=total[1:])
    n = len(data) - size + 1
    mixed = (total[size:] - total[:n]) * inverse[:n]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return mixed


def hashes_at(data: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """window_hashes at the given ascending places only, slice by slice."""
    out = np.zeros(len(places), np.uint64)
    for begin in range(0, len(data), SLICE):
        a, b = np.searchsorted(places, [begin, begin + SLICE])
        if a < b:
            found = window_hashes(data[begin : begin + SLICE + size - 1], size)
            out[a:b] = found[places[a:b] - begin]
    return out


def samples(offsets: np.ndarray, size: int) -> np.ndarray:
    """Places of the sampled suffixes that have size bytes left in their text, ascending."""
    inside = np.zeros(V, bool)
    inside[list(COVER)] = True
    out = []
    for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False):
        if b - a >= size:
            n = b - a - size + 1
            out.append(a + np.flatnonzero(np.resize(inside, n)))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def candidates(places: np.ndarray, tied: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """Suffixes with length bytes left and a tied sample at a shift below V, in the same text."""
    at = places[tied]
    doc = np.searchsorted(offsets, at, side="right") - 1
    mark = np.zeros(int(offsets[-1]) + 1, np.int16)  # at most V at a place
    np.add.at(mark, np.maximum(at - V + 1, offsets[doc]), 1)
    np.add.at(mark, at + 1, -1)
    found = np.flatnonzero(np.cumsum(mark[:-1], dtype=np.int16) > 0)
    end = offsets[np.searchsorted(offsets, found, side="right")]
    return found[end - found >= length]


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct keys as gaps, byte plane by byte plane, compressed."""
    gaps = np.diff(keys, prepend=keys[:1] * np.uint64(0))
    return struct.pack("<q", len(keys)) + zstandard.compress(gaps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack_keys(row: bytes) -> np.ndarray:
    (n,) = struct.unpack_from("<q", row)
    planes = np.frombuffer(zstandard.decompress(row[8:], max_output_size=8 * n), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents packed to blocks; a block's number is its task's and its place in it."""
    task, number = TaskContext.get().partitionId(), 0
    ids, sizes, texts, held = [], [], [], 0

    def block():
        row = zstandard.compress(b"".join(t for t in texts), 3)
        return pa.record_batch(
            {
                "block": pa.array([task << 32 | number], pa.int64()),
                "ids": pa.array([ids], pa.list_(pa.int64())),
                "sizes": pa.array([sizes], pa.list_(pa.int64())),
                "data": pa.array([row], pa.binary()),
            }
        )

    for batch in chunks(batches):
        bodies = text_bytes(batch.column("text")).to_pylist()
        for doc, body in zip(batch.column("doc_id").to_pylist(), bodies, strict=True):
            if texts and held + len(body) > BLOCK_BYTES:
                yield block()
                number += 1
                ids, sizes, texts, held = [], [], [], 0
            ids.append(doc)
            sizes.append(len(body))
            texts.append(body)
            held += len(body)
    if texts:
        yield block()


def _opened(batch: pa.RecordBatch, i: int) -> tuple[int, np.ndarray, np.ndarray]:
    sizes = np.array(batch.column("sizes")[i].values, np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    row = zstandard.decompress(batch.column("data")[i].as_buffer().to_pybytes(), max_output_size=max(1, int(offsets[-1])))
    return batch.column("block")[i].as_py(), np.frombuffer(row, np.uint8), offsets


def _bucketed(block: int, keys: np.ndarray, n_buckets: int) -> Iterator[pa.RecordBatch]:
    """The block's distinct keys by bucket (range of the keys), a row a bucket."""
    keys = np.unique(keys)
    edges = bucket_edges(keys, n_buckets)
    some = np.flatnonzero(np.diff(edges))
    for at in range(0, len(some), 64):
        part = some[at : at + 64]
        yield pa.record_batch(
            {
                "bucket": pa.array(part, pa.int32()),
                "block": pa.array(np.full(len(part), block), pa.int64()),
                "keys": pa.array([pack_keys(keys[edges[k] : edges[k + 1]]) for k in part.tolist()], pa.binary()),
            }
        )


def bucket_edges(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Where each bucket's keys begin among sorted keys, and their end."""
    inner = np.array([(k << 64) // n_buckets for k in range(1, n_buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, inner), [len(keys)]])


def _sample_keys(length: int, n_buckets: int):
    size = length - V + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, data, offsets = _opened(batch, i)
                yield from _bucketed(block, _sampled(data, samples(offsets, size), size), n_buckets)

    return run


def _sampled(data: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Keys of samples: the top SAMPLE_BITS bits, as a false tie only costs a suffix in pass 2."""
    low = np.uint64(64 - SAMPLE_BITS)
    return hashes_at(data, places, size) >> low << low


def _repeated_in(keys: np.ndarray) -> np.ndarray:
    """Distinct keys that occur twice or more, sorted."""
    keys = np.sort(keys)
    return np.unique(keys[1:][keys[1:] == keys[:-1]])


def _tied(table: pa.Table) -> pa.Table:
    """A bucket: all blocks' keys are sorted, and each block gets a bit per key: whether another block has it."""
    blobs = [unpack_keys(x.as_buffer().to_pybytes()) for x in table.column("keys")]
    shared = _repeated_in(np.concatenate(blobs))
    bits = [np.packbits(_among(keys, shared)).tobytes() for keys in blobs]
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})


def _among(keys: np.ndarray, some: np.ndarray) -> np.ndarray:
    if not len(some):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(some, keys)
    return some[np.minimum(at, len(some) - 1)] == keys


def answers(keys: np.ndarray, replies: dict[int, bytes], n_buckets: int) -> np.ndarray:
    """For each key of a block, whether it occurs anywhere else: in another block by the replies, or in its own."""
    order = np.argsort(keys)
    row = keys[order]
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    own = row[first]
    edges = bucket_edges(own, n_buckets)
    tied = np.diff(np.append(np.flatnonzero(first), len(row))) > 1
    for bucket, bits in replies.items():
        a, b = int(edges[bucket]), int(edges[bucket + 1])
        tied[a:b] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
    out = np.empty(len(row), bool)
    out[order] = tied[np.cumsum(first) - 1]
    return out


def _replied(batch: pa.RecordBatch, i: int, column: str) -> dict[int, bytes]:
    rows = batch.column(column)[i].as_py() or []
    return {r["bucket"]: r["bits"] for r in rows}


def _candidates(data, offsets, replies, length, size, n_buckets) -> np.ndarray:
    places = samples(offsets, size)
    tied = answers(_sampled(data, places, size), replies, n_buckets)
    return candidates(places, tied, offsets, length)


def minima(data: np.ndarray, length: int) -> np.ndarray:
    """The least hash of a GRAM-byte string in data[i : i + length], for each i where it fits."""
    least = np.empty(len(data) - GRAM + 1, np.uint32)
    for begin in range(0, len(least), SLICE):
        row = data[begin : begin + SLICE + GRAM - 1]
        least[begin : begin + SLICE] = window_hashes(row, GRAM) >> np.uint64(32)
    width, have, n = length - GRAM + 1, 1, len(data) - length + 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    return np.minimum(least[:n], least[width - have : width - have + n])


class Stretches:
    """A block's candidate suffixes as pieces of text: neighbours of one bucket together, repeated pieces once.

    count: suffixes of each stretch, in the order of found; which: its piece; texts, bucket: of each piece; order: pieces by bucket."""

    def __init__(self, data: np.ndarray, found: np.ndarray, length: int, n_buckets: int):
        if len(found):
            least = minima(data, length)[found]
            cut = np.ones(len(found), bool)
            cut[1:] = (np.diff(found) != 1) | (least[1:] != least[:-1])
            at = np.flatnonzero(cut)
            mixed = least[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
            buckets = (mixed * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)
        else:
            at = buckets = np.zeros(0, np.int64)
        self.length = length
        self.count = np.diff(np.append(at, len(found)))
        begin, row, seen = found[at], data.tobytes(), {}
        ends = begin + self.count + length - 1
        self.which = np.fromiter((seen.setdefault(row[a:b], len(seen)) for a, b in zip(begin.tolist(), ends.tolist(), strict=True)), np.int64, len(at))
        self.texts = list(seen)
        self.bucket = np.zeros(len(seen), np.int64)
        self.bucket[self.which] = buckets
        self.order = np.argsort(self.bucket, kind="stable")

    def buckets(self) -> Iterator[tuple[int, np.ndarray]]:
        """(bucket, its pieces) in ascending order."""
        row = self.bucket[self.order]
        edges = np.flatnonzero(np.diff(row, prepend=-1, append=-1)) if len(row) else np.zeros(0, np.int64)
        for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
            yield int(row[a]), self.order[a:b]

    def tied(self, replies: list[dict]) -> np.ndarray:
        """For each candidate, whether its string starts anywhere else."""
        by_bucket: dict[int, list[dict]] = {}
        for r in replies:
            by_bucket.setdefault(r["bucket"], []).append(r)
        windows = np.array([len(t) - self.length + 1 for t in self.texts], np.int64)
        start = np.zeros(len(windows), np.int64)
        start[self.order] = np.cumsum(windows[self.order]) - windows[self.order]
        flat, at = np.zeros(int(windows.sum()), bool), 0
        for bucket, members in self.buckets():
            n = int(windows[members].sum())
            own = flat[at : at + n]
            rows = by_bucket[bucket]
            if rows[0]["subs"] == 1:
                own[:] = np.unpackbits(np.frombuffer(rows[0]["bits"], np.uint8), count=n)
            else:
                sub = sub_buckets(whole_windows([self.texts[k] for k in members.tolist()], self.length)[2], rows[0]["subs"])
                for r in rows:
                    mine = np.flatnonzero(sub == r["sub"])
                    own[mine] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=len(mine))
            at += n
        twice = np.bincount(self.which, minlength=len(windows)) > 1
        return ragged(flat, start[self.which], self.count) | np.repeat(twice[self.which], self.count)


def pack_pieces(texts: list[bytes]) -> bytes:
    return zstandard.compress(np.array([len(texts), *map(len, texts)], "<i8").tobytes() + b"".join(texts), 1)


def unpack_pieces(row: bytes) -> tuple[bytes, np.ndarray]:
    """(the pieces one after the other, the size of each)."""
    whole = zstandard.decompress(row)
    (n,) = struct.unpack_from("<q", whole)
    return whole[8 * n + 8 :], np.frombuffer(whole, "<i8", n, 8)


def places_in(sizes: np.ndarray, length: int) -> np.ndarray:
    """Starts of all strings of length bytes in pieces that follow each other."""
    count = sizes - length + 1
    shift = (np.cumsum(sizes) - sizes) - (np.cumsum(count) - count)
    return np.repeat(shift, count) + np.arange(int(count.sum()))


def whole_windows(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts of all strings of length bytes in the pieces, their hashes)."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    places = places_in(np.array([len(t) for t in texts], np.int64), length)
    return data, places, hashes_at(data, places, length)


def sub_buckets(hashes: np.ndarray, subs: int) -> np.ndarray:
    return (hashes % np.uint64(subs)).astype(np.int64)


def equal_strings(data: np.ndarray, places: np.ndarray, hashes: np.ndarray, length: int) -> np.ndarray:
    """Whether the string of length bytes at each (ascending) place is at another place too, by its bytes.

    Each is compared with the first of its hash; where neighbours' partners are neighbours, the bytes they share once."""
    n = len(places)
    order = np.argsort(hashes)
    row = hashes[order]
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if n else np.zeros(0, np.int64)
    del row
    size = np.diff(np.append(first, n))
    tied = np.zeros(n, bool)
    if not n or size.max() == 1:
        return tied
    partner = np.empty(n, np.int64)
    partner[order] = np.repeat(np.minimum.reduceat(order, first), size)
    tied[order] = np.repeat(size > 1, size)
    del order
    later = np.flatnonzero(partner != np.arange(n))
    a, b = places[later], places[partner[later]]
    begin = np.flatnonzero(np.concatenate([[True], (np.diff(a) != 1) | (np.diff(b) != 1)]))
    run = np.diff(np.append(begin, len(a)))
    spread = run + length - 1
    ends, done, wrong = np.cumsum(spread), 0, []
    while done < len(run):
        to = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + SLICE, side="right")))
        x, y = (_ranges(side[begin[done:to]], spread[done:to]) for side in (a, b))
        unequal = data[x] != data[y]
        if unequal.any():
            # a string differs if any of its bytes does; strings of a run begin at its first bytes
            bad = np.concatenate([[0], np.cumsum(unequal)])
            starts = np.cumsum(spread[done:to]) - spread[done:to]
            at = _ranges(starts, run[done:to])
            wrong.append(int(begin[done]) + np.flatnonzero(bad[at + length] > bad[at]))
        done = to
    if wrong:
        _regroup(data, places, partner, later[np.concatenate(wrong)], length, tied)
    return tied


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... size[i] of them, for all i."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _regroup(data: np.ndarray, places: np.ndarray, partner: np.ndarray, wrong: np.ndarray, length: int, tied: np.ndarray) -> None:
    """Sets tied anew for all strings that share a hash with one that differs from the first of it."""
    members = np.flatnonzero(np.isin(partner, np.unique(partner[wrong])))
    seen: dict[bytes, int] = {}
    which = [seen.setdefault(data[p : p + length].tobytes(), len(seen)) for p in places[members].tolist()]
    tied[members] = (np.bincount(which) > 1)[which]


def _pieces(length: int, n_keys: int, n_buckets: int):
    size = length - V + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, data, offsets = _opened(batch, i)
                found = _candidates(data, offsets, _replied(batch, i, "samples"), length, size, n_keys)
                stretches = Stretches(data, found, length, n_buckets)
                for bucket, members in stretches.buckets():
                    texts = [stretches.texts[k] for k in members.tolist()]
                    yield pa.record_batch(
                        {
                            "bucket": pa.array([bucket], pa.int32()),
                            "block": pa.array([block], pa.int64()),
                            "n": pa.array([sum(map(len, texts)) - len(texts) * (length - 1)], pa.int64()),
                            "pieces": pa.array([pack_pieces(texts)], pa.binary()),
                        }
                    )

    return run


def _split(length: int):
    """Rows of a split bucket dealt to its subs by a hash of the whole string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                bucket, subs, block = (batch.column(c)[i].as_py() for c in ("bucket", "subs", "block"))
                body, sizes = unpack_pieces(batch.column("pieces")[i].as_buffer().to_pybytes())
                places = places_in(sizes, length)
                sub_of = sub_buckets(hashes_at(np.frombuffer(body, np.uint8), places, length), subs)
                for sub, pieces in _dealt(body, places, sub_of, length):
                    yield pa.record_batch(
                        {
                            "bucket": pa.array([bucket], pa.int32()),
                            "sub": pa.array([sub], pa.int32()),
                            "subs": pa.array([subs], pa.int32()),
                            "block": pa.array([block], pa.int64()),
                            "pieces": pa.array([pieces], pa.binary()),
                        }
                    )

    return run


def _dealt(body: bytes, places: np.ndarray, sub: np.ndarray, length: int) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(sub, kind="stable")
    row, at = sub[order], places[order]
    cut = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (np.diff(at) != 1)]))
    last = np.append(cut[1:], len(at)) - 1
    edges = np.append(np.flatnonzero(np.diff(row[cut], prepend=-1)), len(cut))
    for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
        texts = [body[x : y + length] for x, y in zip(at[cut[a:b]].tolist(), at[last[a:b]].tolist(), strict=True)]
        yield int(row[cut[a]]), pack_pieces(texts)


def _compared(length: int):
    """A bucket: each block gets a bit per suffix: whether its string is anywhere else in the bucket."""

    def run(table: pa.Table) -> pa.Table:
        opened = [unpack_pieces(x.as_buffer().to_pybytes()) for x in table.column("pieces")]
        sizes = [s for _, s in opened]
        n = [int(s.sum()) - len(s) * (length - 1) for s in sizes]
        data = np.frombuffer(b"".join(body for body, _ in opened), np.uint8)
        del opened
        places = places_in(np.concatenate(sizes), length)
        tied = equal_strings(data, places, hashes_at(data, places, length), length)
        edge = np.concatenate([[0], np.cumsum(n)]).tolist()
        bits = [np.packbits(tied[a:b]).tobytes() for a, b in zip(edge, edge[1:], strict=False)]
        return table.select(["block", "bucket", "sub", "subs"]).append_column("bits", pa.array(bits, pa.binary()))

    return run


def spans(again: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(whether each byte is covered by a string that begins at again, begins and ends of the maximal runs in a text)."""
    mark = np.zeros(int(offsets[-1]) + 1, np.int16)  # at most length at a place, and length < 2^15
    mark[again] += 1
    mark[again + length] -= 1
    gone = np.cumsum(mark[:-1], dtype=np.int16) > 0
    edge = np.ones(len(gone) + 1, bool)
    edge[1:-1] = gone[1:] != gone[:-1]
    edge[offsets] = True
    cut = np.flatnonzero(edge)
    inside = gone[cut[:-1]] if len(gone) else np.zeros(0, bool)
    return gone, cut[:-1][inside], cut[1:][inside]


def _removed(length: int, n_keys: int, n_buckets: int):
    size = length - V + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, data, offsets = _opened(batch, i)
                found = _candidates(data, offsets, _replied(batch, i, "samples"), length, size, n_keys)
                again = found[Stretches(data, found, length, n_buckets).tied(batch.column("ties")[i].as_py() or [])]
                gone, begin, end = spans(again, offsets, length)
                cut = np.searchsorted(begin, offsets)
                removed = np.concatenate([[0], np.cumsum(end - begin)])[cut]
                shas = []
                for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False):
                    shas.append(hashlib.sha256(data[a:b][~gone[a:b]].tobytes()).hexdigest())
                yield pa.record_batch(
                    {
                        "doc_id": pa.array(batch.column("ids")[i].values, pa.int64()),
                        "n_bytes": pa.array(np.diff(offsets), pa.int64()),
                        "n_removed": pa.array(np.diff(removed), pa.int64()),
                        "n_spans": pa.array(np.diff(cut), pa.int64()),
                        "kept_sha256": pa.array(shas, pa.string()),
                        "span_starts": pa.array([(begin[a:b] - o).tolist() for a, b, o in zip(cut, cut[1:], offsets, strict=False)], pa.list_(pa.int64())),
                        "span_ends": pa.array([(end[a:b] - o).tolist() for a, b, o in zip(cut, cut[1:], offsets, strict=False)], pa.list_(pa.int64())),
                    }
                )

    return run


def _placed(blocks: DataFrame, n: int) -> DataFrame:
    """The blocks written to the shared folder as a table bucketed by block, so that joins by block shuffle only their other side."""
    spark, path = blocks.sparkSession, scratch(blocks.sparkSession, "substring-blocks")
    name = "substring_blocks_" + path.rpartition("-")[2]
    blocks.write.bucketBy(n, "block").option("path", path).saveAsTable(name)
    return spark.table(name)


def _sampled_ties(keys: DataFrame) -> DataFrame:
    """Sample keys to their buckets and the answers of each block in one row: (b, samples)."""
    tied = keys.groupBy("bucket").applyInArrow(_tied, "block long, bucket int, bits binary")
    replies = tied.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("samples"))
    return stored(replies.withColumnRenamed("block", "b"), "substring-samples")


def _ties(pieces: DataFrame, length: int, bucket_bytes: int) -> DataFrame:
    """Pieces to their buckets, those with too many suffixes split, and the answers of each block in one row: (b, ties)."""
    pieces = stored(pieces, "substring-pieces")
    # a string that is alone in a sub costs all its bytes, a suffix in a stretch about four
    subs = F.ceil(F.col("n") * (length / 4) / bucket_bytes).cast("int")
    hot = pieces.groupBy("bucket").agg(F.sum("n").alias("n")).filter(F.col("n") > 2 * bucket_bytes).select(F.col("bucket").alias("h"), subs.alias("subs"))
    rows = pieces.join(checked_broadcast(hot), F.col("bucket") == F.col("h"), "left").select("bucket", "block", F.coalesce("subs", F.lit(1)).alias("subs"), "pieces")
    whole = rows.filter("subs = 1").select("bucket", F.lit(0).alias("sub"), "subs", "block", "pieces")
    dealt = whole.union(rows.filter("subs > 1").mapInArrow(_split(length), "bucket int, sub int, subs int, block long, pieces binary"))
    tied = dealt.groupBy("bucket", "sub").applyInArrow(_compared(length), "block long, bucket int, sub int, subs int, bits binary")
    replies = tied.groupBy("block").agg(F.collect_list(F.struct("bucket", "sub", "subs", "bits")).alias("ties"))
    return stored(replies.withColumnRenamed("block", "b"), "substring-ties")


def repeated_substrings(docs: DataFrame, length: int = LENGTH, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """A row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, span_starts, span_ends (bytes)."""
    if not V < length <= LONGEST:
        raise ValueError(f"length must be over {V}, the cover's period, and at most {LONGEST}")
    narrow = columns(docs, "doc_id", "text")
    total = narrow.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = _placed(narrow.mapInArrow(_blocks, "block long, ids array<long>, sizes array<long>, data binary"), max(8, 2 * total // BLOCK_BYTES))
    n_keys, n_buckets = max(1, -(-total // KEY_BYTES)), max(1, -(-total // bucket_bytes))
    samples_of = _sampled_ties(blocks.mapInArrow(_sample_keys(length, n_keys), "bucket int, block long, keys binary"))
    sampled = blocks.join(samples_of, F.col("block") == F.col("b"), "left").drop("b")
    pieces = sampled.mapInArrow(_pieces(length, n_keys, n_buckets), "bucket int, block long, n long, pieces binary")
    both = sampled.join(_ties(pieces, length, bucket_bytes), F.col("block") == F.col("b"), "left").drop("b")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, span_starts array<long>, span_ends array<long>"
    return both.mapInArrow(_removed(length, n_keys, n_buckets), schema)


def op10_substring_dedup(spark, sf_dir) -> DataFrame:
    found = repeated_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
