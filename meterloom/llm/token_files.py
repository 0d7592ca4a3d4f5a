"""Token ids in binary files with Elias-Fano document boundaries.

Documents are dealt into ranges of ascending doc_id; each range becomes one file of blocks: the
concatenated ids, 2 bytes each where the vocabulary allows, and the documents' starts as an Elias-Fano
code: low bits in a packed array, high bits in unary, with a sampled select structure. The i-th start is
found from the code alone, in about 2 + log2(tokens/document) bits a document, and reading the files finds every start so.
The documents' ids ascend in a block and are a second code, counted from the first. A manifest with a row
per file holds where the file begins among all ids, so a file is never moved or rewritten.

Block layout, little-endian: magic "EFTK", version, id width, low bits of starts and of doc ids (1 byte each);
documents n, documents without id z (they come first), first doc id, tokens t (8 bytes each); then for starts and doc ids words of high bits
h and select samples s (8 bytes each); then the low bits packed to 8-byte words, h words of high bits, s samples
(position of every SELECT-th one bit, 8 bytes each) of the starts, the same of the n - z doc ids, and t token ids. Each document
ends with the end id.

Files are written and committed by Spark's own text writer, one block a row, so a lost task leaves no
partial file; the line end it adds after a block is ignored when reading. Files follow by the number in their names.

Edge cases: a null or empty text is the end id alone; null ids come first. Rows of one doc_id follow in the order of a hash of their
texts, as a range may end between them. A very long text is a block of its own. An empty table gives no
block and no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm.bpe import vocabulary_path
from meterloom.llm.common import buffers, checked_broadcast, chunks, columns, scratch, stored, text_bytes
from meterloom.llm.pieces import follows, pieces, ragged

END_ID = 2
MAGIC = b"EFTK"
SELECT = 64
#: Text bytes of a file, about.
FILE_BYTES = 16 << 20
#: Files whose sizes one task of the manifest sums.
GROUP = 1000
#: Text bytes of a block.
BLOCK_BYTES = 4 << 20
#: Text bytes whose distinct pieces are encoded once.
ENCODE_BYTES = 16 << 20
#: Pieces that the library encodes as one text; the time that it takes for a piece grows with the text.
TOGETHER = 200


class EliasFano:
    """A non-decreasing row of whole numbers; select(i) gives the i-th."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        lows = values & np.uint64((1 << low_bits) - 1)
        bits = ((lows[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros((int(ones[-1]) + 64) // 64 * 64 if n else 0, np.uint8)
        unary[ones] = 1
        return cls(n, low_bits, _words(bits), _words(unary), ones[::SELECT].astype(np.int64))

    def select(self, i: int) -> int:
        """The i-th value, by the sample before it and a count of ones in the words that follow."""
        at = int(self.samples[i // SELECT])
        want = i % SELECT
        word = at // 64
        bits = int(self.high[word]) >> (at % 64) << (at % 64)
        while (m := bits.bit_count()) <= want:
            want -= m
            word += 1
            bits = int(self.high[word])
        for _ in range(want):
            bits &= bits - 1
        high = word * 64 + (bits & -bits).bit_length() - 1 - i
        return high << self.low_bits | self._low(i)

    def _low(self, i: int) -> int:
        if not self.low_bits:
            return 0
        word, bit = divmod(i * self.low_bits, 64)
        both = int(self.low[word]) | (int(self.low[word + 1]) << 64 if word + 1 < len(self.low) else 0)
        return both >> bit & ((1 << self.low_bits) - 1)

    def values(self) -> np.ndarray:
        """All values, decoded at once."""
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[: self.n]
        high = ones - np.arange(self.n)
        if not self.low_bits:
            return high
        bits = np.unpackbits(self.low.view(np.uint8), bitorder="little")[: self.n * self.low_bits].reshape(self.n, -1)
        low = (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)
        return high << self.low_bits | low


def _words(bits: np.ndarray) -> np.ndarray:
    whole = np.zeros((len(bits) + 63) // 64 * 64, np.uint8)
    whole[: len(bits)] = bits
    return np.packbits(whole, bitorder="little").view("<u8")


def pack_block(doc_ids: np.ndarray, nulls: int, ids: np.ndarray, starts: np.ndarray, width: int) -> bytes:
    """doc_ids: those of all documents but the first nulls ones, ascending."""
    base = int(doc_ids[0]) if len(doc_ids) else 0
    codes = [EliasFano.build(starts), EliasFano.build(doc_ids.view(np.uint64) - np.array(base).view(np.uint64))]
    head = MAGIC + bytes([2, width, *(c.low_bits for c in codes)])
    sizes = [nulls + len(doc_ids), nulls, base, len(ids), *(len(x) for c in codes for x in (c.high, c.samples))]
    body = b"".join(x.tobytes() for c in codes for x in (c.low, c.high, c.samples.astype("<i8")))
    return head + np.array(sizes, "<i8").tobytes() + body + ids.astype(f"<u{width}").tobytes()


def blocks(content: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray, EliasFano]]:
    """(documents without id, ids of the others, token ids, boundaries) of each block of a file."""
    at = 0
    while at < len(content):
        if content[at : at + 4] != MAGIC or content[at + 4] != 2:
            raise ValueError("not a token file")
        width, low_bits = content[at + 5], content[at + 6 : at + 8]
        n, nulls, base, tokens, *sizes = np.frombuffer(content, "<i8", 8, at + 8).tolist()
        at += 72
        codes = []
        for m, low, high, samples in ((n, low_bits[0], *sizes[:2]), (n - nulls, low_bits[1], *sizes[2:])):
            parts = []
            for size in ((m * low + 63) // 64, high, samples):
                parts.append(np.frombuffer(content, "<u8", size, at))
                at += 8 * size
            codes.append(EliasFano(m, low, parts[0], parts[1], parts[2].astype(np.int64)))
        ids = np.frombuffer(content, f"<u{width}", tokens, at)
        at += tokens * width + 1  # a line end follows
        yield nulls, codes[1].values() + base, ids, codes[0]


def token_count(content: bytes) -> int:
    """Token ids in a file, by the heads of its blocks."""
    at = total = 0
    while at < len(content):
        n, nulls, _, tokens, high, samples, doc_high, doc_samples = np.frombuffer(content, "<i8", 8, at + 8).tolist()
        low = (n * content[at + 6] + 63) // 64 + ((n - nulls) * content[at + 7] + 63) // 64
        at += 72 + 8 * (low + high + samples + doc_high + doc_samples) + tokens * content[at + 5] + 1
        total += tokens
    return total


class Coded:
    """Ids of several texts: those of each distinct piece, and the pieces of each text."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray, index: np.ndarray, counts: np.ndarray):
        """flat: the ids of all distinct pieces, sizes of them each; index: the texts' pieces, counts of them each."""
        self.flat, self.sizes, self.starts, self.index = flat, sizes, np.cumsum(sizes) - sizes, index
        self.first = np.concatenate([[0], np.cumsum(counts)])

    def rows(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts a to b - 1, start of each text's ids and the end of the last)."""
        index = self.index[self.first[a] : self.first[b]]
        size = self.sizes[index]
        bounds = np.concatenate([[0], np.cumsum(size)])[self.first[a : b + 1] - self.first[a]]
        return ragged(self.flat, self.starts[index], size), bounds


class LibraryEncoder:
    """Encodes the distinct pieces of texts by the tokenizers library, many as one text.

    A piece that begins with a space and another character begins a pre-token whatever precedes it, so it may follow any other; the
    ids of the whole are cut by their sizes in bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = set(self.tokenizer.get_added_tokens_decoder())
        names = {i: t for t, i in self.tokenizer.get_vocab().items()}
        self.sizes = np.zeros(max(names) + 1, np.int64)
        for i, name in names.items():
            self.sizes[i] = len(name.encode()) if i in special else len(name)

    def coded(self, data: np.ndarray, offsets: np.ndarray) -> Coded:
        found, counts = pieces(data, offsets)
        coded = found.dictionary_encode()
        raw, edge = buffers(coded.dictionary)
        row, ids = raw.tobytes(), [np.zeros(0, np.uint32)]
        begins = np.concatenate([np.flatnonzero(~follows(raw, edge)), np.arange(0, len(edge) - 1, TOGETHER)])
        cuts = [*edge[np.unique(begins)].tolist(), len(row)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            ids.append(np.array(self.tokenizer.encode_batch_fast([row[a:b].decode()], add_special_tokens=False)[0].ids, np.uint32))
        flat = np.concatenate(ids)
        ends = np.searchsorted(np.cumsum(self.sizes[flat]), edge[1:], side="left") + 1
        return Coded(flat, np.diff(ends, prepend=0), coded.indices.to_numpy(), counts)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, start of each text's ids and the end of the last)."""
        return self.coded(data, offsets).rows(0, len(offsets) - 1)


@lru_cache(maxsize=2)
def library_encoder(path: str) -> tuple[LibraryEncoder, int]:
    """(encoder by the tokenizers library, id width), one a worker and vocabulary."""
    encoder = LibraryEncoder(path)
    return encoder, 2 if encoder.tokenizer.get_vocab_size() <= 1 << 16 else 4


def _packed(path: str | None, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, width = library_encoder(path or vocabulary_path())
        for batch in chunks(batches, limit=ENCODE_BYTES):
            coded, at = encoder.coded(*buffers(text_bytes(batch.column("text")))), 0
            for part in chunks(iter([batch]), limit=BLOCK_BYTES):
                n = part.num_rows
                ids, bounds = coded.rows(at, at + n)
                at += n
                whole = np.full(len(ids) + n, end_id, np.uint32)
                starts = bounds[:-1] + np.arange(n)
                kept = np.ones(len(whole), bool)
                kept[bounds[1:] + np.arange(n)] = False
                whole[kept] = ids
                nulls = part.column("doc_id").null_count
                doc_ids = part.column("doc_id").slice(nulls).to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.record_batch({"block": pa.array([pack_block(doc_ids, nulls, whole, starts, width)], pa.binary())})

    return run


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> None:
    """Files part-*.txt in folder, whose names sort as their documents' ids do."""
    narrow = columns(docs, "doc_id", "text")
    total = narrow.agg(F.coalesce(F.sum(F.octet_length("text") + 8), F.lit(0)).alias("n")).first()["n"]
    ordered = narrow.repartitionByRange(max(1, -(-total // file_bytes)), F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    packed = ordered.mapInArrow(_packed(path, end_id), "block binary")
    packed.select(F.col("block").cast("string").alias("value")).write.text(folder)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, content in zip(batch.column("part").to_pylist(), batch.column("content"), strict=True):
            yield pa.record_batch({"part": pa.array([part], pa.int64()), "n": pa.array([token_count(content.as_buffer().to_pybytes())], pa.int64())})


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for before, content in zip(batch.column("before").to_pylist(), batch.column("content"), strict=True):
            for nulls, doc_ids, ids, code in blocks(content.as_buffer().to_pybytes()):
                edge = [*(code.select(i) for i in range(code.n)), len(ids)]
                starts, row = np.array(edge, np.int64), ids.astype("<u4").tobytes()
                yield pa.record_batch(
                    {
                        "doc_id": pa.array([*[None] * nulls, *doc_ids.tolist()], pa.int64()),
                        "start": pa.array(starts[:-1] + before, pa.int64()),
                        "n_tokens": pa.array(np.diff(starts), pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(row[4 * a : 4 * b]) for a, b in zip(edge, edge[1:], strict=False)], pa.int64()),
                    }
                )
                before += len(ids)


def _files(spark, folder: str) -> DataFrame:
    """part (the number that Spark gave the file), content."""
    files = spark.read.format("binaryFile").load(folder)
    return files.select(part_number("path").alias("part"), "content")


def part_number(path: str) -> Column:
    """A number, as names are padded to five digits only and part-100000 sorts before part-99999."""
    return F.regexp_extract(path, r"/part-(\d+)[^/]*$", 1).cast("long")


def cumulated(sizes: DataFrame) -> DataFrame:
    """part, n, before (ids of all files before it): summed by groups of files, then inside each group."""
    group = F.floor(F.col("part") / GROUP)
    earlier = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    totals = sizes.groupBy(group.alias("group")).agg(F.sum("n").alias("total"))
    totals = totals.select("group", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    rows = sizes.withColumn("group", group).withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return rows.join(totals, "group").select("part", "n", (F.col("ahead") + F.col("inside")).alias("before"))


def manifest(spark, folder: str) -> DataFrame:
    """part, n (ids of the file), before (ids of all files before it); a row per file."""
    return cumulated(stored(_files(spark, folder).mapInArrow(_counted, "part long, n long"), "token-sizes"))


def read_token_files(spark, folder: str) -> DataFrame:
    """A row per document: doc_id, start, n_tokens, ids_crc32, all from the files."""
    before = manifest(spark, folder).select(F.col("part").alias("p"), "before")
    joined = _files(spark, folder).join(checked_broadcast(before), F.col("part") == F.col("p")).select("before", "content")
    return joined.mapInArrow(_listed, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_files(spark, sf_dir) -> DataFrame:
    folder = scratch(spark, "token-files")
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder)
    return read_token_files(spark, folder)
