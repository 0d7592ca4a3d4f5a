"""Byte-level BPE by speculation and verification.

Each distinct word of a batch gets tokens by greedy longest match, all words at once along a trie. A row
of tokens is what the merges give exactly when every token is what its own bytes merge to and every
adjacent pair is compatible: undoing the later merge of the two again and again, no merge across
the border would have come first. The pairs of all words are tested at once in numpy; only words with
a failing pair are merged step by step. Decoding gathers the tokens' bytes.

Edge cases: a null text counts as empty and has no ids. The special token's string becomes its id, as in
the tokenizers library. Decoded bytes that are no UTF-8 become replacement characters. Documents with
equal ids are rows of their own; an empty table gives no rows. Columns other than doc_id and text are
not read by the query; `encode_column` keeps all columns of its input.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from meterloom.llm.common import buffers, chunks, columns, text_bytes
from meterloom.llm.pieces import SPECIAL, Encoder, ragged

#: The byte-level pre-tokenizer's pattern (fixed value of the public vocabulary).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

NEVER = 1 << 40

#: Text bytes encoded at a time, and distinct pieces that a task remembers.
BATCH_BYTES = 2 << 20
REMEMBERED = 100_000

#: Failing words of up to so many bytes are merged many at once, the others one by one.
SHORT = 32


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Lookup:
    """Whole numbers to whole numbers, vectorised; absent keys give `absent`."""

    def __init__(self, keys, values, absent: int):
        keys, values = np.asarray(keys, np.int64), np.asarray(values, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.values, self.absent = np.append(keys[order], np.iinfo(np.int64).max), np.append(values[order], absent), absent

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.values[at], self.absent)


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        vocab = spec["model"]["vocab"]
        raw = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        raw |= {i: t for t, i in self.special.items()}
        n = max(raw) + 1
        self.n = n
        self.rank = np.full(n, -1, np.int64)
        self.left, self.right = np.arange(n), np.arange(n)
        pairs, ranks = [], []
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            self.left[z], self.right[z], self.rank[z] = x, y, rank
            pairs.append(x * n + y)
            ranks.append(rank)
            self.merge[x, y] = rank, z
        self.merged = np.array([vocab["".join(p.split(" ") if isinstance(p, str) else p)] for p in spec["model"]["merges"]], np.int64)
        self.pair_rank = Lookup(pairs, ranks, NEVER)
        self.byte_id = np.array([vocab[c] for c, _ in sorted(letters.items(), key=lambda p: p[1])], np.int64)
        tokens = [raw.get(i, b"") for i in range(n)]
        self.token_size = np.array([len(t) for t in tokens], np.int64)
        self.token_start = np.cumsum(self.token_size) - self.token_size
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        merged = np.flatnonzero(self.rank >= 0)
        merged = merged[np.argsort(self.rank[merged])]
        self.sound = np.ones(n, bool)
        fits = self.compatible(self.left[merged], self.right[merged], self.rank[merged])
        for t, ok in zip(merged.tolist(), fits.tolist(), strict=True):
            self.sound[t] = ok and self.sound[self.left[t]] and self.sound[self.right[t]]
        self._trie([(t, i) for i, t in enumerate(tokens) if t and t not in self.special])
        self.words = regex.compile(PATTERN)

    def _trie(self, tokens: list[tuple[bytes, int]]) -> None:
        step, ends, nodes = {}, {}, 1
        for token, i in tokens:
            at = 0
            for b in token:
                nxt = step.get(at << 8 | b)
                if nxt is None:
                    nxt = step[at << 8 | b] = nodes
                    nodes += 1
                at = nxt
            ends[at] = i
        self.step = Lookup(list(step), list(step.values()), -1)
        self.ends = np.full(nodes, -1, np.int64)
        self.ends[list(ends)] = list(ends.values())

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | int = NEVER) -> np.ndarray:
        """Whether no merge across the border of a and b comes before those inside them; limit: the rank at which the pair itself ends."""
        a, b = np.array(a), np.array(b)
        limit = np.broadcast_to(np.asarray(limit, np.int64), a.shape).copy()
        fits = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            bad = self.pair_rank(x * self.n + y) < limit[live]
            fits[live[bad]] = False
            ra, rb = self.rank[x], self.rank[y]
            go = ~bad & ((ra >= 0) | (rb >= 0))
            live, x, y, ra, rb = live[go], x[go], y[go], ra[go], rb[go]
            first = ra > rb
            a[live] = np.where(first, self.right[x], x)
            b[live] = np.where(first, y, self.left[y])
            limit[live] = np.where(first, ra, rb + 1)  # of equal pairs the left one merges first
        return fits

    def propose(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens by greedy longest match, their number per word)."""
        cursor, live = start.copy(), np.arange(len(start))
        found, owner = [], []
        while len(live):
            node, at = np.zeros(len(live), np.int64), cursor[live].copy()
            best, best_at = self.byte_id[data[at]], at + 1
            walk = np.arange(len(live))
            while len(walk):
                node[walk] = self.step(node[walk] << 8 | data[at[walk]])
                walk = walk[node[walk] >= 0]
                at[walk] += 1
                token = self.ends[node[walk]]
                hit = walk[token >= 0]
                best[hit], best_at[hit] = token[token >= 0], at[hit]
                walk = walk[at[walk] < end[live[walk]]]
            found.append(best)
            owner.append(live)
            cursor[live] = best_at
            live = live[best_at < end[live]]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        tokens, owners = np.concatenate(found), np.concatenate(owner)
        return tokens[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(start))

    def exact(self, word: bytes) -> list[int]:
        """Merges by rank, leftmost first; a heap of pairs, so that long words take n log n steps."""
        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := self.merge.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, x, y, z = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j >= n or ids[j] != y:
                continue
            ids[i], ids[j] = z, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if m := self.merge.get((z, ids[after[i]])):
                    heapq.heappush(heap, (m[0], i, z, ids[after[i]], m[1]))
            if before[i] >= 0 and (m := self.merge.get((ids[before[i]], z))):
                heapq.heappush(heap, (m[0], before[i], ids[before[i]], z, m[1]))
        return [t for t in ids if t >= 0]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words that aren't empty, as little-endian unsigned 32-bit integers."""
        size = np.array([len(w) for w in words], np.int64)
        end = np.cumsum(size)
        tokens, counts = self.propose(np.frombuffer(b"".join(words), np.uint8), end - size, end)
        stop = np.cumsum(counts)
        fails = np.zeros(len(words), bool)
        owner = np.repeat(np.arange(len(words)), counts)
        fails[owner[~self.sound[tokens]]] = True
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique(tokens[inner] * self.n + tokens[inner + 1], return_inverse=True)
        fits = self.compatible(pairs // self.n, pairs % self.n)
        fails[owner[inner[~fits[back]]]] = True
        row = tokens.astype("<u4").tobytes()
        out = [row[4 * a : 4 * b] for a, b in zip((stop - counts).tolist(), stop.tolist(), strict=True)]
        failing = np.flatnonzero(fails)
        for i in failing[size[failing] > SHORT].tolist():
            out[i] = np.array(self.exact(words[i]), "<u4").tobytes()
        short = failing[size[failing] <= SHORT]
        for at in range(0, len(short), 20_000):
            some = short[at : at + 20_000]
            for i, ids in zip(some.tolist(), self.exact_short([words[i] for i in some.tolist()]), strict=True):
                out[i] = ids
        return out

    def exact_short(self, words: list[bytes]) -> list[bytes]:
        """exact() of many short words at once: each round merges the leftmost pair of least rank of every word."""
        size = np.array([len(w) for w in words], np.int64)
        wide = int(size.max())
        ids = np.full((len(words), wide + 1), -1, np.int64)
        ids[np.arange(wide + 1) < size[:, None]] = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        rank = np.full((len(words), wide), NEVER, np.int64)
        both = np.arange(wide) < size[:, None] - 1
        rank[both] = self.pair_rank((ids[:, :-1] * self.n + ids[:, 1:])[both])
        live = np.arange(len(words))
        while len(live):
            at = rank[live].argmin(axis=1)
            least = rank[live, at]
            go = least < NEVER
            live, at, least = live[go], at[go], least[go]
            if not len(live):
                break
            cols = np.arange(wide)
            shift = cols[None, :] > at[:, None]
            row, score = ids[live], rank[live]
            row[:, :-1] = np.where(shift, row[:, 1:], row[:, :-1])
            score[:, :-1] = np.where(shift[:, :-1], score[:, 1:], score[:, :-1])
            score[:, -1] = NEVER
            k = np.arange(len(live))
            row[k, at] = self.merged[least]
            row[:, -1] = -1
            after = row[k, at + 1]
            score[k, at] = np.where(after >= 0, self.pair_rank(row[k, at] * self.n + after), NEVER)
            has = np.flatnonzero(at > 0)
            score[has, at[has] - 1] = self.pair_rank(row[has, at[has] - 1] * self.n + row[has, at[has]])
            ids[live], rank[live] = row, score
        counts = (ids >= 0).sum(axis=1)
        flat, stop = ids[ids >= 0].astype("<u4").tobytes(), np.cumsum(counts)
        return [flat[4 * a : 4 * b] for a, b in zip((stop - counts).tolist(), stop.tolist(), strict=True)]

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        split = []
        for piece in pieces:
            if SPECIAL in piece:
                parts = piece.split(SPECIAL)
                words = []
                for k, part in enumerate(parts):
                    words += [w.encode() for w in self.words.findall(part.decode())]
                    if k < len(parts) - 1:
                        words.append(SPECIAL)
            else:
                words = self.words.findall(piece.decode())
                words = [piece] if len(words) == 1 else [w.encode() for w in words]
            split.append(words)
        distinct = list({w: None for words in split for w in words if w not in self.special})
        ids = dict(zip(distinct, self.encode_words(distinct), strict=True)) if distinct else {}
        ids |= {w: np.array([i], "<u4").tobytes() for w, i in self.special.items()}
        return [b"".join([ids[w] for w in words]) for words in split]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The UTF-8 bytes of each row of ids, bounds being their starts and the end of the last."""
        size = self.token_size[ids]
        row = ragged(self.token_bytes, self.token_start[ids], size).tobytes()
        edge = np.concatenate([[0], np.cumsum(size)])[bounds].tolist()
        return [valid(row[a:b]) for a, b in zip(edge, edge[1:], strict=False)]


def valid(row: bytes) -> bytes:
    try:
        row.decode()
        return row
    except UnicodeDecodeError:
        return row.decode(errors="replace").encode()


@lru_cache(maxsize=2)
def load(path: str) -> tuple[Bpe, Encoder]:
    """One a worker and vocabulary."""
    model = Bpe(path)
    return model, Encoder(model.encode_pieces, REMEMBERED)


def _digests(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, encoder = load(path or vocabulary_path())
        encoder.forget()  # what the worker's last task left
        for batch in chunks(batches, limit=BATCH_BYTES):
            ids, bounds = encoder(*buffers(text_bytes(batch.column("text"))))
            row, edge = ids.astype("<u4").tobytes(), bounds.tolist()
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(row[4 * a : 4 * b]).hexdigest() for a, b in zip(edge, edge[1:], strict=False)], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in model.decode(ids, bounds)], pa.string()),
                }
            )
        encoder.forget()

    return run


def encode_column(docs: DataFrame, column: str = "text", into: str = "ids", path: str | None = None) -> DataFrame:
    """docs with an array of token ids beside its own columns; into replaces a column of that name."""
    from pyspark.sql import types as T

    kept = docs.drop(into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder = load(path or vocabulary_path())
        for batch in chunks(batches, column):
            ids, bounds = encoder(*buffers(text_bytes(batch.column(column))))
            rows = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, rows], names=[*batch.schema.names, into])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(into, T.ArrayType(T.IntegerType()))]))


def decode_column(docs: DataFrame, column: str = "ids", into: str = "decoded", path: str | None = None) -> DataFrame:
    """docs with the text of an array of token ids beside its own columns; a null array gives an empty text."""
    from pyspark.sql import types as T

    kept = docs.drop(into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, _ = load(path or vocabulary_path())
        for batch in batches:
            rows = [np.array(x or [], np.int64) for x in batch.column(column).to_pylist()]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int64)
            texts = model.decode(np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64), bounds)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([t.decode() for t in texts], pa.string())], names=[*batch.schema.names, into])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(into, T.StringType())]))


def bpe_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """A row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return columns(docs, "doc_id", "text").mapInArrow(_digests(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3_bpe_roundtrip(spark, sf_dir) -> DataFrame:
    return bpe_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
