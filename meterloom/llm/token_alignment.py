"""Alignment of two tokenizers by an associative monoid of fragments.

Space+text is encoded by a byte-level BPE (A) and, as the text to which it adds that space, by a piece BPE with byte fallback (B). The
byte offsets where tokens of both end are borders; they cut the tokens into groups. A fragment is what a range of bytes
yields by the tokens that end in it: an open prefix (up to its first border), closed groups, and an open suffix; without a border
all of it is open. Two neighbours compose into one fragment, and suffix and prefix close a group between them; this is associative, so
that fragments are reduced in any bracketing: those of a short text in its task, those of a text above PART bytes by a tree of Spark
tasks, FAN ranges at a time. The tree moves open ends only; a group is written out where it closes.

Long texts are cut for encoding where a single space precedes a character that is no white space: A's pre-tokenizer always cuts there,
and B's vocabulary has no piece with a space after another character (checked), so that both encode the parts as the whole.
Ranges of bytes for fragments are cut without regard to that. The pieces between such cuts are what is encoded: each distinct one once for
ENCODE_BYTES of texts, some hundreds as one text, or its halves where the ids' bytes differ from it.

Links are the pairs of tokens that end at a border. Of two tokens that end together one's bytes end with the other's, so there are at
most as many id pairs as the tokens of both vocabularies have bytes (`pair_bound`, some 500,000 here) whatever the corpus; counts are
summed in the cluster, and the table of that proven size is broadcast to score each document's links.

Edge cases: null and empty texts, and those whose joined A or B bytes differ from space+text (a U+2581 in the text), have no tokens: zeros, and an empty
groups_sha256; their links count nowhere. Special tokens' strings are plain text. A very long text without a single space is encoded by one task,
as neither library cuts it. Repeated rows and null or repeated ids are rows of their own. An empty table gives no rows. Columns other than doc_id and text are
not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.bpe import _byte_letters, vocabulary_path
from meterloom.llm.common import buffers, chunks, columns, parts, read_table, stored
from meterloom.llm.pieces import _STARTS, ragged
from meterloom.operators.spread import bounded_join

BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"

#: Texts above so many bytes are encoded in parts, by several tasks.
PART = 64 << 10
#: Bytes of a fragment's range.
CHUNK = 16 << 10
#: Ranges composed in one task at each level of the tree.
FAN = 64
#: Text bytes whose distinct pieces are encoded once, and text bytes aligned at a time.
ENCODE_BYTES = 8 << 20
BATCH_BYTES = 1 << 20
#: Pieces that the libraries encode as one text.
TOGETHER = 200


class Side:
    """The bytes of a tokenizer's tokens."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def counts(self, ids: np.ndarray, row: bytes, stops: np.ndarray) -> np.ndarray | None:
        """Number of ids of each piece of row (they end at stops); None if the ids' bytes aren't row or a token crosses a stop."""
        size = self.size[ids]
        if size.sum() != len(row) or ragged(self.flat, self.start[ids], size).tobytes() != row:
            return None
        ends = np.cumsum(size)
        upto = np.searchsorted(ends, stops)
        return np.diff(upto + 1, prepend=0) if (ends[upto] == stops).all() else None


class Coded(NamedTuple):
    """Ids of distinct pieces by one tokenizer: all, each piece's first, their number."""

    flat: np.ndarray
    start: np.ndarray
    size: np.ndarray

    def ids(self, index: np.ndarray) -> np.ndarray:
        return ragged(self.flat, self.start[index], self.size[index]).astype(np.int64)


class Pair:
    """Two tokenizers and their tokens' bytes."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        letters = _byte_letters()
        names = self.a.get_vocab()
        special = set(self.a.get_added_tokens_decoder())
        self.a_tokens = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.a_tokens[i] = name.encode() if i in special else bytes(letters[c] for c in name)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("texts can't be cut at spaces: a piece has a space after another character")
        self.b_tokens = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        self.spaced = "▁" in pieces  # then B never gives back the bytes of this character, it stands for a space
        self.sides = Side(self.a_tokens), Side(self.b_tokens)
        self.a_size, self.b_size = (x.size for x in self.sides)
        self.code = np.dtype("<u4" if len(self.a_tokens) * len(self.b_tokens) <= 1 << 32 else "<u8")

    def _both(self, row: bytes, stops: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """(ids, their number in each piece of row) by A and by B; None if one of them doesn't give the pieces' bytes."""
        text = row.decode()
        found = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(text[1:])
        ids = [np.array(x, np.int64) for x in found]
        if len(stops) == 1:  # without arrays, as short texts may have most of their pieces alone
            good = row == b"".join([self.a_tokens[i] for i in found[0]]) == b"".join([self.b_tokens[i] for i in found[1]])
            return [(x, np.array([len(x)])) for x in ids] if good else None
        counts = [side.counts(x, row, stops) for side, x in zip(self.sides, ids, strict=True)]
        return None if counts[0] is None or counts[1] is None else [*zip(ids, counts, strict=True)]

    def coded(self, raw: np.ndarray, edge: np.ndarray) -> tuple[Coded, Coded, np.ndarray]:
        """(A's ids of pieces that begin with a space, raw cut at edge; B's; whether both give the piece's bytes).

        Many are encoded as one text; if that doesn't give their bytes, its halves are. Those with U+2581 are not encoded."""
        row, n = raw.tobytes(), len(edge) - 1
        start, size = edge[:-1], np.diff(edge)
        joins = size > 1  # to what stands before
        joins[joins] = _STARTS[raw[start[joins] + 1]]
        joins[1:] &= raw[start[1:] - 1] != 32
        good = np.ones(n, bool)
        if self.spaced:
            marks = np.flatnonzero((raw[:-2] == 0xE2) & (raw[1:-1] == 0x96) & (raw[2:] == 0x81))
            good[np.searchsorted(edge, marks, side="right") - 1] = False
            joins &= good
            joins[1:] &= good[:-1]
        begins = [*np.unique(np.concatenate([np.flatnonzero(~joins), np.arange(0, n, TOGETHER)])).tolist(), n]
        none = [(np.zeros(0, np.int64), np.zeros(1, np.int64))] * 2
        found = []
        runs = [*zip(begins, begins[1:], strict=False)][::-1]
        while runs:
            i, j = runs.pop()
            got = self._both(row[edge[i] : edge[j]], edge[i + 1 : j + 1] - edge[i]) if good[i] else None
            if not got and j - i > 1:
                runs += [((i + j) // 2, j), (i, (i + j) // 2)]
                continue
            good[i] &= got is not None  # a run of several pieces is good here
            found.append(got or none)
        sides = []
        for side in (0, 1):
            number = np.concatenate([x[side][1] for x in found])
            sides.append(Coded(np.concatenate([x[side][0].astype("<u4") for x in found]), np.cumsum(number) - number, number))
        return sides[0], sides[1], good

    def pair_bound(self) -> int:
        """No corpus links more id pairs: of two tokens that end together one is an end of the other."""
        return int(self.a_size.sum() + self.b_size.sum())


@lru_cache(maxsize=2)
def load(byte_path: str, piece_path: str) -> Pair:
    return Pair(byte_path, piece_path)


def cuts(data: np.ndarray) -> np.ndarray:
    """Whether both tokenizers cut before each byte, whatever surrounds it."""
    edge = np.zeros(len(data), bool)
    edge[1:-1] = (data[1:-1] == 32) & (data[:-2] != 32) & _STARTS[data[2:]]
    return edge


class Fragment(NamedTuple):
    """Tokens that end in a range of bytes. first: where the piece of text with the first border begins; closed: its groups as text, if one piece."""

    at: int
    borders: int
    first: int
    prefix_a: np.ndarray
    prefix_b: np.ndarray
    suffix_a: np.ndarray
    suffix_b: np.ndarray
    closed: bytes = b""

    def then(self, other: Fragment, groups: list[tuple[int, bytes]]) -> Fragment:
        """The two composed; a group that they close is added to groups, with the place of its border."""
        borders = self.borders + other.borders
        if not self.borders:
            opened = np.concatenate([self.prefix_a, other.prefix_a]), np.concatenate([self.prefix_b, other.prefix_b])
            return Fragment(self.at, borders, other.first, *opened, other.suffix_a, other.suffix_b)
        middle = np.concatenate([self.suffix_a, other.prefix_a]), np.concatenate([self.suffix_b, other.prefix_b])
        if not other.borders:
            return Fragment(self.at, borders, self.first, self.prefix_a, self.prefix_b, *middle)
        groups.append((other.first, rendered(*middle)))
        return Fragment(self.at, borders, self.first, self.prefix_a, self.prefix_b, other.suffix_a, other.suffix_b)


def rendered(a: np.ndarray, b: np.ndarray) -> bytes:
    return f"{','.join(map(str, a.tolist()))}|{','.join(map(str, b.tolist()))}".encode()


def fold(fragments: Sequence[Fragment]) -> tuple[Fragment, list[tuple[int, bytes]]]:
    """Neighbours composed, and the groups closed between them with their places."""
    groups: list[tuple[int, bytes]] = []
    whole = fragments[0]
    for other in fragments[1:]:
        whole = whole.then(other, groups)
    return whole, groups


def ordered_texts(fragments: Sequence[Fragment]) -> list[bytes]:
    """All groups of a whole text, in order: a fragment's first, which closes at its first border, before those inside it."""
    whole, groups = fold(fragments)
    if whole.borders:
        groups.append((whole.first, rendered(whole.prefix_a, whole.prefix_b)))
    texts = [(place, 0, text) for place, text in groups] + [(f.at, 1, f.closed) for f in fragments if f.closed]
    return [x[2] for x in sorted(texts)]


_DIGITS = [b"%d," % i for i in range(1 << 16)]
_DIGIT_SIZE = np.array([len(x) for x in _DIGITS], np.int64)
_DIGIT_START = np.cumsum(_DIGIT_SIZE) - _DIGIT_SIZE
_DIGIT_BYTES = np.frombuffer(b"".join(_DIGITS), np.uint8)


def _group_texts(a: np.ndarray, b: np.ndarray, a_upto: np.ndarray, b_upto: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(all groups `a1,a2|b1;`, where each ends); upto: tokens up to and with each group."""
    if a.size and max(a.max(), b.max()) >= len(_DIGITS):
        texts = [rendered(a[i:j], b[k:m]) + b";" for i, j, k, m in zip([0, *a_upto], a_upto, [0, *b_upto], b_upto, strict=False)]
        return b"".join(texts), np.cumsum([len(t) for t in texts])
    a_count, b_count = np.diff(a_upto, prepend=0), np.diff(b_upto, prepend=0)
    row = np.empty(len(a) + len(b), np.int64)
    row[np.arange(len(a)) + np.repeat(b_upto - b_count, a_count)] = a
    row[np.arange(len(b)) + np.repeat(a_upto, b_count)] = b
    size = _DIGIT_SIZE[row]
    out = ragged(_DIGIT_BYTES, _DIGIT_START[row], size)
    ends = np.cumsum(size)
    out[ends[a_upto + b_upto - b_count - 1] - 1] = ord("|")
    stop = ends[a_upto + b_upto - 1]
    out[stop - 1] = ord(";")
    return out.tobytes(), stop


class Aligned(NamedTuple):
    good: bool
    n_a: int
    n_b: int
    codes: np.ndarray
    fragments: list[Fragment]


def align(pair: Pair, bodies: pa.LargeBinaryArray | list[bytes], starts: list[int], chunk: int = CHUNK) -> Iterator[Aligned]:
    """What bodies yield, each a text with its space or a part of one that begins at a cut; starts: where in the text.

    The distinct pieces of all bodies are encoded once; bodies are aligned BATCH_BYTES at a time."""
    if not len(bodies):
        return
    data, offsets = buffers(pa.array(bodies, pa.large_binary()))
    size = np.diff(offsets)
    edge = np.append(cuts(data), True)
    edge[offsets] = True
    cut = np.flatnonzero(edge)
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut) - 1, [None, pa.py_buffer(cut), pa.py_buffer(data)])
    coded = found.dictionary_encode()
    first = np.searchsorted(cut, offsets)
    pieces = pair.coded(*buffers(coded.dictionary))
    index = coded.indices.to_numpy()
    del bodies, data, edge, cut, found, coded
    at = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BATCH_BYTES, side="right")) - 1)
        yield from _aligned(pair, pieces, index[first[at] : first[to]], np.diff(first[at : to + 1]), size[at:to], starts[at:to], chunk)
        at = to


def _aligned(pair: Pair, pieces: tuple[Coded, Coded, np.ndarray], index: np.ndarray, counts: np.ndarray, size: np.ndarray, starts: list[int], chunk: int) -> list[Aligned]:
    """align() of bodies of size bytes by their pieces' places among the distinct ones, counts of them each."""
    nothing = Aligned(False, 0, 0, np.zeros(0, pair.code), [])
    a_coded, b_coded, good = pieces
    owner = np.repeat(np.arange(len(size)), counts)
    bad = np.zeros(len(size), bool)
    bad[owner[~good[index]]] = True
    index = index[~bad[owner]]
    if not len(index):
        return [nothing] * len(size)
    a, b = a_coded.ids(index), b_coded.ids(index)
    begin = np.concatenate([[0], np.cumsum(np.where(bad, 0, size))])
    a_end, b_end = np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b])
    both = np.zeros((2, begin[-1] + 1), bool)
    both[0, a_end] = both[1, b_end] = True
    a_last, b_last = np.flatnonzero(both[1, a_end]), np.flatnonzero(both[0, b_end])
    borders, a_upto, b_upto = a_end[a_last], a_last + 1, b_last + 1
    codes = (a[a_last] * len(pair.b_tokens) + b[b_last]).astype(pair.code)
    text, text_end = _group_texts(a, b, a_upto, b_upto)

    places = []  # of fragments: where they begin in the good bodies, and in their texts
    bounds = [0]
    for k, start in enumerate(starts):
        inner = range((start // chunk + 1) * chunk, start + int(size[k]), chunk) if not bad[k] else ()
        places += [] if bad[k] else [(int(begin[k]), start), *((int(begin[k]) + x - start, x) for x in inner)]
        bounds.append(len(places))
    at = np.array([x[0] for x in places] + [int(begin[-1])])
    a_at, b_at, g_at = (np.searchsorted(x, at, side="right").tolist() for x in (a_end, b_end, borders))

    def fragment(k: int) -> Fragment:
        g0, g1 = g_at[k], g_at[k + 1]
        place = places[k][1]
        if g0 == g1:
            return Fragment(place, 0, place, a[a_at[k] : a_at[k + 1]], b[b_at[k] : b_at[k + 1]], a[:0], b[:0])
        ends = a[a_at[k] : a_upto[g0]], b[b_at[k] : b_upto[g0]], a[a_upto[g1 - 1] : a_at[k + 1]], b[b_upto[g1 - 1] : b_at[k + 1]]
        return Fragment(place, g1 - g0, place, *ends, text[text_end[g0] : max(text_end[g0], text_end[g1 - 1] - 1)])

    out = []
    for k in range(len(size)):
        i, j = bounds[k], bounds[k + 1]
        if bad[k]:
            out.append(nothing)
            continue
        out.append(Aligned(True, a_at[j] - a_at[i], b_at[j] - b_at[i], codes[g_at[i] : g_at[j]], [fragment(f) for f in range(i, j)]))
    return out


def digest_of(texts: list[bytes]) -> str:
    return hashlib.sha256(b";".join(texts)).hexdigest()


_SHORT = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary"


def _short(paths: tuple[str, str], chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load(*paths)
        none, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        for batch in chunks(batches, limit=ENCODE_BYTES):
            rows = [(0, 0, 0, "", b"")] * batch.num_rows
            text = batch.column("text").cast(pa.large_string())
            full = pc.indices_nonzero(pc.fill_null(pc.binary_length(text), 0))
            bodies = pc.binary_join_element_wise(none, text.take(full), space).cast(pa.large_binary())
            done = align(pair, bodies, [0] * len(full), chunk)
            for k, x in zip(full.to_pylist(), done, strict=True):
                if x.good:
                    rows[k] = x.n_a, x.n_b, len(x.codes), digest_of(ordered_texts(x.fragments)), x.codes.tobytes()
            kinds = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "groups_sha256": pa.string(), "links": pa.binary()}
            cols = {n: pa.array(x, t) for (n, t), x in zip(kinds.items(), zip(*rows, strict=True), strict=True)}
            yield from chunks(iter([pa.record_batch({"doc_id": batch.column("doc_id").cast(pa.int64())} | cols)]), "links", BATCH_BYTES)

    return run


def _parts(part: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Long texts, with their space, cut at the first cut at or after each multiple of part."""
        for batch in batches:
            for row, doc_id, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                data = b" " + text.as_py().encode()
                places = np.flatnonzero(cuts(np.frombuffer(data, np.uint8)))
                at = np.searchsorted(places, np.arange(part, len(data), part))
                edge = [0, *np.unique(places[at[at < len(places)]]).tolist(), len(data)]
                for a, b in zip(edge, edge[1:], strict=False):
                    cols = {"row": pa.array([row], pa.int64()), "doc_id": pa.array([doc_id], pa.int64()), "at": pa.array([a], pa.int64())}
                    yield pa.record_batch(cols | {"part": pa.array([data[a:b]], pa.binary())})

    return run


_ENDS = ("prefix_a", "prefix_b", "suffix_a", "suffix_b")
_FRAGMENT = "at long, borders long, first long, " + ", ".join(f"{x} binary" for x in _ENDS)
_PIECE = "row long, doc_id long, good boolean, n_a long, n_b long, links binary, " + _FRAGMENT + ", closed binary"


def _ids(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u4").astype(np.int64)


def _fragment_columns(found: list[Fragment]) -> dict[str, pa.Array]:
    cols = {n: pa.array([getattr(f, n) for f in found], pa.int64()) for n in ("at", "borders", "first")}
    return cols | {n: pa.array([getattr(f, n).astype("<u4").tobytes() for f in found], pa.binary()) for n in _ENDS}


def _pieces(paths: tuple[str, str], chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load(*paths)
        for batch in chunks(batches, "part", ENCODE_BYTES):
            starts = batch.column("at").to_pylist()
            done = enumerate(align(pair, batch.column("part").cast(pa.large_binary()), starts, chunk))
            while some := [*islice(done, BATCH_BYTES // PART)]:
                yield rows_of(batch, starts, some)

    def rows_of(batch: pa.RecordBatch, starts: list[int], some: list[tuple[int, Aligned]]) -> pa.RecordBatch:
        empty = np.zeros(0, np.int64)
        rows, good, found, head = [], [], [], []
        for k, x in some:
            made = x.fragments or [Fragment(starts[k], 0, starts[k], empty, empty, empty, empty)]
            rows += [k] * len(made)
            good += [x.good] * len(made)
            found += made
            head += [x, *[None] * (len(made) - 1)]  # a part's counts and links stand in its first row
        keys = batch.select(["row", "doc_id"]).take(pa.array(rows, pa.int64()))
        cols = {
            "good": pa.array(good),
            "n_a": pa.array([x.n_a if x else 0 for x in head], pa.int64()),
            "n_b": pa.array([x.n_b if x else 0 for x in head], pa.int64()),
            "links": pa.array([x.codes.tobytes() if x else b"" for x in head], pa.binary()),
        }
        return pa.record_batch({"row": keys.column(0), "doc_id": keys.column(1)} | cols | _fragment_columns(found) | {"closed": pa.array([f.closed for f in found], pa.binary())})

    return run


_TEXTS = "texts array<struct<place: bigint, text: binary>>"


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("place", pa.int64()), ("text", pa.binary())]))
    for batch in batches:
        found, texts = [], []
        for kids in batch.column("kids").to_pylist():
            whole, groups = fold([Fragment(k["at"], k["borders"], k["first"], *(_ids(k[n]) for n in _ENDS)) for k in kids])
            found.append(whole)
            texts.append([{"place": p, "text": t} for p, t in groups])
        yield pa.record_batch({"row": batch.column("row")} | _fragment_columns(found) | {"texts": pa.array(texts, kind)})


def _first_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A whole text's prefix is its first group."""
    for batch in batches:
        texts = [rendered(_ids(a), _ids(b)) for a, b in zip(batch.column("prefix_a").to_pylist(), batch.column("prefix_b").to_pylist(), strict=True)]
        yield pa.record_batch({"row": batch.column("row"), "at": batch.column("first"), "kind": pa.array([0] * len(texts), pa.int32()), "text": pa.array(texts, pa.binary())})


def reduced(pieces: DataFrame, fan: int = FAN, chunk: int = CHUNK) -> DataFrame:
    """(row, at, kind, text): the groups of texts in pieces, in the order of (at, kind); pieces are composed in ranges of fan times as many bytes at each level."""
    fields = ("at", "borders", "first", *_ENDS)
    out = pieces.filter("octet_length(closed) > 0").select("row", "at", F.lit(1).alias("kind"), F.col("closed").alias("text"))
    level, width = pieces.select("row", *fields), chunk
    last = pieces.agg(F.max("at").alias("n")).first()["n"] or 0
    while True:
        width *= fan
        ranges = level.groupBy("row", F.floor(F.col("at") / width).alias("range")).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("kids"))
        level = stored(ranges.select("row", "kids").mapInArrow(_composed, f"row long, {_FRAGMENT}, {_TEXTS}"), "align-level")
        closed = level.select("row", F.explode("texts").alias("t")).select("row", F.col("t.place").alias("at"), F.lit(0).alias("kind"), F.col("t.text").alias("text"))
        out = out.unionByName(closed)
        level = level.select("row", *fields)
        if last < width:
            return out.unionByName(level.mapInArrow(_first_groups, "row long, at long, kind int, text binary"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts come sorted; a document's go through one hash."""
    row, digest = None, None

    def out() -> pa.RecordBatch:
        return pa.record_batch({"row": pa.array([row], pa.int64()), "groups_sha256": pa.array([digest.hexdigest()])})

    for batch in batches:
        for now, text in zip(batch.column("row").to_pylist(), batch.column("text"), strict=True):
            if now != row:
                if digest:
                    yield out()
                row, digest = now, hashlib.sha256()
            else:
                digest.update(b";")
            digest.update(text.as_buffer())
    if digest:
        yield out()


def _counted(code: np.dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per id pair of a task."""
        keys, counts, held = np.zeros(0, code), np.zeros(0, np.int64), []
        for batch in chunks(batches, "links", 4 << 20):
            found, n = np.unique(np.frombuffer(b"".join(batch.column("links").to_pylist()), code), return_counts=True)
            held.append((found, n))
            if sum(len(x) for x, _ in held) > 1 << 20:
                keys, counts, held = *_summed([(keys, counts), *held]), []
        keys, counts = _summed([(keys, counts), *held])
        yield pa.record_batch({"code": pa.array(keys.astype(np.int64)), "n": pa.array(counts)})

    return run


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, back, np.concatenate([n for _, n in held]))
    return keys, counts


def _scored(code: np.dtype, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = shared.value
        for batch in chunks(batches, "links", 4 << 20):
            rows = batch.column("links").to_pylist()
            at = np.searchsorted(keys, np.frombuffer(b"".join(rows), code))
            edge = np.concatenate([[0], np.cumsum([len(x) // code.itemsize for x in rows])]).astype(np.int64)
            sums = [np.diff(np.concatenate([[0], np.cumsum(x[at], dtype=np.int64)])[edge]) for x in (best, counts)]
            kept = [k for k, n in enumerate(batch.schema.names) if n != "links"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in kept), *(pa.array(x, pa.int64()) for x in sums)], names=[*(batch.schema.names[k] for k in kept), "n_best", "count_sum"]
            )

    return run


class Alignment(NamedTuple):
    """Stored results: short texts' rows with their links, long texts' pieces and sums."""

    short: DataFrame
    pieces: DataFrame
    long: DataFrame
    paths: tuple[str, str]

    def pair_counts(self) -> DataFrame:
        """(code, n): how many links of the corpus hold each id pair; code = A id * size of B's vocabulary + B id."""
        code = load(*self.paths).code
        links = self.short.select("links").unionByName(self.pieces.select("links"))
        return links.mapInArrow(_counted(code), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def alignment(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None, part: int = PART, chunk: int = CHUNK) -> Alignment:
    paths = byte_path or vocabulary_path(BYTE_VOCABULARY), piece_path or vocabulary_path(PIECE_VOCABULARY)
    texts = columns(docs, "doc_id", "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    short = stored(texts.filter(size <= part).mapInArrow(_short(paths, chunk), _SHORT), "align-short")
    whole = texts.filter(size > part).withColumn("row", F.monotonically_increasing_id())
    cut = whole.select("row", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_parts(part), "row long, doc_id long, at long, part binary")
    pieces = stored(cut.repartition(parts(cut), "row", "at").mapInArrow(_pieces(paths, chunk), _PIECE), "align-pieces")
    sums = (F.sum(c).alias(c) for c in ("n_a", "n_b"))
    long = pieces.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.every("good").alias("good"), *sums, F.sum("borders").alias("n_groups"))
    long = stored(long, "align-long")
    kept = bounded_join(pieces, long.filter("good").select("row"), ["row"], "left_semi", salt_by=["at"])
    return Alignment(short, kept, long, paths)


def alignment_digests(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None, part: int = PART, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """A row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    found = alignment(docs, byte_path, piece_path, part, chunk)
    pair = load(*found.paths)
    counts = stored(found.pair_counts(), "align-counts")
    if counts.count() > pair.pair_bound():
        raise ValueError("more id pairs than two tokens can form that end together")
    table = counts.orderBy("code").toArrow()  # pair_bound rows at most
    keys, n = table.column("code").to_numpy().astype(pair.code), table.column("n").to_numpy()
    most = np.zeros(len(pair.b_tokens), np.int64)
    np.maximum.at(most, keys % len(pair.b_tokens), n)
    shared = docs.sparkSession.sparkContext.broadcast((keys, n, (n == most[keys % len(pair.b_tokens)]).astype(np.int64)))
    short = found.short.mapInArrow(_scored(pair.code, shared), "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, n_best long, count_sum long")
    scored = found.pieces.select("row", "links").mapInArrow(_scored(pair.code, shared), "row long, n_best long, count_sum long")
    scored = scored.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    texts = reduced(found.pieces, fan, chunk)
    hashes = texts.repartition(parts(texts), "row").sortWithinPartitions("row", "at", "kind").select("row", "text").mapInArrow(_hashed, "row long, groups_sha256 string")
    zero = F.lit(0).cast("long")
    long = found.long.join(scored, "row", "left").join(hashes, "row", "left")
    numbers = (F.when(F.col("good"), F.col(c)).otherwise(zero).alias(c) for c in ("n_a", "n_b", "n_groups"))
    long = long.select("doc_id", *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"), F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"))
    every = short.unionByName(long)
    return every.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")


def op12_token_alignment(spark, sf_dir) -> DataFrame:
    return alignment_digests(read_table(spark, sf_dir, "documents"))
