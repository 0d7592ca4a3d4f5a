"""Texts cut where the byte-level pre-tokenizer surely cuts them, so that each distinct piece is encoded once.

A space before a character that is no white space always begins a pre-token. A space before the special
token's string is left inside its piece, as that string ends a segment, and so are spaces before bytes
that may begin other white space. The ids of a text are those of its pieces, one after the other.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from meterloom.llm.common import buffers

SPECIAL = b"<|endoftext|>"

_STARTS = np.zeros(256, bool)
_STARTS[0x21:0x7F] = True
_STARTS[0xC3:0xF5] = True
_STARTS[[0xE1, 0xE2, 0xE3]] = False  # some characters of white space begin so, or with C2

#: Distinct pieces that a worker remembers; beyond, it begins anew.
REMEMBERED = 500_000


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """(pieces of all texts, number of pieces of each text)."""
    edge = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        edge[:-2] = (data[:-1] == 32) & _STARTS[data[1:]]
        row = data.tobytes()
        at = row.find(b" " + SPECIAL)
        while at >= 0:
            edge[at] = False
            at = row.find(b" " + SPECIAL, at + 1)
    edge[offsets] = True
    if len(data) == 0:
        return pa.array([], pa.large_binary()), np.zeros(len(offsets) - 1, np.int64)
    cut = np.flatnonzero(edge).astype(np.int64)
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut) - 1, [None, pa.py_buffer(cut.tobytes()), pa.py_buffer(data.tobytes())])
    place = np.searchsorted(cut, offsets)
    return found, np.diff(place)


def follows(raw: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Whether each piece (raw cut at edge) begins where the pre-tokenizer cuts whatever precedes; the first of a text may not."""
    start, size = edge[:-1], np.diff(edge)
    good = size > 1
    good[good] = (raw[start[good]] == 32) & _STARTS[raw[start[good] + 1]]
    row = raw.tobytes()
    mark = b" " + SPECIAL
    for i in np.flatnonzero(good & (size >= len(mark))).tolist():
        good[i] = not row.startswith(mark, start[i])
    return good


def ragged(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """flat[start[i] : start[i] + size[i]] for all i, one after the other."""
    total = int(size.sum())
    before = np.cumsum(size) - size
    return flat[np.repeat(start - before, size) + np.arange(total)]


def slices(array: pa.LargeBinaryArray) -> list[bytes]:
    """array.to_pylist() without an Arrow scalar for each."""
    data, offsets = buffers(array)
    row, edge = data.tobytes(), offsets.tolist()
    return [row[a:b] for a, b in zip(edge, edge[1:], strict=False)]


class Encoder:
    """Ids of whole texts by those of their pieces; encode gives the ids of each of a list of pieces."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]], remembered: int = REMEMBERED):
        """encode returns ids as unsigned 32-bit integers, little-endian."""
        self.encode, self.known, self.remembered = encode, {}, remembered

    def forget(self) -> None:
        self.known = {}

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, start of each text's ids and the end of the last)."""
        found, counts = pieces(data, offsets)
        if not len(found):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        coded = found.dictionary_encode()
        words = slices(coded.dictionary)
        if len(self.known) > self.remembered:
            self.known = {}
        if new := [w for w in words if w not in self.known]:
            self.known.update(zip(new, self.encode(new), strict=True))
        ids = [self.known[w] for w in words]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        start = np.cumsum(size) - size
        index = coded.indices.to_numpy()
        lengths = size[index]
        per_text = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        return ragged(flat, start[index], lengths), per_text
