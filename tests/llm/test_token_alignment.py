"""Token alignment against the two libraries and plain Python over whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meterloom.llm import queries
from meterloom.llm import token_alignment as ta
from meterloom.llm.bpe import vocabulary_path


@pytest.fixture(scope="module")
def pair():
    return ta.load(vocabulary_path(ta.BYTE_VOCABULARY), vocabulary_path(ta.PIECE_VOCABULARY))


def groups(pair, text):
    """([(A ids, B ids)], links) by the libraries on the whole text; None if it has no tokens."""
    if not text:
        return None
    a = pair.a.encode(" " + text, add_special_tokens=False).ids
    b = pair.b.encode(text)
    whole = (" " + text).encode()
    if b"".join(pair.a_tokens[i] for i in a) != whole or b"".join(pair.b_tokens[i] for i in b) != whole:
        return None
    out, x, y, i, j = [([], [])], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if x <= y and i < len(a):
            x += len(pair.a_tokens[a[i]])
            out[-1][0].append(a[i])
            i += 1
        else:
            y += len(pair.b_tokens[b[j]])
            out[-1][1].append(b[j])
            j += 1
        if x == y:
            out.append(([], []))
    return out[:-1]


def expected(pair, rows):
    found = [(i, groups(pair, t)) for i, t in rows]
    counts = Counter((g[0][-1], g[1][-1]) for _, x in found for g in x or [])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for i, x in found:
        if x is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(g[0][-1], g[1][-1]) for g in x]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in x)
        n_best = sum(counts[p] == best[p[1]] for p in links)
        sums = (sum(len(a) for a, _ in x), sum(len(b) for _, b in x), len(x), len(x), n_best, sum(counts[p] for p in links))
        out.append((i, *sums, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def found(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=repr)


def letters(n):
    some = random.Random(n)
    return "".join(some.choice("abcdefgh") for _ in range(n))


TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "\n", "a\n b", "the  cat", "don't  stop\t now", "é ü ß 漢字 🙂 end", "a<|endoftext|> b <s> </s> <unk> <0x41>", "under▁score in it", "ﬁ ① ½",
    "　wide　space", "x y z", "é combining", "a\x00b \x01", "tail   ", "one two three one two three", "one two three one two three", letters(700), "word " * 300,
    " ".join(f"w{i * 7919 % 3001}" for i in range(900)), letters(300) + " " + "the cat sat on the mat. " * 40 + letters(400), "good words first " * 40 + "▁" + " and after" * 40,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None if i == 5 else i, t, 1, 2, "x") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[20]], "doc_id long, text string, row int, at int, links string").repartition(3)


@pytest.mark.parametrize("part,chunk,fan", [(ta.PART, ta.CHUNK, ta.FAN), (100, 37, 2), (64, 500, 3), (10, 7, 5)])
def test_equals_whole_texts(docs, pair, part, chunk, fan):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(ta.alignment_digests(docs, part=part, chunk=chunk, fan=fan)) == expected(pair, rows)


@given(st.lists(st.text(alphabet=st.sampled_from(" ab\n.é漢▁'1　"), max_size=40), max_size=6), st.integers(1, 30))
@settings(max_examples=150, deadline=None)
def test_fragments_in_any_bracketing(texts, chunk):
    pair = ta.load(vocabulary_path(ta.BYTE_VOCABULARY), vocabulary_path(ta.PIECE_VOCABULARY))
    texts = [t for t in texts if t]
    for text, got in zip(texts, ta.align(pair, [b" " + t.encode() for t in texts], [0] * len(texts), chunk), strict=True):
        want = groups(pair, text)
        assert got.good == (want is not None)
        if not want:
            continue
        rows = [ta.rendered(np.array(a), np.array(b)) for a, b in want]
        assert b";".join(ta.ordered_texts(got.fragments)) == b";".join(rows)
        some = random.Random(chunk)
        nodes, closed = list(got.fragments), []
        while len(nodes) > 1:  # neighbours in any order
            k = some.randrange(len(nodes) - 1)
            nodes[k : k + 2] = [nodes[k].then(nodes[k + 1], closed)]
        closed.append((nodes[0].first, ta.rendered(nodes[0].prefix_a, nodes[0].prefix_b)))
        every = sorted([(p, 0, t) for p, t in closed] + [(f.at, 1, f.closed) for f in got.fragments if f.closed])
        assert b";".join(x[2] for x in every) == b";".join(rows)
        assert len(nodes[0].suffix_a) == len(nodes[0].suffix_b) == 0


class Counting:
    """A tokenizer that counts the bytes that it is given."""

    def __init__(self, inner):
        self.inner, self.given = inner, 0

    def _add(self, texts):
        self.given += sum(len(t.encode()) for t in ([texts] if isinstance(texts, str) else texts))

    def encode(self, texts, **named):
        self._add(texts)
        return self.inner.encode(texts, **named)

    def encode_batch(self, texts, **named):
        self._add(texts)
        return self.inner.encode_batch(texts, **named)

    def encode_batch_fast(self, texts, **named):
        self._add(texts)
        return self.inner.encode_batch_fast(texts, **named)


def test_pieces_of_many_texts_are_encoded_once(pair, monkeypatch):
    words = [f"{i:07d}" for i in range(150_000)]
    rows = [" ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)]
    rows += [" ".join(words[i::150]) for i in range(150)]
    size = sum(len(w) + 1 for w in words)
    libraries = Counting(pair.a), Counting(pair.b)
    monkeypatch.setattr(pair, "a", libraries[0])
    monkeypatch.setattr(pair, "b", libraries[1])
    batch = pa.record_batch({"doc_id": list(range(len(rows))), "text": rows})
    run = ta._short((vocabulary_path(ta.BYTE_VOCABULARY), vocabulary_path(ta.PIECE_VOCABULARY)), ta.CHUNK)
    assert sum(b.num_rows for b in run(iter([batch]))) == len(rows)
    assert max(x.given for x in libraries) <= 1.05 * size


def test_pieces_with_the_space_mark_spoil_no_run(pair, monkeypatch):
    words = [f"{i:07d}" + "▁" * (i % 20 == 0) for i in range(20_000)]
    texts = [" ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)] + [" ".join(w for w in words if "▁" not in w)]
    libraries = Counting(pair.a), Counting(pair.b)
    monkeypatch.setattr(pair, "a", libraries[0])
    monkeypatch.setattr(pair, "b", libraries[1])
    found = list(ta.align(pair, [b" " + t.encode() for t in texts], [0] * len(texts)))
    assert [x.good for x in found] == [False] * 20 + [True]
    assert max(x.given for x in libraries) <= sum(len(w) + 1 for w in words)


def test_bad_neighbours_in_one_run(pair):
    texts = ["good words", "a▁b", "tail  ", "next word", " ", "é x", "　wide", "x" * 300, "<|endoftext|> end"]
    found = list(ta.align(pair, [b" " + t.encode() for t in texts], [0] * len(texts)))
    for text, got in zip(texts, found, strict=True):
        want = groups(pair, text)
        assert got.good == (want is not None)
        if want:
            assert b";".join(ta.ordered_texts(got.fragments)) == b";".join(ta.rendered(np.array(a), np.array(b)) for a, b in want)


def test_id_pairs_are_bounded(pair, docs):
    counts = ta.alignment(docs).pair_counts().collect()
    assert 0 < len(counts) <= pair.pair_bound() < 600_000
    n = len(pair.b_tokens)
    for code, _ in counts:
        a, b = pair.a_tokens[code // n], pair.b_tokens[code % n]
        assert a.endswith(b) or b.endswith(a)


def test_empty(docs):
    assert ta.alignment_digests(docs.limit(0)).collect() == []


def test_query(spark, base, pair):
    rows = [tuple(r) for r in spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text").collect()]
    assert found(queries.QUERIES["op12_token_alignment"](spark, base)) == expected(pair, rows)
