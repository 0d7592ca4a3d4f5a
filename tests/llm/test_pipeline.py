"""The pipeline row by row against plain Python, and its stages on clashing names and templates."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterloom.llm import bpe, mixing, near_copies, quality_rules
from tests.llm.test_text_operators import WORD, counted, shingles_of, squeezed


def soft(c, lines, gross=1.0):
    """Whether the counts break a soft rule by the factor."""
    words, chars, symbols, dups, _ = c
    limits = quality_rules.SOFT
    return (
        symbols > limits["symbols"] * gross * words
        or dups > min(limits["dup_lines"] * gross, 0.9) * lines
        or chars < (1 + (limits["short"] - 1) / gross) * words
        or chars > limits["long"] * gross * words
    )


def rules(rows):
    judged = []
    for row in rows:
        c = counted(row["text"])
        lines = sum(bool(re.search(WORD, x)) for x in (row["text"] or "").split("\n"))
        base = c[0] < 50 or 100 * c[4] > 50 * c[0]
        judged.append((row, base, soft(c, lines), soft(c, lines, quality_rules.GROSS)))
    n, f = Counter(r["source"] for r, *_ in judged), Counter(r["source"] for r, b, s, _ in judged if b or s)
    total, failed, hosts = sum(n.values()), sum(f.values()), len(n)
    m = failed / total
    spread = m * (1 - m)
    between = (sum(f[h] ** 2 / n[h] for h in n) - total * m * m - hosts * spread) / max(total - hosts, 1)
    k = 1.0 if hosts < 2 else 1e4 if between <= spread * 1e-4 else max(spread / between - 1, 1.0)
    limit = min(quality_rules.STRICT_RATE, max(m + 2 * math.sqrt(m * (1 - m) / (k + 1)), 2 * m))
    strict = {h for h in n if (f[h] + m * k) / (n[h] + k) > limit}
    return [r for r, base, s, g in judged if not (base or g or (s and r["source"] in strict))]


def exact(rows):
    groups = {}
    for r in rows:
        groups.setdefault(squeezed(r["text"]), []).append(r)
    return [min(g, key=lambda r: (-len(r["text"] or ""), r["doc_id"])) for g in groups.values()]


def near(rows):
    sets, root = [shingles_of(r["text"]) for r in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r)
    return [min(g, key=lambda r: r["doc_id"]) for g in groups.values()]


def rates(rows):
    """doc_id to (size, rate, target): the tilts that meet the targets, by bisection."""
    size = {r["doc_id"]: len(re.findall(WORD, r["text"] or "")) for r in rows}
    sources = sorted({r["source"] for r in rows if r["source"] is not None}) + ([None] if any(r["source"] is None for r in rows) else [])
    whole = {s: sum(size[r["doc_id"]] for r in rows if r["source"] == s) for s in sources}
    weight, target, free, left = {s: 1 + k % 3 for k, s in enumerate(sources)}, {}, set(sources), sum(whole.values())
    while free:
        share = left / sum(weight[s] for s in free)
        above = {s for s in free if share * weight[s] > 3 * whole[s]}
        target |= {s: 3.0 * whole[s] for s in above} if above else {s: share * weight[s] for s in free}
        left -= sum(3 * whole[s] for s in above)
        free = free - above if above else set()
    out = {}
    for s in sources:
        own = [r["doc_id"] for r in rows if r["source"] == s]
        mean = whole[s] / len(own)
        low, high = -200.0, 200.0
        for _ in range(200):
            mid = (low + high) / 2
            got = sum(size[i] * min(3.0, math.exp(min(mid * size[i] / mean, 50))) for i in own)
            low, high = (mid, high) if got < target[s] else (low, mid)
        out |= {i: (size[i], min(3.0, math.exp(min(high * size[i] / mean, 50))), target[s]) for i in own}
    return out


def as_rows(df):
    return sorted(([r.asDict() for r in df.collect()]), key=lambda r: (r["doc_id"], repr(r)))


def test_pipeline_row_by_row(spark, base):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{base}/documents.parquet")
    now, want = docs, as_rows(docs)
    for (name, stage), plain in zip(corpus_pipeline.STAGES[:3], (rules, exact, near), strict=True):
        now, before = corpus_pipeline.stored(stage(spark, now, base), "test-stage"), len(want)
        want = sorted(plain(want), key=lambda r: (r["doc_id"], repr(r)))
        assert as_rows(now) == want, name
        assert 0 < len(want) < before, name
    tilts = rates(want)
    mix = mixing.mix_sources(now).collect()
    got = Counter()
    for r in mix:
        size, rate, target = tilts[r.doc_id]
        assert r["size"] == size and r.target == pytest.approx(target) and r.rate == pytest.approx(rate, rel=1e-3, abs=1e-6)
        got[r.source] += r.taken
    for source, words in got.items():
        own = [tilts[r.doc_id] for r in mix if r.source == source]
        assert abs(words - own[0][2]) <= max(size for size, *_ in own) / 2 + 1
    mixed = corpus_pipeline.STAGES[3][1](spark, now, base)
    copies = {r.doc_id: r.copies for r in mix}
    again = sorted((r for r in want for _ in range(copies[r["doc_id"]])), key=lambda r: (r["doc_id"], repr(r)))
    assert as_rows(mixed) == again
    tokenizer = Tokenizer.from_file(bpe.vocabulary_path())
    tokens = []
    for r in again:
        ids = tokenizer.encode(r["text"], add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        tokens.append((r["doc_id"], len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, base).collect()) == sorted(tokens)


CLASHING = ("c", "strict", "host", "h", "doc", "fails", "text_a", "row", "root", "id", "key", "cell", "__row", "__lost", "n", "size", "rate", "copies", "__copy", "s1")


def test_stages_on_any_column_names(spark):
    good = [" ".join(f"w{i * 7 + j * j}" for j in range(90)) for i in range(6)]
    texts = [*good, good[0], good[1] + " tail", "short", None, "", " # ".join(good[2].split())]
    fields = ", ".join(f"`{c}` string" for c in CLASHING)
    rows = [(i, t, "en", "s", 3, *[f"{c}{i}" for c in CLASHING]) for i, t in enumerate(texts)]
    now = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {fields}").repartition(3)
    names = now.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.stored(stage(spark, now, ""), "test-names")
        assert now.columns == names, name
        assert all(r[c] == f"{c}{r['doc_id']}" for r in now.collect() for c in CLASHING), name
    assert {r.doc_id for r in now.select("doc_id").collect()} <= {*range(6), 11}
    assert now.count() > 0


def pages(spark, n, shared=170, own=36):
    template = [f"t{j}" for j in range(shared)]
    rows = [(i, " ".join(template + [f"p{i}x{j}" for j in range(own)])) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_pages_of_one_template_meet_in_few_pairs(spark, monkeypatch):
    """Pages that share 170 of 206 words are no near copies; twice as many don't meet in more than about twice as many pairs."""
    made = {}
    plain = near_copies._meetings

    def counting(labelled, *more):
        found = near_copies.stored(plain(labelled, *more), "test-pairs")
        made[n] = found.count()
        return found

    monkeypatch.setattr(near_copies, "_meetings", counting)
    for n in (200, 400):
        assert near_copies.keep_one(pages(spark, n)).count() == n
    assert made[400] <= 2.5 * made[200] + 400 and made[400] < 400 * 20


def test_large_groups_of_near_copies_are_one(spark):
    """Copies with one word changed are a single component, in however many deals their keys are."""
    rows = [(i, " ".join(f"w{j}" if j != i % 50 else f"e{i}" for j in range(60))) for i in range(300)]
    rows += [(1000 + i, " ".join(f"v{i}x{j}" for j in range(60))) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    texts = frame.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("id"), "text")
    texts = near_copies.stored(texts, "test-texts")
    sizes = []
    for deals in (near_copies.INDEX_ROWS, 7):
        found = near_copies.near_copies(texts, index_rows=deals)
        sizes.append(sorted(r["count"] for r in found.groupBy("root").count().collect()))
    assert sizes[0] == sizes[1]
    sets = {i: shingles_of(t) for i, t in rows if i < 1000}
    linked = any(len(sets[0] & sets[j]) >= 0.8 * len(sets[0] | sets[j]) for j in range(1, 300))
    assert linked and sizes[0][-1] > 1
