"""Quality rules with a verdict per host.

Every document gets its counts and the soft rules that it breaks. Failures are aggregated by host (the
source of a document here), one partial sum a task. A host's failure rate is shrunk towards all hosts':
rates are taken as draws of a beta distribution whose two parameters come from their weighted mean and
variance, so that a host of few documents is judged by the others'. A host is strict when its shrunk
rate exceeds `strict_rate`, or stands out from the prior: above its mean by two of its standard
deviations, and twice the mean. Failures of base rules count in the rates too. A document goes if it fails the base rules, if it breaks a soft rule and
its host is strict, or if it breaks one by the factor `gross` on any host: a good document stays on
any host, as none goes for the host's sake alone.

Edge cases: a null text has no words and fails the base rules, as an empty one does. Null hosts are one
host. Very long texts are counted whole, each by one task. An empty table gives no rows. With one host, or hosts all alike, the prior is one document's
weight. Columns other than doc_id, text and the host's are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.llm.common import WHITE, Words, buffers, checked_broadcast, chunks, per_text, stored, text_bytes

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 0.5  # share of words in repeated 3-word windows

#: Soft rules: most symbols a word, most repeated lines a line with a word, least and most code points a word.
SOFT = {"symbols": 0.5, "dup_lines": 0.3, "short": 2.0, "long": 15.0}
STRICT_RATE = 0.5
GROSS = 3.0

#: Text bytes counted at a time: some 30 bytes of memory each.
BATCH_BYTES = 1 << 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def count_rules(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of whole texts."""
    bodies = text_bytes(texts)
    data, offsets = buffers(bodies)
    words = Words(data, offsets)
    table = np.zeros(256, bool)
    table[list(SYMBOLS)] = True
    points = ~WHITE[data] & ((data & 0xC0) != 0x80)
    lines, dups = np.zeros(len(bodies), np.int64), np.zeros(len(bodies), np.int64)
    for i, body in enumerate(bodies.to_pylist()):
        found = [x for x in body.split(b"\n") if x and not x.isspace()]
        lines[i], dups[i] = len(found), len(found) - len(set(found))
    return {
        "n_words": words.per_doc.astype(np.int64),
        "word_chars": per_text(points, offsets),
        "n_symbols": per_text(table[data], offsets),
        "n_lines": lines,
        "n_dup_lines": dups,
        "n_repeat_words": _repeated(words, len(bodies)),
    }


def _repeated(words: Words, n_docs: int) -> np.ndarray:
    """Words in 3-word windows that occur twice or more in their text."""
    if len(words) < 3:
        return np.zeros(n_docs, np.int64)
    ids = words.array().dictionary_encode().indices.to_numpy().astype(np.int64)
    many = int(ids.max()) + 1
    at = np.flatnonzero(words.doc[:-2] == words.doc[2:])
    pair, _ = pd.factorize(ids[at] * many + ids[at + 1])
    three, _ = pd.factorize(pair.astype(np.int64) * many + ids[at + 2])
    own, _ = pd.factorize(three.astype(np.int64) * n_docs + words.doc[at])
    again = at[np.bincount(own)[own] > 1] if len(own) else at
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[again + k] = True
    return np.bincount(words.doc[covered], minlength=n_docs)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, limit=BATCH_BYTES):
        found = count_rules(batch.column("text"))
        yield pa.record_batch(
            {"doc_id": batch.column("doc_id").cast(pa.int64()), "host": batch.column("host")} | {k: pa.array(v, pa.int64()) for k, v in found.items()}
        )


def breaks(limits: dict[str, float], factor: float, where: str = "") -> Column:
    """Whether a soft rule is broken by more than the factor; where: what precedes the counts' names.

    As each word has a code point, the factor divides what the least length has above one."""
    n = {c: F.col(where + c) for c in COUNTS}
    words = n["n_words"].cast("double")
    return (
        (n["n_symbols"] > limits["symbols"] * factor * words)
        | (n["n_dup_lines"] > F.least(F.lit(limits["dup_lines"] * factor), F.lit(0.9)) * n["n_lines"])
        | (n["word_chars"] < (1 + (limits["short"] - 1) / factor) * words)
        | (n["word_chars"] > limits["long"] * factor * words)
    )


def base_fails(where: str = "") -> Column:
    words = F.col(where + "n_words")
    return (words < MIN_WORDS) | (100 * F.col(where + "n_repeat_words") > int(100 * MAX_REPEATED) * words)


def host_verdicts(flagged: DataFrame, strict_rate: float) -> DataFrame:
    """host, n_docs, n_failed, shrunk_rate, strict; flagged has host and fails.

    The prior is fitted by moments: mean m and variance v of the hosts' rates, weighted by documents and
    less the binomial part, give the prior weight k = m(1-m)/v - 1 and the parameters mk and (1-m)k."""
    hosts = flagged.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(F.col("fails").cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    moments = hosts.agg(
        F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"), F.sum(rate * F.col("n_failed")).alias("sq"), F.count("*").alias("h")
    )
    mean = F.coalesce(F.col("f") / F.col("n"), F.lit(0.0))
    spread = mean * (1 - mean)
    # E[sum n_h (r_h - m)^2] = h m(1-m) + (n - h) v, about
    between = (F.col("sq") - F.col("n") * mean * mean - F.col("h") * spread) / F.greatest(F.col("n") - F.col("h"), F.lit(1))
    weight = F.when(F.col("h") < 2, 1.0).when(between <= spread * 1e-4, 1e4).otherwise(F.greatest(spread / between - 1, F.lit(1.0)))
    prior = moments.select(mean.alias("m"), F.coalesce(weight, F.lit(1.0)).alias("k")).first()
    shrunk = (F.col("n_failed") + F.lit(prior["m"] * prior["k"])) / (F.col("n_docs") + F.lit(prior["k"]))
    m, k = prior["m"], prior["k"]
    limit = min(strict_rate, max(m + 2 * (m * (1 - m) / (k + 1)) ** 0.5, 2 * m))
    return hosts.select("host", "n_docs", "n_failed", shrunk.alias("shrunk_rate"), (shrunk > limit).alias("strict"))


def quality_rules(docs: DataFrame, host: str = "source", limits: dict[str, float] = SOFT, strict_rate: float = STRICT_RATE, gross: float = GROSS) -> DataFrame:
    """A row per document: doc_id, counts, base_failed, kept, fails (a soft rule), host_strict."""
    narrow = docs.select("doc_id", "text", F.col(f"`{host}`").cast("string").alias("host"))
    schema = "doc_id long, host string, " + ", ".join(f"{c} long" for c in COUNTS)
    counted = stored(narrow.mapInArrow(_counted, schema), "quality-counts")
    flagged = counted.withColumn("fails", breaks(limits, 1.0)).withColumn("gross", breaks(limits, gross))
    strict = host_verdicts(flagged.select("host", (F.col("fails") | base_fails()).alias("fails")), strict_rate).filter("strict").select(F.col("host").alias("h"), "strict")
    joined = flagged.join(checked_broadcast(strict, "h"), F.col("host").eqNullSafe(F.col("h")), "left")
    base = base_fails()
    host_strict = F.coalesce("strict", F.lit(False))
    goes = base | F.col("gross") | (F.col("fails") & host_strict)
    return joined.select("doc_id", *(c for c in COUNTS if c != "n_lines"), base.alias("base_failed"), (~goes).alias("kept"), "fails", host_strict.alias("host_strict"))


def keep_passing(docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents that the rules keep, with all their columns.

    A first pass stores host and flags, by which hosts are judged; a second counts again beside the rows, so that no text is stored
    or shuffled and rows that repeat an id are told apart. Rows travel as a struct, so no column's name can clash; only those that
    break a soft rule meet their host's verdict."""
    fields = [T.StructField("doc", docs.schema), T.StructField("host", T.StringType()), *(T.StructField(c, T.LongType()) for c in COUNTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            beside = pa.RecordBatch.from_arrays([*batch.columns, batch.column("doc").field("text")], names=[*batch.schema.names, "text"])
            for part in chunks(iter([beside]), limit=BATCH_BYTES):
                found = count_rules(part.column("text"))
                yield pa.RecordBatch.from_arrays([*part.columns[:2], *(pa.array(found[c], pa.int64()) for c in COUNTS)], names=["doc", "host", *COUNTS])

    name = F.col(f"`{host}`").cast("string").alias("host")
    narrow = docs.select("doc_id", "text", name).mapInArrow(_counted, "doc_id long, host string, " + ", ".join(f"{c} long" for c in COUNTS))
    flagged = stored(narrow.select("host", (breaks(SOFT, 1.0) | base_fails()).alias("fails")), "quality-fails")
    strict = checked_broadcast(host_verdicts(flagged, STRICT_RATE).filter("strict").select(F.col("host").alias("h"), F.lit(True).alias("strict")), "h")
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), name).mapInArrow(run, T.StructType(fields))
    own = base_fails() | breaks(SOFT, GROSS)
    left = whole.filter(~own).select("doc", F.when(breaks(SOFT, 1.0), F.col("host")).alias("host"), breaks(SOFT, 1.0).alias("soft"))
    judged = left.join(strict, F.col("soft") & F.col("host").eqNullSafe(F.col("h")), "left").filter("not soft or strict is null")
    return judged.select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))


def op2_quality_rules(spark, sf_dir) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
