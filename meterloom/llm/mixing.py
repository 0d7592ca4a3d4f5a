"""Mixing sources to target weights by entropy balancing, with DataFrame operations only.

Each source has a target number of words. The rates (copies of each document) nearest to one copy in
relative entropy that meet every source's target are exponential tilts of the size, held at `cap`:
rate = min(cap, exp(lambda * size / mean size)), with one multiplier lambda a source. The multipliers
solve the convex dual; every Newton iteration sums gradient and curvature over a table with a row per
(source, size), and is kept in a bracket that always holds the root. Rates are rounded to whole copies
by cumulating their fractions over documents ordered by size, and what a source then lacks or has too
much is given to or taken from the largest documents that fit in it, PASSES times.

No step needs a group's documents in one task: documents of one source and size are dealt by their ids
into cells of about CELL rows, and documents are only ranked inside their cell. Cells are cumulated inside their
source and size, from what the source's sizes before hold in all; so a task cumulates the cells of one size, or
the sizes of one source, of which there are at most as many as its longest text has words. The targets' tables have a row per source.

Edge cases: a null text has size 0; documents of size 0 have rate 1 and give no words. The null source
is a source of its own, last in order. Rows that repeat an id are documents of their own, in one cell.
If no document has a word, all targets are 0. An empty table gives no rows. Columns other than doc_id,
text and the source's are not read.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm.common import checked_broadcast, stored

WEIGHTS = (1, 2, 3)
CAP = 3.0
CELL = 500
TOLERANCE = 1e-7
ITERATIONS = 60
#: Times that what a source lacks or has too much after rounding is corrected.
PASSES = 4

_SPACE = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ in a text; 0 where null."""
    ends = F.array(*(F.lit(c) for c in " \t\n\x0b\x0c\r"))
    outer = F.array_contains(ends, F.substring(text, 1, 1)).cast("long") + F.array_contains(ends, F.right(text, F.lit(1))).cast("long")
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit(0)).otherwise(F.size(F.split(text, _SPACE, -1)) - outer).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """source, source_size, n_docs, target: all sizes are shared by weight; no target exceeds cap times its source's size.

    Sources whose cap is reached first are those of least cap / weight; in that order, a source is at its cap if the level of
    words a weight that the ones before leave exceeds its own ratio; of the others, the first has the highest level."""
    every = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = sources.withColumn("weight", weight).withColumn("most", cap * F.col("source_size"))
    up = Window.orderBy(F.col("most") / F.col("weight"), "source")
    rows = rows.withColumn("before", F.sum("most").over(up) - F.col("most")).withColumn("left", F.sum("weight").over(every) - F.sum("weight").over(up) + F.col("weight"))
    rows = rows.withColumn("level", (F.sum("source_size").over(every) - F.col("before")) / F.col("left"))
    level = F.max(F.when(F.col("most") / F.col("weight") >= F.col("level"), F.col("level"))).over(every)
    return rows.withColumn("target", F.coalesce(F.least("most", F.col("weight") * level), F.col("most"))).select("source", "source_size", "n_docs", "target")


def solve_dual(groups: DataFrame, goals: DataFrame, cap: float) -> DataFrame:
    """source, target, source_size, mean, lam; groups: (source, size, n) with size > 0."""
    least = groups.groupBy("source").agg(F.min("size").alias("least"), F.max("size").alias("largest"), F.sum("n").alias("m"))
    goals = goals.withColumnRenamed("source", "s")
    joined = least.join(goals, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    mean = F.col("source_size") / F.col("m")
    ratio = F.greatest(F.col("target") / F.col("source_size"), F.lit(1e-9))
    # at one end of the bracket every document is at the cap, or has at most the wanted share
    far = F.when(ratio >= 1, F.lit(math.log(cap))).otherwise(F.log(ratio)) * mean / F.col("least")
    state = joined.select(
        "source", "target", "source_size", mean.alias("mean"), F.lit(0.0).alias("lam"), F.least(far, F.lit(0.0)).alias("lo"), F.greatest(far, F.lit(0.0)).alias("hi"), F.lit(False).alias("done")
    )
    state = stored(state, "mixing-dual")
    for _ in range(ITERATIONS):
        now = checked_broadcast(state.withColumnRenamed("source", "s"), "s")
        rows = groups.join(now, F.col("source").eqNullSafe(F.col("s")))
        rate = F.least(F.lit(cap), F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0))))
        words = F.col("n") * F.col("size") * rate
        keep = ("target", "source_size", "mean", "lam", "lo", "hi", "done")
        sums = rows.groupBy("source").agg(
            F.sum(words).alias("got"), F.sum(F.when(rate < cap, words * F.col("size") / F.col("mean"))).alias("slope"), *(F.first(c).alias(c) for c in keep)
        )
        over = F.col("got") - F.col("target")
        done = F.col("done") | (F.abs(over) <= TOLERANCE * F.greatest(F.col("target"), F.lit(1.0)))
        lo, hi = F.when(over <= 0, F.col("lam")).otherwise(F.col("lo")), F.when(over >= 0, F.col("lam")).otherwise(F.col("hi"))
        step = F.col("lam") - over / F.col("slope")
        inside = (F.col("slope") > 0) & (step > lo) & (step < hi)
        lam = F.when(done, F.col("lam")).otherwise(F.when(inside, step).otherwise((lo + hi) / 2))
        state = stored(sums.select("source", "target", "source_size", "mean", lam.alias("lam"), lo.alias("lo"), hi.alias("hi"), done.alias("done")), "mixing-dual")
        if state.filter(~F.col("done") & (F.col("hi") - F.col("lo") > 1e-12 * (F.abs("lo") + F.abs("hi")))).isEmpty():
            break
    else:
        warnings.warn(f"multipliers did not settle in {ITERATIONS} iterations; source_taken tells what a source gets", stacklevel=2)
    return state.select("source", "target", "source_size", "mean", "lam")


def _fitted(cells: DataFrame, goals: DataFrame, cap: float) -> DataFrame:
    """cells with k, the copies that a cell gives, changed so that each source comes nearer to its target: the largest documents that fit in what it lacks or has too much."""
    got = cells.groupBy("source").agg(F.sum(F.col("k") * F.col("size")).alias("got"))
    lacks = got.join(goals, F.col("source").eqNullSafe(F.col("s"))).select(F.col("source").alias("s"), (F.round("target") - F.col("got")).alias("lack"))
    rows = cells.join(checked_broadcast(stored(lacks, "mixing-lacks"), "s"), F.col("source").eqNullSafe(F.col("s")))
    more = F.col("n") * int(cap) - F.col("k")
    fits = (F.col("size") > 0) & (F.col("size") <= F.abs("lack"))
    rows = rows.withColumn("room", F.when(fits, F.when(F.col("lack") > 0, more).otherwise(F.col("k"))).otherwise(0))
    larger = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    ahead = rows.groupBy("source", "size").agg(F.sum(F.col("room") * F.col("size")).alias("words"))
    ahead = ahead.select(F.col("source").alias("s2"), F.col("size").alias("z2"), F.coalesce(F.sum("words").over(larger), F.lit(0)).alias("ahead"))
    rows = rows.join(ahead, F.col("source").eqNullSafe(F.col("s2")) & (F.col("size") == F.col("z2")))
    inside = Window.partitionBy("source", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("ahead") + F.coalesce(F.sum("room").over(inside), F.lit(0)) * F.col("size")
    change = F.greatest(F.lit(0), F.least("room", F.floor((F.abs("lack") - before) / F.greatest("size", F.lit(1)))))
    k = F.col("k") + F.when(F.col("lack") > 0, change).otherwise(-change)
    return stored(rows.select("source", "size", "cell", "n", k.cast("long").alias("k")), "mixing-cells")


def _mixed(docs: DataFrame, source: str, weights: tuple[int, ...], cap: float, cell: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(s, z, rate, cells, ahead of each source and size; the documents with rank in their cell; s, z, c, n, k of each cell and what its source gets)."""
    sized = stored(docs.select("doc_id", F.col(f"`{source}`").alias("source"), word_count(F.col("text")).alias("size")), "mixing-sizes")
    groups = stored(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mixing-groups")
    sources = groups.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    goals = stored(targets(sources, weights, cap), "mixing-targets")
    dual = solve_dual(groups.filter("size > 0"), goals, cap)

    tilt = checked_broadcast(dual.select(F.col("source").alias("s"), "mean", "lam"), "s")
    rated = groups.join(tilt, F.col("source").eqNullSafe(F.col("s")), "left")
    rate = F.when(F.col("size") == 0, 1.0).otherwise(F.least(F.lit(cap), F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0)))))
    rated = rated.select("source", "size", "n", F.coalesce(rate, F.lit(0.0)).alias("rate"), F.ceil(F.col("n") / cell).alias("cells"))
    smaller = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum(F.col("n") * (F.col("rate") - F.floor("rate"))).over(smaller), F.lit(0.0))
    rated = rated.select("source", "size", "rate", "cells", ahead.alias("ahead"))
    rated = checked_broadcast(stored(rated, "mixing-rates").toDF("s", "z", "rate", "cells", "ahead"), "s")
    dealt = _dealt(sized, rated)

    cells = dealt.groupBy("source", "size", "cell").agg(F.count("*").alias("n"), F.first("rate").alias("rate"), F.first("ahead").alias("ahead"))
    whole = F.floor("rate")
    up = Window.partitionBy("source", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.sum("n").over(up)
    total, less = (F.col("ahead") + n * (F.col("rate") - whole) for n in (upto, upto - F.col("n")))
    extra = F.floor(total + 0.5) - F.floor(less + 0.5)
    k = F.col("n") * whole + F.greatest(F.lit(0), F.least("n", extra))
    cells = stored(cells.select("source", "size", "cell", "n", k.cast("long").alias("k")), "mixing-cells")
    goals = goals.withColumnRenamed("source", "s")
    for _ in range(PASSES):
        cells = _fitted(cells, goals, cap)
    taken = cells.groupBy("source").agg(F.sum(F.col("k") * F.col("size")).alias("source_taken"))
    goals = goals.join(taken, F.col("source").eqNullSafe(F.col("s"))).drop("source")
    cells = cells.join(checked_broadcast(goals, "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    cells = cells.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("cell").alias("c"), "n", "k", "target", "source_size", "source_taken")
    cells = stored(cells, "mixing-copies")
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("source", "size", "cell").orderBy(_place(), "doc_id")))
    return rated, ranked, cells


def _dealt(sized: DataFrame, rated: DataFrame) -> DataFrame:
    """Rows with doc_id, source and size, with the rate and the cell that they fall into."""
    dealt = sized.join(rated, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
    return dealt.withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.col("cells"))).drop("s", "z", "cells")


def _place() -> Column:
    """Documents of a cell follow by this, then by doc_id."""
    return F.xxhash64("doc_id", F.lit(1))


def _same_cell() -> Column:
    return F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("cell") == F.col("c"))


def mix_sources(docs: DataFrame, source: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: float = CAP, cell: int = CELL) -> DataFrame:
    """A row per document: doc_id, size, source_size, target, taken, copies, rate, source, source_taken (words the mix takes of the source)."""
    _, ranked, cells = _mixed(docs, source, weights, cap, cell)
    out = ranked.join(checked_broadcast(cells, "s"), _same_cell())
    copies = F.floor(F.col("k") / F.col("n")) + (F.col("rank") <= F.col("k") % F.col("n")).cast("long")
    return out.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), (copies * F.col("size")).alias("taken"), copies.alias("copies"), "rate", "source", "source_taken")


def repeat_documents(docs: DataFrame, source: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: float = CAP, cell: int = CELL) -> DataFrame:
    """The documents, each as many times as mix_sources has copies; rows of one id, source and size get the most of theirs.

    A cell's documents that get one copy more are those up to the last of them in the cell's order, so a document needs its cell's
    row only: a table of a row for about `cell` documents meets the texts, which are not exchanged while it can be broadcast."""
    rated, ranked, cells = _mixed(docs, source, weights, cap, cell)
    last = F.max(F.when(F.col("rank") == F.col("k") % F.col("n"), F.struct(_place().alias("place"), F.col("doc_id").alias("id"))))
    ends = ranked.join(checked_broadcast(cells, "s"), _same_cell()).groupBy("source", "size", "cell").agg(F.first(F.floor(F.col("k") / F.col("n"))).alias("each"), last.alias("last"))
    ends = stored(ends.toDF("s", "z", "c", "each", "last").filter("each > 0 or last is not null"), "mixing-ends")
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))  # so that no name can clash
    sized = whole.select("doc", F.col("doc.doc_id").alias("doc_id"), F.col("doc").getField(source).alias("source"), word_count(F.col("doc.text")).alias("size"))
    joined = _dealt(sized, rated).join(checked_broadcast(ends, "s"), _same_cell())
    upto = F.col("doc_id").isNull() | F.coalesce(F.col("doc_id") <= F.col("last.id"), F.lit(False))
    more = F.col("last").isNotNull() & ((_place() < F.col("last.place")) | ((_place() == F.col("last.place")) & upto))
    repeated = joined.withColumn("copies", F.col("each") + more.cast("long")).filter("copies > 0").select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return repeated.select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))


def op4_mixing(spark, sf_dir) -> DataFrame:
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))
