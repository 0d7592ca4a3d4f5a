"""Repair of conversations' turns by iterative-deepening A*.

A conversation's rows, by turn, become the role initials (s?(ua)+)? by edits: Keep 0, Rerole to user or assistant 1,
Delete 2 (required for blank and duplicate rows), Insert an empty row of user or assistant 5; a truncated row that stays adds 5.
Of the cheapest edit rows the ASCII-least is taken. The search is depth first, in ASCII order of the edits, under a cost bound
that rises to the least cost that exceeded it; a state (rows left, grammar state) that failed keeps the lower bound learned
from its failure and is not entered again below that. The first path that accepts is the answer.

Rows are sorted by ranges of (conversation, turn), so a conversation with a third of all rows is spread over tasks. It is cut
into segments of SEGMENT rows at most. One that is whole in a segment is searched at once. Of others each segment is searched
from every entry state to every exit state, and tables of those costs and of the ASCII order of their paths are composed FAN at a
time: an insertion belongs to the row that follows, so no path of a segment is the beginning of another, and the order of two
whole paths is that of the first segment in which they differ. The states at all borders then follow from the top.

Edge cases: a null role or text is one space. Null turns come first; rows of one turn follow by role, then by the SHA-256
of their text. A null conv_id is a conversation of its own. A role's initial is its first character; an empty role has none and
fits nowhere. Repeated rows are duplicates. Very long texts are moved but never looked into by Python, except to hash the repaired
conversation; that hash is one stream over a conversation, of constant memory. An empty table gives no rows. Columns other than
conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import columns, parts, read_table, stored
from meterloom.operators.spread import bounded_join

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SEGMENT = 128
FAN = 1024

#: White space as everywhere here: [\x20\x09-\x0D].
WHITE = " \t\n\x0b\f\r"

#: Grammar states: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: The state that a row of the needed role leads to, and that role.
NEXT = (USER, USER, ASSISTANT, USER)
NEEDED = ("user", "user", "assistant", "user")
#: Rows to insert at the end before each state accepts.
MISSING = (0, 2, 1, 0)
NEVER = 1 << 60

#: A row is a letter: three for each initial (s, u, a, any other), by fault (none, blank or duplicate, truncated).
INITIALS = "sua"
LETTERS = "ABCDEFGHIJKL"


def _kinds(row: str) -> tuple[list[int], list[int]]:
    codes = [LETTERS.index(c) for c in row]
    return [c // 3 for c in codes], [c % 3 for c in codes]


@lru_cache(maxsize=50_000)
def search(row: str, entry: int = START, goal: int | None = None) -> tuple[int, str] | None:
    """(cost, edits) of the cheapest, ASCII-least path over the row's letters from the entry state.

    goal: the state to end in, with no insertion after the last letter; None: to accept, insertions at the end allowed.
    None if the goal can't be reached."""
    n = len(row)
    initial, fault = _kinds(row)
    # what the rows from i on cost at least, and how many rows of system among them would have to change
    forced, systems, keepable = [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
    for i in range(n - 1, -1, -1):
        sound = fault[i] == 0
        forced[i] = forced[i + 1] + (0 if sound and initial[i] < 3 else REROLE if sound else DELETE)
        systems[i] = systems[i + 1] + (sound and initial[i] == 0)
        keepable[i] = keepable[i + 1] or (fault[i] != 1 and initial[i] == 0)
    learned: dict[tuple[int, int], int] = {}
    path: list[str] = []

    def least(i: int, g: int) -> int:
        """A lower bound of what is left to pay."""
        if (i, g) in learned:
            return learned[i, g]
        if i == n:
            return INSERT * MISSING[g] if goal is None else 0 if g == goal else NEVER
        if (goal == START and g != START) or (goal == SYSTEM and (g > SYSTEM or (g == START and not keepable[i]))):
            return NEVER
        return forced[i] + systems[i] - (g == START and systems[i] > 0)

    def edits(i: int, g: int) -> Iterator[tuple[str, int, int, int]]:
        if i < n:
            yield "D", DELETE, i + 1, g
        if i < n or goal is None:
            yield "I", INSERT, i, NEXT[g]
        if i < n and fault[i] != 1:
            late = TRUNCATED if fault[i] == 2 else 0
            if g == START and initial[i] == 0:
                yield "K", KEEP + late, i + 1, SYSTEM
            elif initial[i] + 1 == NEXT[g]:
                yield "K", KEEP + late, i + 1, NEXT[g]
            yield "R", REROLE + late, i + 1, NEXT[g]

    def dive(i: int, g: int, budget: int) -> bool:
        if i == n and least(i, g) == 0:
            return True
        over = NEVER
        for letter, cost, j, to in edits(i, g):
            need = cost + least(j, to)
            if need <= budget:
                path.append(letter)
                if dive(j, to, budget - cost):
                    return True
                path.pop()
                need = cost + least(j, to)
            over = min(over, need)
        learned[i, g] = over
        return False

    bound = least(0, entry)
    while bound < NEVER:
        if dive(0, entry, bound):
            return bound, "".join(path)
        bound = least(0, entry)
    return None


def _ranks(paths: list) -> list[int]:
    """The place of each path among those of its entry state; -1 where there is none."""
    known = sorted(p for p in paths if p is not None)
    return [-1 if p is None else known.index(p) for p in paths]


class Table:
    """Costs and path order from each entry to each exit state, sixteen each, of a run of rows."""

    def __init__(self, cost: list[int], rank: list[int], head: int, tail: int, illegal: int):
        self.cost, self.rank, self.head, self.tail, self.illegal = cost, rank, head, tail, illegal

    def then(self, other: Table) -> tuple[Table, list[int]]:
        """The two composed, and the state between them for each entry and exit."""
        cost, rank, via = [], [], []
        for g in STATES:
            keys = []
            for h in STATES:
                ways = [
                    (self.cost[4 * g + m] + other.cost[4 * m + h], self.rank[4 * g + m], m)
                    for m in STATES
                    if self.cost[4 * g + m] < NEVER and other.cost[4 * m + h] < NEVER
                ]
                best = min(ways, default=(NEVER, 0, -1))
                cost.append(best[0])
                via.append(best[2])
                keys.append((best[1], other.rank[4 * best[2] + h]) if ways else None)
            rank += _ranks(keys)
        border = not legal(self.tail, other.head)
        return Table(cost, rank, self.head, other.tail, self.illegal + other.illegal + border), via


def legal(a: int, b: int) -> bool:
    """Whether initials (places in INITIALS) may follow each other: su, ua, au."""
    return (a, b) in ((0, 1), (1, 2), (2, 1))


def _illegal(initials: list[int]) -> int:
    return sum(not legal(a, b) for a, b in zip(initials, initials[1:], strict=False))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given another role, by crc32(conv_id:turn) mod 20."""
    narrow = columns(conversations, "conv_id", "turn", "role", "text")
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    place = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    hit = F.crc32(place.cast("binary")) % 20
    rows = narrow.select("conv_id", "turn", role.alias("role"), text.alias("text"), hit.alias("hit")).filter("hit != 0")
    cut = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), cut.alias("text"), "hit")
    copies = F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.withColumn("copy", copies).drop("hit", "copy")


def conversation_key(conv_id: Column) -> Column:
    """A text that is never null, so that a null conversation joins as others do."""
    return F.coalesce(F.concat(F.lit("v"), conv_id.cast("string")), F.lit("n"))


def ordered(conversations: DataFrame) -> DataFrame:
    """conv, turn, role, text, digest, pos (rising in the order of rows), block: rows of one (conv, block) are neighbours, SEGMENT at most."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(conversation_key(F.col("conv_id")).alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    # the last sort key cuts a run of equal rows too
    rows = rows.withColumn("digest", F.sha2("text", 256)).withColumn("row", F.monotonically_increasing_id())
    keys = ["conv", "turn", "role", "digest", "row"]
    rows = rows.repartitionByRange(parts(rows), *keys).sortWithinPartitions(*keys).drop("row")
    rows = stored(rows.withColumn("pos", F.monotonically_increasing_id()), "repair-rows")
    inside = F.col("pos").bitwiseAND(F.lit((1 << 33) - 1))
    per = (rows.agg(F.max(inside).alias("n")).first()["n"] or 0) // SEGMENT + 1
    return rows.withColumn("block", F.shiftright("pos", 33) * per + F.floor(inside / SEGMENT))


def faults(rows: DataFrame) -> DataFrame:
    """conv, turn, pos, block, role, fault: blank, duplicate, truncated or null."""
    body = F.rtrim("text", F.lit(WHITE))
    narrow = rows.select("conv", "turn", "pos", "block", "role", "digest", F.substring(body, -1, 1).alias("last"))
    seen = narrow.filter("last != ''").groupBy("conv", "role", "digest").agg(F.min("pos").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = bounded_join(narrow, seen, ["conv", "role", "digest"], "left", salt_by=["pos"])
    fault = F.when(F.col("last") == "", "blank").when(F.col("pos") > F.col("first"), "duplicate").when(~F.col("last").isin(".", "!", "?"), "truncated")
    return joined.select("conv", "turn", "pos", "block", "role", fault.alias("fault"))


def segments(marked: DataFrame) -> DataFrame:
    """conv, block, first (position), letters: a row per segment."""
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(F.col("fault").isNull(), 0).when(F.col("fault") == "truncated", 2).otherwise(1)
    letter = F.substring(F.lit(LETTERS), (3 * code + fault + 1).cast("int"), F.lit(1))
    lettered = marked.select("conv", "block", "pos", letter.alias("letter"))
    cells = F.array_sort(F.collect_list(F.struct("pos", "letter")))  # SEGMENT cells at most
    found = lettered.groupBy("conv", "block").agg(F.min("pos").alias("first"), cells.alias("cells"))
    return found.select("conv", "block", "first", F.array_join(F.transform("cells", lambda c: c["letter"]), "").alias("letters"))


_LINES = "lines array<struct<before: array<string>, role: string>>, after array<string>"


def outline(letters: str, edits: str, entry: int) -> tuple[list[dict], list[str]]:
    """(what each row becomes: roles inserted before it, and its own: '=' as it was, null deleted; roles inserted after the last)."""
    initial, _ = _kinds(letters)
    lines, before, state, at = [], [], entry, 0
    for edit in edits:
        if edit == "I":
            before.append(NEEDED[state])
            state = NEXT[state]
            continue
        role = None
        if edit == "K":
            role, state = "=", SYSTEM if initial[at] == 0 else NEXT[state]
        elif edit == "R":
            role, state = NEEDED[state], NEXT[state]
        lines.append({"before": before, "role": role})
        before, at = [], at + 1
    return lines, before


_SOLVED = "conv string, block long, first long, cost long, audit string, " + _LINES


def _solved(found: list[tuple]) -> pa.RecordBatch:
    """found: (conv, block, first, cost, edits, letters, entry)."""
    outlines = [outline(x[5], x[4], x[6]) for x in found]
    kind = pa.list_(pa.struct([("before", pa.list_(pa.string())), ("role", pa.string())]))
    return pa.record_batch(
        {
            "conv": pa.array([x[0] for x in found], pa.string()),
            "block": pa.array([x[1] for x in found], pa.int64()),
            "first": pa.array([x[2] for x in found], pa.int64()),
            "cost": pa.array([x[3] for x in found], pa.int64()),
            "audit": pa.array([x[4] for x in found], pa.string()),
            "lines": pa.array([x[0] for x in outlines], kind),
            "after": pa.array([x[1] for x in outlines], pa.list_(pa.string())),
        }
    )


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of one segment."""
    for batch in batches:
        found, wrong = [], []
        for row in batch.to_pylist():
            cost, edits = search(row["letters"])
            found.append((row["conv"], row["block"], row["first"], cost, edits, row["letters"], START))
            wrong.append(_illegal(_kinds(row["letters"])[0]))
        out = _solved(found)
        yield pa.RecordBatch.from_arrays([*out.columns, pa.array(wrong, pa.int64())], names=[*out.schema.names, "illegal"])


_TABLE = "cost array<long>, rank array<int>, head int, tail int, illegal long"


def _table_columns(tables: list[Table]) -> dict[str, pa.Array]:
    return {
        "cost": pa.array([t.cost for t in tables], pa.list_(pa.int64())),
        "rank": pa.array([t.rank for t in tables], pa.list_(pa.int32())),
        "head": pa.array([t.head for t in tables], pa.int32()),
        "tail": pa.array([t.tail for t in tables], pa.int32()),
        "illegal": pa.array([t.illegal for t in tables], pa.int64()),
    }


def _tabled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of longer conversations, searched between all states."""
    for batch in batches:
        tables, audits = [], []
        for letters in batch.column("letters").to_pylist():
            ways = [search(letters, g, h) for g in STATES for h in STATES]
            texts = [w and w[1] for w in ways]
            rank = sum((_ranks(texts[4 * g : 4 * g + 4]) for g in STATES), [])
            initial, _ = _kinds(letters)
            tables.append(Table([w[0] if w else NEVER for w in ways], rank, initial[0], initial[-1], _illegal(initial)))
            audits.append(texts)
        cols = _table_columns(tables) | {"audits": pa.array(audits, pa.list_(pa.string()))}
        yield pa.RecordBatch.from_arrays([*batch.columns, *cols.values()], names=[*batch.schema.names, *cols])


def _folded(kids: list[dict]) -> tuple[Table, list[list[int]]]:
    """The tables of neighbours composed, from the left, and the states between at each step."""
    made = [Table(k["cost"], k["rank"], k["head"], k["tail"], k["illegal"]) for k in kids]
    whole, vias = made[0], []
    for other in made[1:]:
        whole, via = whole.then(other)
        vias.append(via)
    return whole, vias


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tables = [_folded(kids)[0] for kids in batch.column("kids").to_pylist()]
        cols = _table_columns(tables)
        yield pa.RecordBatch.from_arrays([*batch.columns, *cols.values()], names=[*batch.schema.names, *cols])


_PLACED = "conv string, block long, entry int, exit int, last boolean"


def _placed(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
    return pa.record_batch({n: pa.array([x[k] for x in found], kinds[k]) for k, n in enumerate(("conv", "block", "entry", "exit", "last"))})


def _topped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole conversations begin at START; they end where all is cheapest, then ASCII-least."""
    for batch in batches:
        found = []
        for conv, block, cost, rank in zip(*(batch.column(c).to_pylist() for c in ("conv", "block", "cost", "rank")), strict=True):
            end = min((cost[h] + INSERT * MISSING[h], rank[h], h) for h in STATES if cost[h] < NEVER)[2]
            found.append((conv, block, START, end, True))
        yield _placed(found)


def _lowered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entry and exit of each part of a run whose own are known."""
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            kids = row["kids"]
            border = [row["exit"]]
            for via in reversed(_folded(kids)[1]):
                border.append(via[4 * row["entry"] + border[-1]])
            border = [row["entry"], *reversed(border)]
            for k, kid in enumerate(kids):
                found.append((row["conv"], kid["block"], border[k], border[k + 1], row["last"] and k == len(kids) - 1))
        yield _placed(found)


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            way, extra = 4 * row["entry"] + row["exit"], MISSING[row["exit"]] if row["last"] else 0
            found.append((row["conv"], row["block"], row["first"], row["cost"][way] + INSERT * extra, row["audits"][way] + "I" * extra, row["letters"], row["entry"]))
        yield _solved(found)


def solved(found: DataFrame, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """(conv, block, first, cost, audit, lines, after of each segment; conv, illegal of each conversation)."""
    many = found.groupBy("conv").agg(F.count("*").alias("n")).filter("n > 1").select("conv", F.lit(True).alias("many"))
    told = bounded_join(found, many, ["conv"], "left", salt_by=["block"])
    whole = stored(told.filter("many is null").drop("many").mapInArrow(_whole, _SOLVED + ", illegal long"), "repair-whole")
    leaves = told.filter("many").drop("many").mapInArrow(_tabled, f"conv string, block long, first long, letters string, {_TABLE}, audits array<string>")
    leaves = stored(leaves, "repair-leaves")
    fields = ("block", "cost", "rank", "head", "tail", "illegal")
    level, levels = leaves.select("conv", *fields), []
    while not levels or not level.groupBy("conv").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        runs = level.groupBy("conv", F.floor(F.col("block") / fan).alias("run")).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("kids"))
        runs = runs.select("conv", F.col("run").alias("block"), "kids")
        kids = runs.schema["kids"].dataType.simpleString()
        levels.append(stored(runs.mapInArrow(_composed, f"conv string, block long, kids {kids}, {_TABLE}"), "repair-level"))
        level = levels[-1].select("conv", *fields)
    placed = level.mapInArrow(_topped, _PLACED)
    for above in reversed(levels):
        placed = above.select("conv", "block", "kids").join(placed, ["conv", "block"]).mapInArrow(_lowered, _PLACED)
    taken = leaves.select("conv", "block", "first", "letters", "cost", "audits").join(placed, ["conv", "block"]).mapInArrow(_chosen, _SOLVED)
    illegal = whole.select("conv", "illegal").unionByName(level.select("conv", "illegal"))
    return stored(whole.drop("illegal").unionByName(taken), "repair-edits"), illegal


def repaired_rows(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """conv, pos, part, role, text: the repaired conversations' rows, in the order of (pos, part)."""
    joined = rows.select("conv", "pos", "block", "role", "text").join(edits.select("conv", "block", "first", "lines", "after"), ["conv", "block"])
    line = F.element_at("lines", (F.col("pos") - F.col("first") + 1).cast("int"))
    joined = joined.withColumn("line", line).withColumn("ends", F.col("pos") - F.col("first") + 1 == F.size("lines"))
    own = F.when(F.col("line.role") == "=", F.col("role")).otherwise(F.col("line.role"))

    def empty(roles: Column) -> Column:
        return F.transform(roles, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))

    none = F.filter(empty(F.col("after")), lambda r: F.lit(False))
    made = F.concat(
        empty(F.col("line.before")),
        F.when(F.col("line.role").isNull(), none).otherwise(F.array(F.struct(own.alias("role"), F.col("text").alias("text")))),
        F.when(F.col("ends"), empty(F.col("after"))).otherwise(none),
    )
    return joined.select("conv", "pos", F.posexplode(made).alias("part", "made")).select("conv", "pos", "part", "made.role", "made.text")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted; a conversation's lines go through one hash."""
    conv, digest = None, None

    def out() -> pa.RecordBatch:
        return pa.record_batch({"conv": pa.array([conv]), "repaired_sha256": pa.array([digest.hexdigest()])})

    for batch in batches:
        for now, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text")), strict=True):
            if now != conv:
                if digest:
                    yield out()
                conv, digest = now, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
    if digest:
        yield out()


def repair_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(report, rows): a row per conversation that has rows: conv (its key), gaps, blank, duplicate, truncated, illegal, cost, audit;
    and the repaired rows: conv, pos, part, role, text."""
    rows = ordered(columns(conversations, "conv_id", "turn", "role", "text"))
    marked = stored(faults(rows), "repair-marks")
    turn = F.col("turn").cast("decimal(20,0)")
    gaps = F.coalesce((F.max(turn) - F.min(turn) + 1 - F.countDistinct("turn")).cast("long"), F.lit(0))
    counts = [F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")]
    edits, illegal = solved(stored(segments(marked), "repair-segments"))
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit")
    costs = edits.groupBy("conv").agg(F.sum("cost").alias("cost"), audit)
    report = marked.groupBy("conv").agg(gaps.alias("gaps"), *counts).join(illegal, "conv").join(costs, "conv")
    return report, repaired_rows(rows, edits)


def repair_digests(conversations: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """A row per conv_id of conversations: the report on found (conversations themselves if not given) and the hash of the repaired rows."""
    report, rows = repair_conversations(conversations if found is None else found)
    lines = rows.repartition(parts(rows), "conv").sortWithinPartitions("conv", "pos", "part").select("conv", "role", "text")
    hashes = lines.mapInArrow(_hashed, "conv string, repaired_sha256 string")
    kind = conversations.schema["conv_id"].dataType
    every = conversations.select(conversation_key(F.col("conv_id")).alias("conv")).distinct()
    joined = every.join(report, "conv", "left").join(hashes, "conv", "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        F.when(F.col("conv") != "n", F.substring("conv", 2, 1 << 30)).cast(kind).alias("conv_id"),
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def op13_conversation_repair(spark, sf_dir) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    return repair_digests(conversations, damaged(conversations))
