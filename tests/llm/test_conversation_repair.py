"""The repair of conversations against a dynamic program over all edits, with nulls, ties, repeats and long conversations."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from meterloom.llm import conversation_repair as repair
from meterloom.llm import queries

WHITE = " \t\n\x0b\f\r"


def damage(rows):
    """The contract's damage, in plain Python."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def cheapest(rows):
    """(cost, edits) by a table over (rows left, grammar state): rows are (initial, fault)."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {}
    for i in range(len(rows), -1, -1):
        # insertions stay at i: state u and s come before a, which they lead to
        for state in ("a", "", "u", "s", "a", ""):
            ways = [(0, "")] if i == len(rows) and state in ("", "a") else []
            if i < len(rows):
                initial, fault = rows[i]
                late = 5 if fault == "truncated" else 0
                c, p = best[i + 1, state]
                ways.append((c + 2, "D" + p))
                if fault not in ("blank", "duplicate"):
                    if (state, initial) in after:
                        c, p = best[i + 1, after[state, initial]]
                        ways.append((c + late, "K" + p))
                    for new in "ua":
                        if (state, new) in after:
                            c, p = best[i + 1, after[state, new]]
                            ways.append((c + 1 + late, "R" + p))
            for new in "ua":
                if (state, new) in after and (i, after[state, new]) in best:
                    c, p = best[i, after[state, new]]
                    ways.append((c + 5, "I" + p))
            if (i, state) in best:
                ways.append(best[i, state])
            if ways:
                best[i, state] = min(ways)
    return best[0, ""]


def expected(rows, original=None):
    out = {}
    for conv in {r[0] for r in (original or rows)}:
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in own:
            body = text.rstrip(WHITE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
        initials = [role[:1] for _, role, _ in own]
        turns = [t for t, _, _ in own if t is not None]
        cost, audit = cheapest(list(zip(initials, faults, strict=True))) if own else (0, "")
        lines, at, state = [], 0, ""
        for edit in audit:
            needed = "assistant" if state == "u" else "user"
            role, text = needed, ""
            if edit != "I":
                role, text = (own[at][1] if edit == "K" else needed), own[at][2]
                at += 1
            if edit != "D":
                lines.append(f"{role}:{text}")
                state = role[:1]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in lines))
        wrong = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts, wrong, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r["conv_id"]: tuple(r[n] for n in names) for r in df.collect()}


def test_search_equals_the_table():
    kinds = {"blank": 1, "truncated": 2, None: 0}
    letter = {(i, f): repair.LETTERS[3 * "sua?".index(i) + k] for i in "sua?" for f, k in kinds.items()}
    every = [list(x) for n in range(4) for x in product(letter, repeat=n)]
    some = random.Random(5)
    every += [[(some.choice("suuuaaa?"), some.choice((None, None, None, "truncated", "blank"))) for _ in range(some.randint(5, 60))] for _ in range(150)]
    for rows in every:
        assert repair.search("".join(letter[r] for r in rows)) == cheapest(rows), rows


def test_failed_states_are_not_entered_again():
    rows = "A" + "".join(random.Random(1).choices("ADEFGHI", k=repair.SEGMENT - 1))
    for g, h in product(repair.STATES, repeat=2):
        way = repair.search(rows, g, h)
        assert (way is None) == ((h == repair.START and g != h) or (h == repair.SYSTEM and g > h))


EDGE = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hello."), (1, 2, "assistant", "Hi!"), (1, 3, "user", "Hello."), (1, None, None, None),
    (2, 5, "assistant", "no end"), (2, 5, "assistant", "no end"), (2, 2, "tool", "x."), (2, 9, "", "y."),
    (3, None, "user", "a."), (3, None, "assistant", "b."), (4, 0, "user", " \n\t"), (4, 1, "user", "a b　"),
    (None, 0, "user", "q?"), (None, None, "assistant", "r."), (5, 0, "user", "word " * 50_000 + "."), (5, 1, "assistant", "ok."),
    (-7, -3, "user", "é ü."), (-7, 4, "assistant", "fine."), (6, 1, "system", "one."), (6, 2, "system", "two."), (6, 3, "user", "three."),
]
SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("harmed", [False, True])
def test_edge_cases(spark, harmed):
    rows = EDGE + [(100 + i, t, r, f"{i} {t}.") for i in range(60) for t, r in enumerate(("user", "assistant") * 2)]
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", block int, conv string, pos int").repartition(3)
    plain = [(c, t, *(" " if x is None else x for x in rest)) for c, t, *rest in rows]
    if harmed:
        assert found(repair.repair_digests(frame, repair.damaged(frame))) == expected(damage(rows), rows)
    else:
        assert found(repair.repair_digests(frame)) == expected(plain)


def test_long_conversations_are_composed(spark, monkeypatch):
    """Segments of four rows, composed three at a time: the same as one search over all."""
    some = random.Random(3)
    roles = ("system", "user", "user", "assistant", "assistant", "tool")
    rows = [(conv, t, some.choice(roles), some.choice(("a.", "b!", "c", "", "d?", f"e{t}.", f"f{t}."))) for conv, n in ((1, 400), (2, 90), (3, 3), (4, 17)) for t in range(n)]
    rows += [(5, 0, "user", "same.")] * 40
    rows += [(6, t, "system", "") for t in range(30)]
    monkeypatch.setattr(repair, "SEGMENT", 4)
    monkeypatch.setattr(repair.solved, "__defaults__", (3,))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    report, repaired = repair.repair_conversations(frame)
    assert found(repair.repair_digests(frame)) == expected(rows)
    assert {r["conv"] for r in repaired.collect()} <= {f"v{i}" for i in range(1, 7)}
    assert report.count() == 6


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair_digests(none, repair.damaged(none)).collect() == []
    dropped = spark.createDataFrame([(8, 0, "user", "a.")], SCHEMA)
    assert found(repair.repair_digests(dropped, dropped.limit(0))) == {8: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_query(spark, base):
    table = spark.read.parquet(f"{base}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.QUERIES["op13_conversation_repair"](spark, base)) == expected(damage(rows), rows)
