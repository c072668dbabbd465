"""Conversation repair against brute force."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from riskstream.llm import conversation_repair, edit_lattice
from riskstream.llm.common import Scratch
from riskstream.llm.edit_lattice import Turn
from riskstream.llm.queries import op11_conversation_repair
from tests.conftest import TESTDATA

ROWS = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def cheapest(turns, ends=("",), start=""):
    """Least (cost, audit) over all edits, by what may follow each prefix of the grammar.

    The state is the last role initial kept or inserted ('' before any).
    """
    after = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, state, inserts):
        found = [(0, "")] if i == len(turns) and (state in ends) else []
        options = []
        if inserts < 3:
            options += [(2, "I", i, r, inserts + 1) for r in "ua"]
        if i < len(turns):
            initial, faulty, truncated = turns[i]
            options.append((3, "D", i + 1, None, 0))
            if not faulty:
                options += [(2 + truncated, "R", i + 1, r, 0) for r in "ua"]
                if initial and initial in "sua":
                    options.append((truncated + 0, "K", i + 1, initial, 0))
        for cost, edit, at, role, count in options:
            if role is not None and role not in after[state]:
                continue
            rest = best(at, state if role is None else role, count)
            if rest:
                found.append((cost + rest[0], edit + rest[1]))
        return min(found) if found else None

    return best(0, start, 0)


def random_turns(draw, most):
    return [
        Turn(draw.choice(["s", "u", "a", "u", "a", "x", ""]), draw.random() < 0.15, draw.random() < 0.2)
        for _ in range(draw.randrange(most))
    ]


@pytest.mark.parametrize("seed", range(20))
def test_both_ends_find_the_cheapest_and_least(seed):
    draw = random.Random(seed)
    for _ in range(60):
        turns = random_turns(draw, 11)
        assert edit_lattice.repair(turns) == cheapest(tuple(turns), ("", "a"))


def test_what_an_audit_leaves_is_legal():
    draw = random.Random(3)
    for _ in range(300):
        turns = random_turns(draw, 30)
        cost, audit = edit_lattice.repair(turns)
        rows = [(t.initial + "x" if t.initial else "", "t") for t in turns]
        left = edit_lattice.repaired(turns, rows, audit)
        assert GRAMMAR.fullmatch("".join(role[:1] for role, _ in left))
        stay = [t for t, e in zip(turns, audit.replace("I", ""), strict=True) if e != "D"]
        assert not any(t.faulty for t in stay)
        prices = {"K": 0, "R": 2, "D": 3, "I": 2}
        assert cost == sum(map(prices.get, audit)) + sum(t.truncated for t in stay)


def brute(rows, damage):
    """Every column of every conversation from plain rules."""
    found = {}
    conversations = {}
    for conv, turn, role, text in rows:
        conversations.setdefault(conv, []).append((turn, role or (" " if role is None else ""), " " if text is None else text))
    for conv, own in conversations.items():
        after = []
        for turn, role, text in own:
            name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind = zlib.crc32(name.encode()) % 20 if damage else -1
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            after += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        times = [t for t, _, _ in after if t is not None]
        counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        turns, seen = [], set()
        for _, role, text in after:
            said = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = None
            if not said:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif said[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            turns.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(
            a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False)
        )
        cost, audit = cheapest(tuple(turns), ("", "a"))
        lines, at, state = [], 0, ""
        for edit in audit:
            if edit in "RI":
                state = "a" if state == "u" else "u"
                role = {"u": "user", "a": "assistant"}[state]
                lines.append(f"{role}:{after[at][2] if edit == 'R' else ''}")
            elif edit == "K":
                state = after[at][1][:1]
                lines.append(f"{after[at][1]}:{after[at][2]}")
            at += edit != "I"
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        gaps = max(times) - min(times) + 1 - len(set(times)) if times else 0
        found[conv] = (gaps, *counts.values(), illegal, cost, audit, digest)
    return found


def results(frame):
    listed = frame.collect()
    by_id = {row[0]: tuple(row[1:]) for row in listed}
    assert len(by_id) == len(listed)
    return by_id


def test_query_equals_brute_force(spark):
    folder = f"{TESTDATA}/sf0.01"
    rows = spark.read.parquet(f"{folder}/conversations.parquet").collect()
    found = op11_conversation_repair(spark, folder)
    assert found.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        "repaired_sha256",
    ]
    assert results(found) == brute([tuple(r) for r in rows], True)


def odd_rows():
    """Nulls everywhere, ties, repeats, odd roles, a long text, dropped conversations, long ones."""
    draw = random.Random(11)
    texts = [None, "", " \t", "Yes.", "No!", "well", "Yes. ", "a\x0b", "?", "x" * 50_000 + "."]
    roles = [None, "", "user", "assistant", "system", "u", "User", "tool"]
    rows = [
        (draw.choice([None, 0, 1, 2, -7]), draw.choice([None, -3, 0, 1, 2, 3, 9]), draw.choice(roles),
         draw.choice(texts))
        for _ in range(150)
    ]
    rows += [(500 + k, 4, "user", "Alone.") for k in range(60)]  # some are dropped whole
    for conv in (900, 901, 902):
        rows += [
            (conv, k // 2 if conv == 901 else k * 3, draw.choice(["user", "assistant", "assistant"]),
             draw.choice(["One.", "two", f"No {k}.", f"{k}", " "]))
            for k in range(70)
        ]
    rows += [(903, 5, "user", "Same.")] * 45
    return rows


@pytest.mark.parametrize("damage", [True, False])
@pytest.mark.parametrize("blocks", [None, (20, 7), (1, 1)])
def test_odd_rows_and_long_conversations(spark, damage, blocks):
    rows = odd_rows()
    frame = spark.createDataFrame(rows, ROWS).repartition(7)
    prepared = (conversation_repair.damaged if damage else conversation_repair.undamaged)(frame)
    sizes = {} if blocks is None else {"long_rows": blocks[0], "block_rows": blocks[1]}
    found = conversation_repair.repair_conversations(prepared, Scratch(spark, "repair"), **sizes)
    assert results(found) == brute(rows, damage)


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], f"{ROWS}, cost long, audit string, copy int, dropped int")
    found = conversation_repair.repair_conversations(
        conversation_repair.damaged(empty), Scratch(spark, "repair")
    )
    assert found.collect() == []


def test_gaps_beyond_64_bits_are_null(spark):
    rows = [(1, -(1 << 63), "user", "A."), (1, (1 << 63) - 1, "assistant", "B.")]
    frame = conversation_repair.undamaged(spark.createDataFrame(rows, ROWS))
    found = conversation_repair.repair_conversations(frame, Scratch(spark, "repair")).collect()
    assert found[0].gaps is None and found[0].cost == 0 and found[0].audit == "KK"
