"""The trie of conversations against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from riskstream.llm import prefix_trie
from riskstream.llm.common import Scratch
from riskstream.llm.queries import op12_prefix_trie
from tests.conftest import TESTDATA

ROWS = "conv_id long, turn long, role string, text string"
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
]


def said(role, text):
    """The digest that orders turns of one place and role."""
    return hashlib.sha256(f"{len(role)}\0{role}\0{text}".encode()).digest()[:16]


def brute(rows):
    original = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            original[conv].append((turn, role or "", text or ""))
    for own in original.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], said(r[1], r[2])))
    members = defaultdict(set)
    ends = defaultdict(list)
    for conv, own in original.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (abs(conv) % 20) * (1 if conv > 0 else -1)
        turns = tuple(t[1:] for t in original.get(base, [])[:h] + own[h:])
        for depth in range(len(turns) + 1):
            members[turns[:depth]].add(conv)
        ends[turns].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        kids = [totals[k] for k in children[node]]
        totals[node] = (
            sum(k[0] for k in kids) or 1, (len(members[node]) - 1) * words + sum(k[1] for k in kids)
        )
    return sorted(
        (
            min(members[node]), len(node), min(members[node[:-1]]) if node else -1 << 70,
            len(members[node]), len(children[node]), *totals[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node in members
    )


def results(frame):
    assert frame.columns == COLUMNS
    rows = [tuple(r) for r in frame.collect()]
    return sorted((*r[:2], -1 << 70 if r[2] is None else r[2], *r[3:]) for r in rows)


def trie(frame, **sizes):
    scratch = Scratch(frame.sparkSession, "trie")
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(frame, scratch), scratch, **sizes)


def test_query_equals_brute_force(spark):
    folder = f"{TESTDATA}/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    assert results(op12_prefix_trie(spark, folder)) == brute(rows)


def odd_rows():
    """Shared beginnings, copies, nulls, ties, repeats, negative ids, a long conversation."""
    draw = random.Random(12)
    rows = []
    for conv in [*range(0, 400, 3), *range(-45, 0, 4)]:
        for turn in range(draw.randrange(0, 6)):
            rows.append((conv, turn, draw.choice(["user", "assistant"]), draw.choice("ab") + " c"))
    for conv in range(1000, 1300):  # one conversation many times
        rows += [(conv, t, "user", f"same words {t}") for t in range(5)]
    rows += [(2000, t, "user", f"turn {t % 7}") for t in range(90)]
    rows += [(2020, t, "user", f"turn {t % 7}") for t in range(60)]
    odd = [None, "", " \t", "x y  z", "é　w"]
    rows += [
        (draw.choice([None, 3000, 3001, 3020]), draw.choice([None, 1, 1, 2, -5]),
         draw.choice([None, "", "user"]), draw.choice(odd))
        for _ in range(60)
    ]
    return rows


@pytest.mark.parametrize(
    "sizes", [{}, {"block": 3, "bits": 1, "queue": 2, "ids": 4}, {"block": 64, "bits": 3, "queue": 7}]
)
def test_odd_rows_in_small_blocks_and_pieces(spark, sizes):
    rows = odd_rows()
    frame = spark.createDataFrame(rows, ROWS).repartition(5)
    assert results(trie(frame, **sizes)) == brute(rows)


def test_conversations_without_turns(spark):
    # A checksum above 0 and a group whose first conversation is absent.
    conv = next(c for c in range(41, 60) if zlib.crc32(str(c).encode()) % 4 >= 1)
    rows = [(conv, 0, "user", "gone")]
    found = results(trie(spark.createDataFrame(rows, ROWS)))
    assert found == brute(rows) and len(found) == 1 and found[0][5] == 1


def test_empty_table_and_clashing_names(spark):
    more = "node long, depth string, piece long, n_convs long, h long, base long, part long"
    assert trie(spark.createDataFrame([], f"{ROWS}, {more}")).collect() == []
    rows = [(20, 0, "user", "a", 1, "b", 2, 3, 4, 5, 6)]
    found = results(trie(spark.createDataFrame(rows, f"{ROWS}, {more}")))
    assert found == brute([row[:4] for row in rows])


def test_queue_spills_and_adds_up():
    draw = random.Random(4)
    nodes = [(d, bytes([n]) * 16) for d in range(6) for n in range(9)]
    sent, queue = defaultdict(lambda: [0, 0, 0]), prefix_trie.Queue(5)
    for depth in range(5, -1, -1):
        for _ in range(80):
            node = draw.choice([n for n in nodes if n[0] == depth])
            totals = tuple(draw.randrange(9) for _ in range(3))
            queue.send(*node, totals)
            sent[node] = [a + b for a, b in zip(sent[node], totals, strict=True)]
        for node in sorted((n for n in nodes if n[0] == depth), key=lambda n: n[1]):
            found = queue.receive(*node)
            assert [sum(c) for c in zip(*found, strict=True)] or [0, 0, 0] == sent[node]
    assert not queue.heap and not queue.runs
