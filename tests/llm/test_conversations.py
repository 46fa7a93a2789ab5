"""Repairs against trying all edits, the query against a plain reading of its rules, and bounded memory."""

import hashlib
import itertools
import random
import re
import time
import zlib

import pytest

from gleaner.llm.conversations import Search, damage, repair_digests, repaired_turns

WS = " \t\n\x0b\x0c\r"
GOOD = re.compile("(s?(ua)+)?")


def all_repairs(rows):
    """rows: (role, text, must_go, truncated) -> cheapest (cost, letters, turns)."""
    gaps = ["", "u", "a", "ua"]
    options = []
    for role, text, must_go, truncated in rows:
        kinds = [(3, "D", None)]
        if not must_go:
            kinds += [(truncated, "K", (role, text)), (2 + truncated, "R", ("user", text)), (2 + truncated, "R", ("assistant", text))]
        options.append(kinds)
    best = None
    for edits in itertools.product(*options):
        for inserted in itertools.product(gaps, repeat=len(rows) + 1):
            cost, letters, turns = 0, "", []
            for k, gap in enumerate(inserted):
                for c in gap:
                    cost, letters = cost + 2, letters + "I"
                    turns.append(("user" if c == "u" else "assistant", ""))
                if k < len(edits):
                    cost, letters = cost + edits[k][0], letters + edits[k][1]
                    turns += [edits[k][2]] if edits[k][2] else []
            if (best is None or (cost, letters) < best[:2]) and all(t[0] for t in turns) and GOOD.fullmatch("".join(t[0][0] for t in turns)):
                best = (cost, letters, turns)
    return best


def searched(rows):
    edits = []
    search = Search(lambda letter, turn: edits.append((letter, turn)))
    for row in rows:
        search.row(*row)
    cost = search.finish()
    return cost, "".join(e[0] for e in edits), [e[1] for e in edits if e[1]]


@pytest.mark.parametrize("seed", range(4))
def test_all_short_conversations(seed):
    rng = random.Random(seed)
    for _ in range(40):
        rows = [(rng.choice(["user", "assistant", "system", "tool", ""]), f"t{i}", rng.random() < 0.2, rng.random() < 0.4) for i in range(rng.randint(0, 3))]
        assert searched(rows) == all_repairs(rows), rows


def backwards(rows):
    """Cost and letters by the best remainder from each state, from the last row on."""
    after = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}

    def insertions(rest):
        for _ in range(3):
            for state in range(4):
                for c in "ua":
                    to = after[c].get(state)
                    if to is not None and to in rest:
                        new = (rest[to][0] + 2, "I" + rest[to][1])
                        if state not in rest or new < rest[state]:
                            rest[state] = new
        return rest

    rest = insertions({0: (0, ""), 3: (0, "")})
    for role, _, must_go, truncated in reversed(rows):
        new = {}
        for state in range(4):
            ways = [(rest[state][0] + 3, "D" + rest[state][1])] if state in rest else []
            if not must_go:
                for letter, initial, cost in (("K", role[:1], 0), ("R", "u", 2), ("R", "a", 2)):
                    to = after.get(initial, {}).get(state)
                    if to in rest:
                        ways.append((rest[to][0] + cost + truncated, letter + rest[to][1]))
            if ways:
                new[state] = min(ways)
        rest = insertions(new)
    return rest[0]


@pytest.mark.parametrize("seed", range(5))
def test_longer_conversations(seed):
    rng = random.Random(seed)
    roles = [["user", "assistant"], ["system"], ["user", "assistant", "system", "tool"], ["assistant"], ["user"]][seed]
    for _ in range(60):
        rows = [(rng.choice(roles), "x", rng.random() < 0.1, rng.random() < rng.choice([0, 0.5, 1])) for _ in range(rng.randint(4, 60))]
        assert searched(rows)[:2] == backwards(rows)


@pytest.mark.parametrize("truncated", [False, True])
@pytest.mark.parametrize("roles", ["ua", "s", "a", "u", "x", "uuas"])
def test_long_conversations(roles, truncated):
    names = {"u": "user", "a": "assistant", "s": "system", "x": "xenon"}
    most, start = 0, time.time()
    search = Search(lambda letter, turn: None)
    for i in range(20_000):
        search.row(names[roles[i % len(roles)]], "x", False, truncated)
        most = max(most, search.unresolved)
    search.finish()
    assert time.time() - start < 20
    # in rows of one role only the end decides where an insertion goes or whether all are deleted
    assert most < 60 or len(roles) == 1 and most < 5 * 20_000


def expected(rows):
    """A plain reading of the contract for rows (conv, turn, role, text)."""
    by_conv = {}
    for conv, turn, role, text in rows:
        out = by_conv.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    want = []
    for conv, out in by_conv.items():
        out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, flags, counts = set(), [], [0, 0, 0]
        for _, role, text in out:
            inner = text.strip(WS)
            fault = 0 if not inner else 1 if (role, text) in seen else 2 if inner[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                counts[fault] += 1
            flags.append((role, text, fault in (0, 1), fault == 2))
        turns = [t for t, _, _ in out if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(out, out[1:], strict=False))
        cost, letters = backwards(flags)
        repaired = searched(flags)
        assert repaired[:2] == (cost, letters)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired[2]).encode()).hexdigest()
        want.append((conv, gaps, *counts, illegal, cost, letters, digest))
    return sorted(want, key=repr)


def test_query_rows(spark):
    rng = random.Random(3)
    rows = []
    for conv in [*range(60), None]:
        for turn in [*range(rng.randint(1, 9)), *([None] if rng.random() < 0.2 else [])]:
            text = rng.choice(["Hello.", "Is it?", "no end", None, "", "\t \r", "Ja!\n", "word. and\n", "x" * 50_000 + ".", "é"])
            rows.append((conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]), text))
    rows += rows[5:9]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, present string")
    got = repair_digests(damage(frame.repartition(5)))
    assert got.columns[1:] == "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)
    turns = repaired_turns(damage(frame)).orderBy("conv", "place").collect()
    letters = {}
    for r in turns:
        letters[r["conv"]] = letters.get(r["conv"], "") + r["edit"]
    assert {c: a for c, a in letters.items() if a} == {r[0]: r[7] for r in expected(rows) if r[7]}
    assert repair_digests(damage(frame.limit(0))).collect() == []


def test_given_table(spark):
    from gleaner.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, QUERIES["op13_conversation_repair"](spark, "/root/testdata/sf0.01").collect()), key=repr) == expected(rows)
