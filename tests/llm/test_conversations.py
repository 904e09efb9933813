"""Repairs against an exhaustive search, piece by piece and whole."""

import hashlib
import heapq
import random

import pytest

from evenledger.llm.conversations import CLOSED, auction, repair, solve

SCHEMA = "conv_id long, turn long, role string, text string, here boolean, copies long, cost string"
SPACES = " \t\n\x0b\x0c\r"


def by_hand(rows):
    """The result of one conversation from (turn, role, text) rows, by Dijkstra over (row, roles so far) with whole strings."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        solid = text.strip(SPACES)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
    turns = {r[0] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, shape, out = heapq.heappop(heap)
        if i == len(rows) and (not shape or shape[-1] == "a"):
            return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, "\n".join(out)
        if (i, shape[-1:]) in done:
            continue
        done.add((i, shape[-1:]))

        def grow(initial):
            legal = {"": "su", "s": "u", "u": "a", "a": "u"}[shape[-1:]]
            return initial in legal and len(initial) == 1

        for role in ("user", "assistant"):
            if grow(role[0]):
                heapq.heappush(heap, (cost + 2, audit + "I", i, shape + role[0], (*out, f"{role}:")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, shape, out))
            if faults[i] in (None, "truncated"):
                more = faults[i] == "truncated"
                if grow(role[:1]):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, shape + role[0], (*out, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if grow(new[0]):
                        heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, shape + new[0], (*out, f"{new}:{text}")))
    raise AssertionError


def made(seed, n):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "u"]
    texts = ["Yes.", "No!", "cut", " ", "", "Why? \n", "end.", "more, "]
    return [(rng.choice([None, *range(n)]), rng.choice(roles), rng.choice(texts) + rng.choice(["", "", f"{rng.randrange(n)}."])) for _ in range(n)]


def checked(spark, groups, **options):
    given = [(k, t, r, x, True, 1, "clash") for k, rows in groups.items() for t, r, x in rows]
    got = {r.conv_id: r for r in repair(spark.createDataFrame(given, SCHEMA), **options).collect()}
    assert len(got) == len(groups)
    for k, rows in groups.items():
        *want, text = by_hand(rows)
        assert tuple(got[k])[1:] == (*want, hashlib.sha256(text.encode()).hexdigest()), (k, rows)


def test_against_search(spark):
    checked(spark, {k: made(k, 1 + k % 9) for k in range(300)})


@pytest.mark.parametrize("piece_rows", [1, 3, 50])
def test_pieces_join(spark, piece_rows):
    checked(spark, {None: made(0, 40), **{k: made(k, 1 + k * 3 % 60) for k in range(1, 25)}}, piece_rows=piece_rows)


def test_prices_are_distances():
    rng = random.Random(5)
    for _ in range(200):
        signature = "".join(rng.choice("suao") + rng.choice("-tx") for _ in range(rng.randrange(6)))
        whole = solve(signature)
        cut = rng.randrange(len(signature) // 2 + 1) * 2
        rest = tuple(x[0] if x else 1 << 60 for x in solve(signature[cut:]))
        assert [x and x[0] for x in solve(signature[:cut], rest, False)] == [x and x[0] for x in whole]
        prices = auction(signature, CLOSED, True)
        assert prices[-1] == 0 and all(p >= 0 for p in prices)


def test_absent_null_and_repeated_rows(spark):
    given = [
        (1, 0, "user", "gone", False, 1, ""),
        (2, 0, None, None, True, 1, ""),
        (3, 0, "user", "Hi.", True, 3, ""),
        (3, 1, "assistant", "Yes.", True, None, ""),
        (3, 5, "user", "Hi.", None, 1, ""),
        (4, None, "system", "Be.", True, 1, ""),
    ]
    got = {r.conv_id: r for r in repair(spark.createDataFrame(given, SCHEMA), present="here", copies="copies").collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert tuple(got[1]) == (1, 0, 0, 0, 0, 0, 0, "", empty)
    assert tuple(got[2]) == (2, 0, 1, 0, 0, 0, 3, "D", empty)
    assert tuple(got[3])[:8] == (3, 0, 0, 2, 0, 2, 6, "KDDK")
    assert got[4].audit == "D" and got[4].cost == 3
    assert repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_conversation(spark):
    rows = spark.range(9000).selectExpr(
        "1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "if(id = 4500, 'cut', concat('Text ', id, '.')) as text"
    )
    row = repair(rows).first()
    assert (row.cost, row.truncated, row.audit) == (1, 1, "K" * 9000)
    want = "\n".join(f"{'user' if k % 2 == 0 else 'assistant'}:" + ("cut" if k == 4500 else f"Text {k}.") for k in range(9000))
    assert row.repaired_sha256 == hashlib.sha256(want.encode()).hexdigest()
