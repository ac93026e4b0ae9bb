import hashlib
import heapq
import random
import re
import zlib

import pytest

from tidewell.llm.turn_repair import EMPTY, TRIPLES, damage, leaf, parse, repair, repaired_turns

KIND = "conv_id long, turn long, role string, text string, lost string"
ROLES = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}


def cheapest(rows):
    """(cost, audit, repaired turns) by search over edits: rows are (role, text, must go, truncated)."""
    heap, seen = [(0, "", 0, 0, ())], {}
    while heap:
        cost, audit, at, phase, made = heapq.heappop(heap)
        if seen.get((at, phase), (cost, audit)) < (cost, audit):
            continue
        seen[at, phase] = cost, audit
        if at == len(rows) and phase in (0, 3):
            return cost, audit, made
        new, to = ("assistant", 3) if phase == 2 else ("user", 2)
        heapq.heappush(heap, (cost + 3, audit + "I", at, to, (*made, (new, ""))))
        if at < len(rows):
            role, text, gone, truncated = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, phase, made))
            if not gone:
                more = 3 * truncated
                heapq.heappush(heap, (cost + 3 + more, audit + "R", at + 1, to, (*made, (new, text))))
                if role[:1] == new[0]:
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, to, (*made, (role, text))))
                if phase == 0 and role[:1] == "s":
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, 1, (*made, (role, text))))


def brute(rows):
    """rows as in the table, damaged, faults found, repaired: all in plain loops."""
    out = {}
    for c in {r[0] for r in rows}:
        kept = []
        for conv, turn, role, text in (r for r in rows if r[0] == c):
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [] if kind == 0 else [(turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        counts, seen, given = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, role, text in kept:
            bare = text.strip("\x20\t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            given.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, *_ in kept if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit, made = cheapest(given)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha)
    return out


def made_up(rng, conversations):
    texts = ["Yes.", "No!", "So", "and then", "", " \t\n", "What? ", "Fine.\n", None, "x" * 50, "中文。", "ok."]
    rows = []
    for c in conversations:
        for turn in range(rng.choice([0, 1, 2, 3, 5, 8, 20])):
            turn = rng.choice([turn, turn, turn, turn, turn * 2, None])
            rows.append((c, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice(texts)))
    return rows + rows[: len(rows) // 20]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], KIND)


@pytest.mark.parametrize("sizes", [(1024, 1 << 20), (3, 20)])
def test_same_as_brute_force(spark, sizes):
    rows = made_up(random.Random(8), [None, *range(150)])
    got = repair(damage(frame(spark, rows).repartition(3)), sizes).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == brute(rows) and len(got) == len(brute(rows))


def test_one_conversation_in_many_parts(spark):
    rng = random.Random(9)
    rows = [(1, i // 2, rng.choice(["user", "assistant"]), rng.choice(["Again.", f"Turn {i}.", f"cut {i}"])) for i in range(5000)] + [(1, 7, "user", "The same.")] * 3000 + [(2, 0, "user", "Hi.")]
    df = damage(frame(spark, rows).repartition(7)).cache()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.conv_id: tuple(r)[1:] for r in repair(df).collect()}
        turns = repaired_turns(df.filter("conv_id = 1")).orderBy("position").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute(rows)
    assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in turns).encode()).hexdigest() == got[1][-1] and [r.position for r in turns] == list(range(len(turns)))
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in turns))


def all_splits(symbols):
    """Cells of all spans, each from all ways to cut it: the cubic form of the same parse."""
    n, cells = len(symbols), {}
    for size in range(1, n + 1):
        for i in range(n - size + 1):
            if size == 1:
                cells[i, i + 1] = leaf(symbols[i])
                continue
            best = {}
            for k in range(i + 1, i + size):
                left, right = cells[i, k], cells[k, i + size]
                for p, q, r in TRIPLES:
                    if (p, q) in left and (q, r) in right:
                        made = (left[p, q][0] + right[q, r][0], left[p, q][1] + right[q, r][1])
                        best[p, r] = min(best.get((p, r), made), made)
            cells[i, i + size] = best
    return cells[0, n] if n else EMPTY


def test_one_cut_a_span_is_enough():
    rng = random.Random(10)
    for n in [*range(0, 9), 17, 24]:
        for _ in range(12):
            symbols = "".join(rng.choice("suaxSUAXd") for _ in range(n))
            assert parse(symbols) == all_splits(symbols)


def test_lost_and_none(spark):
    rows = [(1, t, "user", "Hi.") for t in range(40) if zlib.crc32(f"1:{t}".encode()) % 20 == 0]
    assert [tuple(r)[1:] for r in repair(damage(frame(spark, rows))).collect()] == [(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair(damage(frame(spark, []))).count() == 0 and repaired_turns(damage(frame(spark, []))).count() == 0
