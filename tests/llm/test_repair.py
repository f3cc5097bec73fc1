"""Conversation structure repair against a search over plain strings."""

import collections
import hashlib
import heapq
import itertools
import random
import zlib

import pytest

from marginalia.llm import conversation_repair as cr

WS = " \t\n\x0b\x0c\r"
NEXT, NAME = {0: 2, 1: 2, 3: 2, 2: 3}, {2: "user", 3: "assistant"}


def cheapest(rows):
    """(cost, audit, lines) of (role, text, fault) rows by Dijkstra over (rows done, state), least text first."""
    done, heap, found = set(), [(0, "", 0, 0, ())], None
    while heap:
        cost, audit, i, s, lines = heapq.heappop(heap)
        if (i, s) in done:
            continue
        done.add((i, s))
        if i == len(rows) and s in (0, 3) and (found is None or (cost, audit) < found[:2]):
            found = cost, audit, lines
        n = NEXT[s]
        heapq.heappush(heap, (cost + 2, audit + "I", i, n, (*lines, NAME[n] + ":")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, s, lines))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, n, (*lines, f"{NAME[n]}:{text}")))
                if role[:1] == NAME[n][0]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, n, (*lines, f"{role}:{text}")))
                if role[:1] == "s" and s == 0:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, 1, (*lines, f"{role}:{text}")))
    return found


def brute(table):
    convs = collections.defaultdict(list)
    for conv, turn, role, text in table:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        convs[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [r[0] for r in rows if r[0] is not None]
        seen, faults = set(), []
        for _, role, text in rows:
            faults.append("blank" if not text.strip(WS) else "duplicate" if (role, text) in seen else "" if text.rstrip(WS)[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [r[1][:1] for r in rows]
        cost, audit, lines = cheapest([(r, t, f) for (_, r, t), f in zip(rows, faults, strict=True)])
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(rng):
    out = []
    for conv in [*range(60), None]:
        for t in range(rng.randint(1, 14)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ASSISTANT", "u"])
            text = rng.choice(["Hi there.", "ok", "ok!", " ", "", None, "é\n", "what? ", "\x0b", f"q{rng.random()}.", f"z{rng.random()}"])
            out.append((conv, rng.choice([t, t, t, t + 1, None, t * 3]), role, text))
    out += [(1000, t // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", f"{t}.", f"{t}"])) for t in range(300)]  # one long conversation
    return out + out[:20]


@pytest.fixture(scope="module")
def rows():
    return conversations(random.Random(3))


@pytest.mark.parametrize("how", [{}, {"piece_rows": 3}, {"piece_rows": 1, "rounds": 2}, {"piece_bytes": 5, "rounds": 0}])
def test_equals_a_search_over_strings(spark, rows, how):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as n", "1 as at", "'y' as symbols", "true as open")
    got = cr.repair(cr.damage(df.repartition(5)), **how).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_grammar_changes_no_result():
    plain, ruled = cr.Grammar(), cr.Grammar([("u", "a"), (0, 0), ("-", "-"), (1, 1), (2, "u")])
    rng = random.Random(4)
    for sequence in ["", *("".join(rng.choice("uauauasUA-o") for _ in range(rng.randint(1, 40))) for _ in range(200)), "ua" * 50, "-" * 70]:
        assert plain.repair(sequence) == ruled.repair(sequence)
    assert len(ruled.compress("ua" * 50)) < 20


def test_every_short_sequence():
    grammar = cr.Grammar([("u", "a"), ("a", "u")])
    kinds = {"s": ("s", ""), "u": ("u", ""), "o": ("x", ""), "A": ("a", "truncated"), "-": ("u", "blank")}
    for n in range(5):
        for sequence in itertools.product(kinds, repeat=n):
            want = cheapest([(kinds[c][0], "t", kinds[c][1]) for c in sequence])
            assert grammar.repair("".join(sequence)) == want[:2]


def test_rules_come_from_the_most_frequent_pairs(spark):
    seqs = spark.createDataFrame([("ua" * 8, 100), ("sua", 3), ("--", 1)], "symbols string, n long")
    grammar = cr.learn_grammar(seqs, rounds=3)
    assert next(iter(grammar.rules)) == ("u", "a") and (0, 0) in grammar.rules and ("-", "-") not in grammar.rules
    assert len(grammar.compress("ua" * 8)) <= 2


def test_empty_dropped_and_long_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.repair(cr.damage(empty)).count() == 0
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    plain = next(c for c in range(1000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 > 4 for t in (0, 1)))
    long_text = "word " * 400_000 + "end."
    df = spark.createDataFrame([(dropped, 0, "user", "x"), (plain, 0, "user", long_text), (plain, 1, "assistant", long_text)], empty.schema)
    got = {r.conv_id: r for r in cr.repair(cr.damage(df)).collect()}
    assert tuple(got[dropped])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[plain].audit == "KK" and got[plain].repaired_sha256 == hashlib.sha256(f"user:{long_text}\nassistant:{long_text}".encode()).hexdigest()
