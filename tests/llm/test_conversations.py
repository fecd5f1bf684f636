"""Conversation repair against search over all edit strings, and on odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from strata.llm import conversations as C
from strata.llm import queries

BLANKS = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        row = (conv, turn, "user" if fault == 4 else role, text)
        out += [row] * (2 if fault == 3 else 1)
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.strip(BLANKS)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def search(rows):
    """Cheapest edits by a table over suffixes: (cost, letters, repaired rows)."""
    bad, n = faults(rows), len(rows)
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    table = {}
    for i in range(n, -1, -1):
        known = {}
        for _ in range(4):  # inserts lead from state to state within a row
            for q in ("", "s", "u", "a"):
                options = [(0, "", None, q)] if i == n and q in ("", "a") else []
                nxt = follow[q]
                if nxt in known:
                    options.append((2 + known[nxt][0], "I" + known[nxt][1], (names[nxt], ""), nxt))
                if i < n:
                    role, text = rows[i][2], rows[i][3]
                    cost, letters = table[i + 1, q][:2]
                    options.append((3 + cost, "D" + letters, None, q))
                    if bad[i] not in ("blank", "duplicate"):
                        more = bad[i] == "truncated"
                        to = role[:1]
                        if to in ("s", "u", "a") and ((to == "s" and q == "") or (to == "u" and q != "u") or (to == "a" and q == "u")):
                            cost, letters = table[i + 1, to][:2]
                            options.append((more + cost, "K" + letters, (role, text), to))
                        cost, letters = table[i + 1, nxt][:2]
                        options.append((2 + more + cost, "R" + letters, (names[nxt], text), nxt))
                if options:
                    known[q] = min(options, key=lambda o: o[:2])
        for q in known:
            table[i, q] = known[q]
    out, i, q = [], 0, ""
    cost, letters = table[0, ""][:2]
    for letter in letters:
        _, _, row, to = table[i, q]
        out += [row] if row else []
        i, q = i + (letter != "I"), to
    return cost, letters, out


def brute(rows):
    rows = ordered(rows)
    bad, turns = faults(rows), [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    cost, letters, repaired = search(rows)
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in repaired))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, bad.count("blank"), bad.count("duplicate"), bad.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, letters,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest())


def every_script(rows):
    """The least (cost, letters) over all edit strings of bounded length, for very short conversations."""
    bad, best = faults(rows), None
    for places in itertools.product(range(3), repeat=len(rows) + 1):
        for letters in itertools.product("KRD", repeat=len(rows)):
            text, state, cost, ok = "", "", 0, True
            for i in range(len(rows) + 1):
                for _ in range(places[i]):
                    state, cost, text = {"": "u", "s": "u", "u": "a", "a": "u"}[state], cost + 2, text + "I"
                if i == len(rows):
                    break
                letter, to = letters[i], rows[i][2][:1]
                text += letter
                if letter == "D":
                    cost += 3
                    continue
                ok = ok and bad[i] not in ("blank", "duplicate")
                cost += bad[i] == "truncated"
                if letter == "K":
                    legal = (to == "s" and state == "") or (to == "u" and state != "u") or (to == "a" and state == "u")
                    ok, state = ok and legal, to if legal else state
                else:
                    state, cost = {"": "u", "s": "u", "u": "a", "a": "u"}[state], cost + 2
            if ok and state in ("", "a") and (best is None or (cost, text) < best):
                best = (cost, text)
    return best


def conversations(seed, n, longest):
    pick, rows = random.Random(seed), []
    texts = ["Yes.", "No!", "why?", "cut off", "", " \n", "a. b", "long " * 30 + "."]
    for conv in range(n):
        for turn in range(pick.randint(1, longest)):
            role = pick.choices(["user", "assistant", "system", "tool", "", None], [8, 8, 2, 1, 1, 1])[0] if pick.random() < 0.5 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn + pick.choice([0, 0, 0, 5]), role, pick.choice(texts) if pick.random() < 0.5 else f"text {pick.random()}{pick.choice('.!?x')}"))
    return rows


def test_search_finds_the_least_of_all_scripts():
    for seed in range(25):
        by_conv = {}
        for r in damage(conversations(seed, 6, 4)):
            by_conv.setdefault(r[0], []).append(r)
        for rows in by_conv.values():
            if len(rows) <= 4:
                assert search(ordered(rows))[:2] == every_script(ordered(rows))


@pytest.mark.parametrize("held", [C.HELD_ROWS, 3])
def test_audit_equals_brute_force(spark, held):
    rows = conversations(1, 300, 12) + conversations(2, 1, 400)[:] + [(900, None, "user", "a?"), (900, None, "assistant", None), (None, 1, "user", "Hi."),
                                                                      (None, 2, None, "Hm."), (901, 7, "user", "x.")]
    rows = [r if i % 17 else (r[0], r[1], r[2], None) for i, r in enumerate(rows)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = {r.conv_id: tuple(r)[2:-1] for r in C.audit(C.damaged(frame), present_col="present", held_rows=held).collect()}
    by_conv = {r[0]: [] for r in rows}
    for r in damage(rows):
        by_conv[r[0]].append(r)
    assert got == {conv: brute(own) for conv, own in by_conv.items()}


def test_repaired_rows_have_the_digest(spark):
    rows = conversations(5, 200, 10)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    hurt = C.damaged(frame)
    audits = C.audit(hurt, present_col="present")
    texts = {}
    for r in sorted(C.repaired(hurt, audits, present_col="present").collect(), key=lambda r: (r.conv_id, r.position)):
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in audits.collect():
        own = texts.get(r.conv_id, [])
        assert len(own) == r.repaired_rows and hashlib.sha256("\n".join(own).encode()).hexdigest() == r.repaired_sha256


def test_audit_odd_tables(spark):
    schema = "conv_id string, turn int, role string, text string, conv string, present string, key long, fault int, again int"
    empty = spark.createDataFrame([], schema)
    assert C.audit(empty).count() == 0 and C.repaired(empty, C.audit(empty)).count() == 0
    rows = [("a", 1, "user", "x" * 200_000 + ".", "z", "p", 1, 9, 0), ("a", 2, "assistant", "ok.", "z", "p", 1, 9, 0), (None, None, None, None, None, None, None, None, None)]
    got = {r.conv_id: r for r in C.audit(spark.createDataFrame(rows, schema)).collect()}
    assert got["a"].audit == "KK" and got["a"].cost == 0 and got[None].audit == "D" and got[None].blank == 1
    assert got[None].repaired_sha256 == hashlib.sha256(b"").hexdigest()


def test_long_conversations_need_one_shuffle(spark):
    plan = C.audit(spark.createDataFrame([(1, 1, "user", "x.")], "conv_id long, turn long, role string, text string"))
    assert plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1


def test_query_covers_every_conversation(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op12_conversation_repair"](spark, sf)
    ids = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id").distinct()
    assert got.count() == ids.count() and got.join(ids, "conv_id").count() == ids.count()
