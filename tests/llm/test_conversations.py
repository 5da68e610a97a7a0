"""Conversation repair against exhaustive and plain dynamic programs, SQL, and the real repaired turns."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from racelake.llm import conversations, queries, sql

SF = "/root/testdata/sf0.001"
PLACES = {"n": "su", "s": "u", "u": "a", "a": "u"}


def best(rows):
    """(cost, edits, text) of rows of (role, text, fault), by a dynamic program on whole strings."""
    far = (10**9, "", ())

    def insert(st):
        st = dict(st)
        for s, to, role in (("n", "u", "user"), ("s", "u", "user"), ("a", "u", "user"), ("u", "a", "assistant")):
            if s in st:
                c, e, t = st[s]
                st[to] = min(st.get(to, far), (c + 2, e + "I", (*t, f"{role}:")))
        return st

    states = {"n": (0, "", ())}
    for role, text, fault in rows:
        new = {}
        for s, (c, e, t) in insert(states).items():
            options = [(s, c + 3, "D", t)]
            if fault not in (1, 2):
                extra = fault == 3
                if role[:1] and role[0] in PLACES[s]:
                    options.append((role[0], c + extra, "K", (*t, f"{role}:{text}")))
                to = PLACES[s][-1]
                options.append((to, c + 2 + extra, "R", (*t, ("user:" if to == "u" else "assistant:") + text)))
            for to, cost, letter, out in options:
                new[to] = min(new.get(to, far), (cost, e + letter, out))
        states = new
    states = insert(states)
    c, e, t = min(states.get(s, far) for s in "na")
    return c, e, hashlib.sha256("\n".join(t).encode()).hexdigest()


def exhaustive(rows):
    """The same by trying every string of edits with at most two insertions in a row."""
    found = []
    gap = ["", "I", "II"]
    for edits in itertools.product("KRD", repeat=len(rows)):
        if any(f in (1, 2) and x != "D" for x, (_, _, f) in zip(edits, rows, strict=True)):
            continue
        for gaps in itertools.product(gap, repeat=len(rows) + 1):
            word = gaps[0] + "".join(x + g for x, g in zip(edits, gaps[1:], strict=True))
            cost, at, kinds = 0, 0, []
            for x in word:
                if x == "I":
                    cost += 2
                    kinds.append("?")
                    continue
                role, _, fault = rows[at]
                at += 1
                cost += {"K": 0, "R": 2, "D": 3}[x] + (fault == 3 and x != "D")
                if x != "D":
                    kinds.append("?" if x == "R" else role[:1] or "-")
            shape = "".join(kinds)
            if re.fullmatch(r"(s?([u?][a?])+)?", shape):
                found.append((cost, word))
    return min(found)


def audited(rows):
    a = conversations._Audit()
    for i, (role, text, fault) in enumerate(rows):
        a.row(i, role, role[:1], memoryview(text.encode()), fault)
    return a.result()[5:]


@pytest.mark.parametrize("prime", [conversations._PRIME, 7])
@pytest.mark.parametrize("most", [1 << 16, 3])
def test_cheapest_edits(monkeypatch, prime, most):
    # a prime of 7 makes nearly all hashes collide; 3 nodes make the trie shrink at once
    monkeypatch.setattr(conversations, "_PRIME", prime)
    monkeypatch.setattr(conversations, "_BASE", conversations._BASE % prime)
    monkeypatch.setattr(conversations.Trie, "MOST", most)
    some = random.Random(prime + most)
    for k in range(1200):
        rows = [(some.choice(["user", "assistant", "system", " ", "", "usher"] if k % 2 else ["user", "assistant"]), f"t{i}", some.choice([0, 0, 0, 1, 2, 3])) for i in range(some.randrange(4 if k < 400 else 30))]
        want = best(rows)
        assert audited(rows) == want
        if k < 400:
            assert exhaustive(rows) == want[:2]


def test_a_long_conversation_takes_linear_time_and_little_memory():
    import time

    some = random.Random(1)
    a = conversations._Audit()
    began = time.perf_counter()
    for i in range(60_000):
        role = some.choice(["user", "assistant", " "])
        a.row(i, role, role[:1], memoryview(b"text."), some.choice([0, 0, 2, 3]))
    assert len(a.trie.up) <= 2 * a.trie.MOST and time.perf_counter() - began < 60
    assert len(a.result()[6]) >= 60_000


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    return out


def brute(table):
    want = []
    for conv in {r[0] for r in table}:
        rows = sorted((r[1:] for r in damage(table) if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faulty = set(), []
        for _, role, text in rows:
            ink = text.rstrip(" \t\n\x0b\x0c\r")
            faulty.append((role, text, 1 if not ink else 2 if (role, text) in seen else 0 if ink[-1] in ".!?" else 3))
            seen.add((role, text))
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        kinds = [r[1][:1] for r in rows]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(kinds, kinds[1:], strict=False))
        want.append((conv, gaps, *(sum(f == k for _, _, f in faulty) for k in (1, 2, 3)), illegal, *best(faulty)))
    return want


@pytest.fixture(scope="module")
def table():
    base = duckdb.sql(f"select conv_id, turn, role, text from '{SF}/conversations.parquet' order by all limit 300").fetchall()
    odd = [(None, 0, "user", "Null id."), (None, None, "assistant", "Null turn too."), (7001, None, None, None), (7001, 1, "user", None), (7001, 2, None, "A text without a role."), (7001, 2, "", "No role."), (7001, 2, "", "No role."), (7002, 5, "system", "Only a system turn.")]
    odd += [(7003, t, ["user", "assistant"][t % 2], "long " * 40_000 + ".") for t in range(5)] + [(7004, 3, "user", "Same turn."), (7004, 3, "assistant", "Same turn."), (7004, 3, "user", "Same turn."), (7005, 0, "user", " \n\t"), (7006, -4, "tool", "x"), (7006, 4, "usher", "é.")]
    gone = next(c for c in range(8000, 9000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return base + odd + [(gone, 0, "user", "Dropped.")]


def test_query(spark, table, tmp_path):
    path = str(tmp_path / "conversations.parquet")
    # columns of the names that the operator uses inside
    spark.createDataFrame([(*r, "clash", 1, False, 2) for r in table], "conv_id long, turn long, role string, text string, fault string, nth int, there boolean, copy int").write.parquet(path)
    got = queries.op13_conversation_repair(spark, str(tmp_path))
    key = lambda r: str(r)
    rows = sorted((tuple(r) for r in got.collect()), key=key)
    assert rows == sorted(brute(table), key=key)
    want = duckdb.sql(sql.CONVERSATIONS.replace("{conversations}", f"'{path}/*.parquet'"))
    assert got.columns == want.columns and rows == sorted(want.fetchall(), key=key)
    # the turns themselves hash to the audit's digest
    turns = conversations.repaired(spark, conversations.damaged(spark.read.parquet(path))).collect()
    of: dict = {}
    for r in sorted(turns, key=lambda r: r.place):
        of.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert {r[0]: hashlib.sha256("\n".join(of.get(r[0], [])).encode()).hexdigest() for r in rows} == {r[0]: r[-1] for r in rows}
    kinds = {c: "".join(x[0] for x in t) for c, t in of.items()}
    assert all(re.fullmatch("(s?(ua)+)?", k) for k in kinds.values())


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(path)
    assert queries.op13_conversation_repair(spark, str(tmp_path)).count() == 0
    assert conversations.repaired(spark, spark.read.parquet(path)).count() == 0
