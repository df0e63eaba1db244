"""Conversation repair against an exhaustive search, and its Spark parts on awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from functools import cache

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from gridcube.llm import turns

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                       T.StructField("text", T.StringType())] + [T.StructField(c, T.StringType()) for c in ("position", "code", "block", "audit", "id", "last")])
WHITE = " \t\n\x0b\x0c\r"


def searched(codes):
    """Least (cost, audit) over every sequence of edits: memoised over turn and phase, up to three insertions in a row."""
    @cache
    def best(at, phase, inserts):
        found = [(0, "")] if at == len(codes) and phase in (0, 3) else []
        want, to = ("a", 3) if phase == 2 else ("u", 2)
        if inserts < 3:
            found += [(c + 2, "I" + a) for c, a in best(at, to, inserts + 1)]
        if at < len(codes):
            code = codes[at]
            found += [(c + 3, "D" + a) for c, a in best(at + 1, phase, 0)]
            if code != "-":
                cut = code.isupper()
                same = code.lower() == want
                found += [(c + cut + (0 if same else 2), "KR"[not same] + a) for c, a in best(at + 1, to, 0)]
                if phase == 0 and code.lower() == "s":
                    found += [(c + cut, "K" + a) for c, a in best(at + 1, 1, 0)]
        return [min(found)] if found else []

    return best(0, 0, 0)[0]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="suaxSUAX-ua", max_size=12), st.sampled_from([1, 2, 3, 5, 32]))
def test_blocks_and_bands_find_the_cheapest_least_audit(codes, size):
    parts = [codes[k : k + size] for k in range(0, len(codes), size)] or [""]
    cost, audits = turns.chained(turns.block_table(p, k == 0, k == len(parts) - 1) for k, p in enumerate(parts))
    assert (cost, "".join(audits)) == searched(codes)


def test_long_conversations():
    draw = random.Random(3)
    for alphabet in ("uaUA--us", "uauaua-", "x", "a", "s-", "uuuA"):
        codes = "".join(draw.choice(alphabet) for _ in range(150))
        parts = [codes[k : k + turns.BLOCK] for k in range(0, len(codes), turns.BLOCK)]
        cost, audits = turns.chained(turns.block_table(p, k == 0, k == len(parts) - 1) for k, p in enumerate(parts))
        assert (cost, "".join(audits)) == searched(codes)


def plain(rows):
    """The audits of conversations by the rules themselves."""
    by_id = defaultdict(list)
    for conv_id, turn, role, text in rows:
        by_id[conv_id].append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = []
    for conv_id, own in by_id.items():
        own.sort()
        seen, codes, faults = set(), "", Counter()
        for _, _, role, text in own:
            body = text.strip(WHITE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "-" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
        numbers = [t for known, t, *_ in own if known]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [r[:1] for _, _, r, _ in own]
        cost, audit = searched(codes)
        lines, at, phase = [], 0, 0
        for edit in audit:
            if edit != "I":
                _, _, role, text = own[at]
                at += 1
            if edit == "D":
                continue
            if edit in "IR":
                role, text = "assistant" if phase == 2 else "user", text if edit == "R" else ""
            phase = {"s": 1, "u": 2, "a": 3}[role[0]]
            lines.append(f"{role}:{text}")
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out.append((conv_id, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def broken(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        out += [(conv_id, turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def some():
    draw = random.Random(8)
    rows = [(c, t, ("user", "assistant")[t % 2], f"Words {draw.randint(0, 5)} of {t}{draw.choice(['.', '!', '?', '', '. ', ' '])}") for c in range(40) for t in range(draw.randint(1, 9))]
    rows += [(100, t, draw.choice(["user", "assistant", "system", "tool", "", None, "User"]), draw.choice(["One.", "Two", None, "", " \t", "é?\n", ".\u0085"])) for t in range(120)]
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "No."), (200, None, "user", "A."), (200, None, "assistant", "B."), (201, None, None, None)]
    rows += [(300, 5, "user", "Same."), (300, 5, "user", "Same."), (300, 5, "assistant", "Same."), (300, 9, "assistant", "y" * 50_000 + ".")]
    rows += [(400, -(2**62), "user", "Low."), (400, 2**62, "assistant", "High.")]
    return rows


def frame(spark, rows):
    padded = [tuple(r) + ("x",) * 6 for r in rows]
    return spark.createDataFrame(padded, SCHEMA).repartition(3) if padded else spark.createDataFrame([], SCHEMA)


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def test_audits(spark):
    wanted = plain(some())
    wanted = [w if w[0] != 400 else (400, 2**63 - 1, *w[2:]) for w in wanted]  # 2^63 + 1 less the two that are there
    assert order(map(tuple, turns.audits(frame(spark, some())).collect())) == order(wanted)
    assert turns.audits(frame(spark, [])).count() == 0


def test_damage_and_repair(spark):
    rows = some() + [(1_000 + k, 0, "user", "Alone.") for k in range(60)]  # some lose their only turn
    got = {r[0]: tuple(r) for r in turns.damaged_and_repaired(frame(spark, rows)).collect()}
    wanted = {r[0]: r for r in plain(broken(rows))}
    lost = {r[0] for r in rows} - set(wanted)
    assert lost and all(got[c] == (c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for c in lost)
    assert {c: r for c, r in got.items() if c not in lost} == wanted
    assert turns.damaged_and_repaired(frame(spark, [])).count() == 0


def test_repaired_turns_hash_to_the_audit(spark):
    rows = [r for r in some() if r[0] != 400]
    lines, edits = defaultdict(list), Counter()
    for r in turns.repaired(frame(spark, rows)).collect():
        edits[r["conv_id"], r["edit"]] += 1
        if r["place"] is not None:
            lines[r["conv_id"]].append((r["place"], f"{r['role']}:{r['text']}"))
    for conv_id, *_, audit, digest in plain(rows):
        own = sorted(lines[conv_id])
        assert [p for p, _ in own] == list(range(len(own)))
        assert hashlib.sha256("\n".join(t for _, t in own).encode()).hexdigest() == digest
        assert all(edits[conv_id, e] == audit.count(e) for e in "KRDI")


def test_sql_agrees(spark):
    rows = [r for r in some() if r[0] != 400]
    con = duckdb.connect()
    con.sql("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    assert order(con.sql(turns.ORACLE).fetchall()) == order(map(tuple, turns.damaged_and_repaired(frame(spark, rows)).collect()))


@pytest.mark.parametrize("target, cost", [("", 6), ("ua", 0), ("uaua", 4), ("sua", None)])
def test_one_length(target, cost):
    found = turns.aligned("ua", target, 100)
    assert (found and found[0]) == cost
    assert cost is None or turns.aligned("ua", target, cost) == found and turns.aligned("ua", target, cost - 1) is None
