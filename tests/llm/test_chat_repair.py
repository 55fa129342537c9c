"""Conversation repair against exhaustive search and a plain sequential version; edge cases."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlab.llm import chat_repair as cr

PATTERN = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def cheapest_by_hand(codes):
    """Least (cost, audit) by trying every edit sequence with few inserts between rows."""
    best = None
    options = []
    for c in codes:
        own = [("D", "", 3)]
        if c != "d":
            extra = 1 if c.isupper() else 0
            own.append(("K", c.lower(), extra))
            own += [("R", x, 2 + extra) for x in "ua"]
        options.append(own)
    gaps = [[""] + ["u", "a", "ua", "au"]] * (len(codes) + 1)
    for rows in itertools.product(*options):
        for filled in itertools.product(*gaps):
            out, audit, cost = filled[0], "I" * len(filled[0]), 2 * sum(map(len, filled))
            for (letter, initial, price), more in zip(rows, filled[1:]):
                out, audit, cost = out + initial + more, audit + letter + "I" * len(more), cost + price
            if PATTERN.fullmatch(out) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def cheapest_in_order(codes):
    """The same by plain dynamic programming, row by row."""
    inf = (1 << 40, "")
    plus = lambda w, c, a: (w[0] + c, w[1] + a) if w != inf else inf

    def close(v):
        for _ in range(3):
            v[2] = min(v[2], *(plus(v[q], 2, "I") for q in (0, 1, 3)))
            v[3] = min(v[3], plus(v[2], 2, "I"))
        return v

    v = close([(0, ""), inf, inf, inf])
    for c in codes:
        new = [plus(w, 3, "D") for w in v]
        if c != "d":
            x = int(c.isupper())
            for q in (0, 1, 3):
                new[2] = min(new[2], plus(v[q], 2 + x, "R"))
                if c.lower() == "u":
                    new[2] = min(new[2], plus(v[q], x, "K"))
            new[3] = min(new[3], plus(v[2], 2 + x, "R"))
            if c.lower() == "a":
                new[3] = min(new[3], plus(v[2], x, "K"))
            if c.lower() == "s":
                new[1] = min(new[1], plus(v[0], x, "K"))
        v = close(new)
    return min(v[0], v[3])


def solve(codes):
    return min(cr.lightest(codes, 0, cr.ACCEPTING, True).values())


@pytest.mark.parametrize("codes", ["".join(c) for n in range(4) for c in itertools.product("suaxUAd", repeat=n)][::3])
def test_lightest_derivation_against_all_edits(codes):
    assert solve(codes) == cheapest_by_hand(codes)


@settings(max_examples=200, deadline=None)
@given(st.text("suaxdSUAX", max_size=40), st.integers(1, 9))
def test_blocks_chain_to_the_same_weight(codes, size):
    want = cheapest_in_order(codes)
    assert solve(codes) == want
    whole = {(0, 0): (0, "")}
    for i in range(0, len(codes), size):
        part = codes[i:i + size]
        whole = cr.chained(whole, {(p, q): w for p in cr.STATES for q, w in cr.lightest(part, p, tuple(cr.STATES), False).items()})
    if codes:
        assert min(w for (p, q), w in whole.items() if q in cr.ACCEPTING) == want


def damage_by_hand(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub(r"[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def repair_by_hand(rows):
    """Result of the query from the given rows."""
    every = {r[0] for r in rows}
    by = {c: [] for c in every}
    for r in damage_by_hand(rows):
        by[r[0]].append(r)
    out = {}
    for conv, own in by.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        seen, codes, counts = set(), "", [0, 0, 0]
        for _, _, role, text in own:
            bare = text.strip(SPACE)
            head = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not bare:
                counts[0] += 1
                codes += "d"
            elif (role, text) in seen:
                counts[1] += 1
                codes += "d"
            elif bare[-1] not in ".!?":
                counts[2] += 1
                codes += head.upper()
            else:
                codes += head
            seen.add((role, text))
        cost, audit = cheapest_in_order(codes)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:])]
        odd = sum(e != "D" for e in audit) % 2
        lines, rest = [], iter(own)
        for e in audit:
            row = next(rest) if e != "I" else None
            if e == "D":
                continue
            made = "user" if (len(lines) - odd) % 2 == 0 else "assistant"
            lines.append(f"{row[2] if e == 'K' else made}:{row[3] if row else ''}")
        roles = "".join(x[:1] for x in lines)
        assert PATTERN.fullmatch(roles), roles
        out[conv] = (conv, gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


@pytest.fixture
def folder(spark, tmp_path):
    def make(rows, extra=()):
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        for name in extra:
            from pyspark.sql import functions as F
            df = df.withColumn(name, F.lit("x"))
        df.write.parquet(f"{tmp_path}/conversations.parquet")
        return str(tmp_path)
    return make


def test_query_equals_plain_version(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r) for r in cr.op11_chat_repair(spark, sf_dir).collect()}
    assert got == repair_by_hand(rows)
    assert any("I" in r[7] for r in got.values()) and any("R" in r[7] for r in got.values())


def test_nulls_ties_repeats_and_clashing_names(spark, folder):
    rng = random.Random(2)
    rows = [(c, rng.choice([None, 0, 1, 2, 5]), rng.choice([None, "", "user", "assistant", "system", "Tool", "u"]),
             rng.choice([None, "", " \n", "same.", "same.", "no end", "end!\n ", "?"])) for c in [None, 1, 2, 3, 4, 5] for _ in range(9)]
    rows += [(7, t, "user", None) for t in range(3)] + [(-8, 4, "system", "alone.")]
    rows += [(i, i, "assistant", "x.") for i in range(100, 160)]  # some lose their only row
    path = folder(rows, ("pos", "block", "code", "first", "key", "audit", "_conv"))
    got = {r[0]: tuple(r) for r in cr.op11_chat_repair(spark, path).collect()}
    assert got == repair_by_hand(rows)
    assert any(r[1:] == (0, 0, 0, 0, 0, 0, "", cr.EMPTY_SHA) for r in got.values())


def test_long_conversation_over_many_blocks(spark, folder, monkeypatch):
    monkeypatch.setattr(cr, "BLOCK_BITS", 3)
    monkeypatch.setattr(cr, "FAN", 4)
    rng = random.Random(4)
    rows = [(1, t, rng.choice(["user", "user", "assistant", "system", "bot"]), rng.choice(["a.", f"w{t}", f"w{t}.", ""])) for t in range(700)]
    rows += [(2, t, "user", "only?") for t in range(60)] + [(c, t, "user", f"q{t}.") for c in range(10, 40) for t in range(3)]
    got = {r[0]: tuple(r) for r in cr.op11_chat_repair(spark, folder(rows)).collect()}
    assert got == repair_by_hand(rows)


def test_empty_table(spark, folder):
    assert cr.op11_chat_repair(spark, folder([])).count() == 0


def test_repaired_turns_are_rows(spark):
    turns = spark.createDataFrame([("c", 1, "user", "hi."), ("c", 2, "user", "more."), ("c", 3, "assistant", "end.")],
                                  "conv_id string, turn int, role string, text string")
    rows = cr.numbered(turns)
    plan = cr.repair_plan(rows)
    assert plan.first().audit == "KIKK" and plan.first().cost == 2
    assert sorted(tuple(r) for r in cr.repaired(rows, plan).collect()) == [
        ("c", 0, "user", "hi.", "K"), ("c", 1, "assistant", "", "I"), ("c", 2, "user", "more.", "K"), ("c", 3, "assistant", "end.", "K")]
