"""Conversation repair against a search over all edits."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from evstream.llm import conversations as c
from evstream.llm.common import table
from evstream.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """(cost, audit, repaired rows) by trying every edit; rows are (role, text, must go, truncated)."""
    memo = {}

    def best(i, said):
        """``said``: '', 's', 'u' or 'a', the last role given out."""
        if (i, said) in memo:
            return memo[i, said]
        options = []
        if i == len(rows) and said in ("", "a"):
            options.append((0, "", ()))
        nexts = {"": "u", "s": "u", "u": "a", "a": "u"}
        # One insert after another never pays twice in a row of three, so two are tried at most.
        for n in (1, 2):
            roles, at = [], said
            for _ in range(n):
                at = nexts[at]
                roles.append(at)
            for cost, audit, out in row(i, at):
                options.append((cost + 3 * n, "I" * n + audit, tuple(({"u": "user", "a": "assistant"}[r], "") for r in roles) + out))
        options += row(i, said)
        memo[i, said] = min(options, key=lambda o: o[:2]) if options else (10**9, "", ())
        return memo[i, said]

    def row(i, said):
        if i == len(rows):
            return [(0, "", ())] if said in ("", "a") else []
        role, text, go, cut = rows[i]
        rest = best(i + 1, said)
        out = [(rest[0] + 4, "D" + rest[1], rest[2])]
        if not go:
            expected = {"": "us", "s": "u", "u": "a", "a": "u"}[said]
            if role[:1] and role[:1] in expected:
                rest = best(i + 1, role[0])
                out.append((rest[0] + 3 * cut, "K" + rest[1], ((role, text), *rest[2])))
            for to in ("user", "assistant"):
                if to[0] in expected:
                    rest = best(i + 1, to[0])
                    out.append((rest[0] + 3 * cut + 3, "R" + rest[1], ((to, text), *rest[2])))
        return out

    return best(0, "")


def harmed(rows):
    """Rows of one conversation after damage, in order."""
    spaced = lambda x: " " if x is None else x
    out = []
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, spaced(r[2]), spaced(r[3]))):
        role, text = spaced(role), spaced(text)
        harm = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
        if harm == 1:
            text = ""
        if harm == 2:
            text = re.sub("[.!?]", "", text)
        if harm == 4:
            role = "user"
        out += [(turn, role, text)] * {0: 0, 3: 2}.get(harm, 1)
    return out


def audited(rows):
    seen, kinds, symbols = set(), [], []
    for _, role, text in rows:
        letters = WORD.findall(text)
        kind = "blank" if not letters else "duplicate" if (role, text) in seen else "truncated" if letters[-1] not in ".!?" else ""
        seen.add((role, text))
        kinds.append(kind)
        symbols.append((role, text, kind in ("blank", "duplicate"), kind == "truncated"))
    turns = [t for t, _, _ in rows if t is not None]
    cost, edits, left = cheapest(symbols)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[kinds.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)),
            cost, edits, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest())


def expected(rows, harm=harmed):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(tuple(r)[:4])
    return {k: audited(harm(v)) for k, v in by.items()}


def kept(rows):
    spaced = lambda x: " " if x is None else x
    return [(t, spaced(r), spaced(x)) for _, t, r, x in
            sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, spaced(r[2]), spaced(r[3])))]


def result(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def generated(n, seed):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "USER"]
    texts = ["Yes.", "No!", "so", "and then", "", " \t", None, "Why? ", "é.", "x\n", " "]
    rows = []
    for conv in range(n):
        for t in range(r.randint(1, 12)):
            rows.append((conv, r.choice([t, t, t, t + 3, None]), r.choice(roles), r.choice(texts) if r.random() < 0.4 else f"t{t}" + r.choice(".!,")))
    return rows + [(None, t, "user", f"n{t}.") for t in range(5)] + [(-1, None, None, None)] * 3


def test_tables_hold_what_single_steps_give():
    t = c.Blocks(3)
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 7, 100):
        s = r.integers(0, c.SYMBOLS, n)
        ends, cost = t.back(s, 0)
        v, total = 0, 0
        for x in s[::-1]:
            total += t.one_off[v][x]
            v = t.one_to[v][x]
        assert (ends[-1], cost) == (v, total)


def test_edits_are_the_cheapest_and_least():
    t = c.Blocks()
    texts = {0: ("system", "."), 1: ("user", "."), 2: ("assistant", "."), 3: ("tool", ".")}
    for n in range(4):
        for symbols in itertools.product(range(c.SYMBOLS), repeat=n):
            rows = [(*texts[s % 4], s == 8, 4 <= s < 8) for s in symbols]
            cost, audit, _ = cheapest(rows)
            a = np.array(symbols, np.int64)
            ends, total = t.back(a, 0)
            edits, place = t.trace(a, 0, c.START)
            said = re.sub("[ua]", "", "".join(edits) + c.finish(place))
            assert (total + t.vectors[ends[-1]][c.START], said) == (cost, audit), symbols


@pytest.mark.parametrize("piece", [c.PIECE, 3])
def test_audit(spark, piece, monkeypatch):
    monkeypatch.setattr(c, "PIECE", piece)  # 3: a conversation in many pieces
    rows = generated(150, 2)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("mine") for n in ("key", "piece", "cost", "copies", "h")})
    assert result(c.audit(c.damaged(df))) == expected(rows)
    assert result(c.audit(c.undamaged(df))) == expected(rows, kept)


def test_registered_query(spark):
    rows = [tuple(r) for r in table(spark, DATA, "conversations").select("conv_id", "turn", "role", "text").collect()]
    out = QUERIES["op12_conversations"](spark, DATA)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert result(out) == expected(rows)


def test_repaired_rows_are_legal(spark):
    rows = generated(60, 5)
    out = c.repair(c.undamaged(spark.createDataFrame(rows, SCHEMA))).orderBy("conv_id", "seq").collect()
    by = defaultdict(list)
    for r in out:
        by[r["conv_id"]].append(r)
    for conv, got in by.items():
        assert re.fullmatch("s?(ua)+", "".join(r["role"][0] for r in got)) and [r["seq"] for r in got] == list(range(len(got)))
    want = {k: cheapest_text(kept([r for r in rows if r[0] == k])) for k in {r[0] for r in rows}}
    assert {k: [(r["role"], r["text"]) for r in v] for k, v in by.items()} == {k: v for k, v in want.items() if v}


def cheapest_text(rows):
    seen, symbols = set(), []
    for _, role, text in rows:
        letters = WORD.findall(text)
        go = not letters or (role, text) in seen
        seen.add((role, text))
        symbols.append((role, text, go, not go and letters[-1] not in ".!?"))
    return list(cheapest(symbols)[2])


def test_empty_and_long(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert c.audit(c.damaged(nothing)).count() == 0 and c.repair(c.undamaged(nothing)).count() == 0
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"{'word ' * 500}{t}.") for t in range(3000)]
    got = result(c.audit(c.undamaged(spark.createDataFrame(rows, SCHEMA))))
    assert got[1][5:7] == (0, "K" * 3000)
