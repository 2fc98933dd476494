"""Deleted interpolation against a plain restatement, and by what it is for: unseen documents."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from evstream.llm import scoring
from evstream.llm.common import saved, table
from evstream.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def crc(i):
    return zlib.crc32(b"" if i is None else str(i).encode())


def grams(words, order):
    """(context, n-gram) of each token for contexts of 0 to order - 1 words."""
    padded = [b"<before>"] * (order - 1) + words
    for i in range(order - 1, len(padded)):
        yield [(tuple(padded[i - k:i]), tuple(padded[i - k:i + 1])) for k in range(order)]


def bucket(n):
    return 0 if n == 0 else min(n.bit_length(), scoring.DEEPEST)


class Model:
    def __init__(self, rows, order):
        self.order, self.rest, self.train = order, [Counter(), Counter()], [Counter(), Counter()]
        tuning = []
        for i, text in rows:
            kind = "held" if crc(i) % 10 == 0 else "tuning" if crc(i) // 10 % 10 == 0 else "rest"
            if kind == "held":
                continue
            for g in grams(tokens(text), order):
                for context, gram in g:
                    for side in [self.train, *([self.rest] if kind == "rest" else [])]:
                        side[0][context] += 1
                        side[1][gram] += 1
            if kind == "tuning":
                tuning += grams(tokens(text), order)
        self.words = Counter({g: n for g, n in self.train[1].items() if len(g) == 1})
        self.tokens, self.vocabulary = sum(self.words.values()), len(self.words)
        events = [self.estimates(g, self.rest) for g in tuning]
        self.weights, last = {}, None
        for _ in range(scoring.ROUNDS if events else 0):
            sums, gain = {}, 0.0
            for b, p in events:
                w = [x * y for x, y in zip(self.weight(b), p)]
                gain += math.log(sum(w))
                at = sums.setdefault(b, [0.0] * (order + 1))
                for k, x in enumerate(w):
                    at[k] += x / sum(w)
            for b, s in sums.items():
                s = [x + scoring.PRIOR * (u > 0) for x, u in zip(s, self.start(b))]
                self.weights[b] = [x / sum(s) for x in s]
            if last is not None and gain - last < scoring.SMALL_GAIN * len(events):
                break
            last = gain

    def start(self, b):
        use = [1, 1, *[int(x > 0) for x in b]]
        return [u / sum(use) for u in use]

    def weight(self, b):
        return self.weights.get(b, self.start(b))

    def estimates(self, g, counts):
        n = [counts[0][c] for c, _ in g]
        p = [1 / (self.vocabulary + 1), counts[1][g[0][1]] / max(n[0], 1)]
        p += [counts[1][gram] / n[k] if n[k] else 0.0 for k, (_, gram) in enumerate(g) if k]
        return tuple(bucket(x) for x in n[1:]), p

    def score(self, text):
        out = 0.0
        for g in grams(tokens(text), self.order):
            b, p = self.estimates(g, self.train)
            out += math.log10(sum(w * x for w, x in zip(self.weight(b), p)))
        base = sum(math.log10((self.words[(w,)] + 0.1) / (self.tokens + 0.1 * (self.vocabulary + 1))) for w in tokens(text))
        return len(tokens(text)), sum(self.words[(w,)] > 0 for w in tokens(text)), base, out


def compare(df, rows, order):
    m = Model(rows, order)
    got = sorted(((r["doc_id"] is not None, r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"], r["score"], r["held_out"], r["train_tokens"])
                  for r in df.collect()), key=lambda r: (r[0], r[1] or 0, r[2:]))
    want = sorted(((i is not None, i, *m.score(t), crc(i) % 10 == 0, m.tokens) for i, t in rows), key=lambda r: (r[0], r[1] or 0, r[2:]))
    assert [(r[:4], r[6:]) for r in got] == [(r[:4], r[6:]) for r in want]
    np.testing.assert_allclose([r[4:6] for r in got], [r[4:6] for r in want], rtol=1e-9)


def generated(n, seed):
    r = random.Random(seed)
    words = ["a", "B", "b", "the", "cat", "sat", "É", "ß", "x\x0by", "on", "mat\n"] + [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(r.choice(words[:r.choice((4, 11, 51))]) for _ in range(r.randint(0, 60)))) for i in range(n)]
    return rows + [(1, None), (2, ""), (3, " \t"), (None, "the cat"), (None, None), (5, rows[5][1]), (5, rows[5][1]), (7, "cat " * 500)]


@pytest.mark.parametrize("order,block", [(2, scoring.BLOCK), (2, 70), (3, 90), (1, 50)])
def test_scores(spark, order, block, monkeypatch):
    monkeypatch.setattr(scoring, "BLOCK", block)  # small: documents in parts, blocks in many ranges
    monkeypatch.setattr(scoring, "READ", 64 if block < 100 else scoring.READ)
    monkeypatch.setattr(scoring, "RANGE", 1000 if block < 100 else scoring.RANGE)
    rows = generated(150, 4)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("mine") for n in ("row", "fold", "score", "block")})
    compare(scoring.scored(df, order), rows, order)


def test_registered_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, DATA, "documents").select("doc_id", "text").collect()]
    compare(QUERIES["op13_scoring"](spark, DATA), rows, scoring.ORDER)


def test_nothing_to_learn_from(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert scoring.scored(nothing).count() == 0
    held = next(i for i in range(1000) if crc(i) % 10 == 0)
    r = scoring.scored(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (True, 3, 0, 0) and r["base_score"] == 0 and np.isfinite(r["score"])


def test_held_out_documents_are_told_better(spark):
    df = saved(scoring.scored(table(spark, DATA.replace("sf0.001", "sf0.01"), "documents")), "scores")
    r = df.where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    one = saved(scoring.scored(table(spark, DATA.replace("sf0.001", "sf0.01"), "documents"), 1), "scores").where("held_out").agg(F.sum("score")).first()
    assert r[1] > one[0] > r[0]


def test_estimates_sum_to_one(spark):
    """Over all words and one unknown, in a context that was seen and in one that was not."""
    rows = [(i, t) for i, t in generated(100, 9) if i is not None]
    m = Model(rows, 2)
    for context in (b"the", b"never"):
        total = 0.0
        for w in [*[k[0] for k in m.words], b"unknown"]:
            b, p = m.estimates([((), (w,)), ((context,), (context, w))], m.train)
            total += sum(x * y for x, y in zip(m.weight(b), p))
        assert abs(total - 1) < 1e-9


def test_numbers_survive_packing():
    for x in (np.arange(1000, dtype="<u8") ** 3, np.zeros(3, "<u4"), np.array([], "<u8")):
        assert (scoring._unpacked(scoring._packed(x), x.dtype.str, len(x)) == x).all()
    assert scoring.buckets(np.array([0, 1, 2, 3, 4, 2**13, 2**40])).tolist() == [0, 1, 2, 2, 3, 14, 15]
