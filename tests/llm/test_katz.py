"""Katz backoff against a brute-force version, and exact normalisation."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.llm import katz


def words(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", t), None]


class Brute:
    def __init__(self, rows):
        self.uni, self.bi = Counter(), Counter()
        for t in rows:
            w = words(t)
            self.uni.update(w)
            self.bi.update(zip(["<s>", *w], w, strict=False))
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.d1, self.d2 = (self.discounts(Counter(c.values())) for c in (self.uni, self.bi))
        self.after = Counter()
        for (h, _), c in self.bi.items():
            self.after[h] += c
        off = sum((1 - self.d1.get(c, 1)) * c for c in self.uni.values())
        self.scale = 1 if off > 0 else self.n / (self.n + 1)
        self.unk = off / self.n if off > 0 else 1 / (self.n + 1)

    @staticmethod
    def discounts(n):
        out = {}
        for r in range(1, 6):
            out[r] = (r - 0.5) / r
            if n[1] and n[r] and n[r + 1]:
                cut = 6 * n[6] / n[1]
                if cut < 1 and 0 < ((r + 1) * n[r + 1] / n[r] / r - cut) / (1 - cut) < 1:
                    out[r] = ((r + 1) * n[r + 1] / n[r] / r - cut) / (1 - cut)
        return out

    def p1(self, w):
        c = self.uni[w]
        return self.d1.get(c, 1) * c / self.n * self.scale if c else self.unk

    def p2(self, h, w):
        if not self.after[h]:
            return self.p1(w)
        seen = {x: c for (g, x), c in self.bi.items() if g == h}
        off = sum((1 - self.d2.get(c, 1)) * c for c in seen.values())
        total, off = (self.after[h], off) if off > 0 else (self.after[h] + 1, 1)
        if w in seen:
            return self.d2.get(seen[w], 1) * seen[w] / total
        return off / total / (1 - sum(map(self.p1, seen))) * self.p1(w)

    def score(self, t):
        w = words(t)
        return sum(math.log10(self.p2(h, x)) for h, x in zip(["<s>", *w], w, strict=False))


def made(n=80, seed=3):
    r = random.Random(seed)
    v = [f"W{int(r.paretovariate(0.6))}" for _ in range(400)] + ["Été", "\xa0", "x.y"]
    return [(0, None), (1, ""), (2, " \n ")] + [(d, r.choice((" ", "\t", "\n")).join(r.choice(v) for _ in range(r.choice((1, 20, 200))))) for d in range(3, n)] + [(5, "w1 w1 w1"), (None, "w1 zzz")]


@pytest.mark.parametrize("size", [1500, 1 << 20])
def test_report_matches_brute_force(spark, size):
    rows = made()
    train = [t for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 7 != 2]
    m = Brute(train)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as flag", "2 as batch").repartition(3)
    got = sorted(((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in katz.report(df, ~katz.held_out(), size, 3000).collect()))
    want = sorted((-1 if d is None else d, len(words(t)), sum(m.uni[w] > 0 for w in words(t)), m.n, round(sum(math.log10((m.uni[w] + 1) / (m.n + m.v + 1)) for w in words(t)), 6), round(m.score(t), 6)) for d, t in rows)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], atol=1e-4)


def test_probabilities_add_up_to_one():
    m = Brute([t for _, t in made(40)])
    for h in ["<s>", "w1", "unheard", *list(m.after)[:20]]:
        assert abs(sum(m.p2(h, w) for w in m.uni) + m.p2(h, "never seen") - 1) < 1e-9


def test_empty_and_untrained(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert katz.report(df.limit(0), F.lit(True)).count() == 0
    got = {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in katz.report(df, F.lit(False)).collect()}
    assert got == {1: (3, 0, 0, 0.0, 0.0), 2: (1, 0, 0, 0.0, 0.0)}
