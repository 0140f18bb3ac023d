"""Source divergence audit against brute force."""

import random
import re
from collections import Counter

from geoloom.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n int, m int, a string"


def brute(rows, top=200):
    docs = [(la or "", s or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for t, la, s in rows]
    out = []
    for lang in {x[0] for x in docs}:
        mine = [x for x in docs if x[0] == lang]
        kept = {w for w, n in Counter(w for _, _, ws in mine for w in set(ws)).items() if n >= 3}
        counts = {s: Counter(w for _, q, ws in mine if q == s for w in ws if w in kept) for s in {x[1] for x in mine}}
        every = sum(counts.values(), Counter())
        share = lambda c, w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept))
        f = lambda p, q: (p - q) ** 2 // q
        for s, c in counts.items():
            pairs = [(sum(f(share(c, w), share(d, w)) for w in kept), o) for o, d in counts.items() if o != s]
            terms = [(f(share(c, w), share(every, w)), w) for w in c if share(c, w) > share(every, w)]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, w, v, i) for i, (v, w) in enumerate(found, 1) if part == "pair" or i <= top]
    return sorted(out)


def got(df):
    assert [c for c, _ in df.dtypes] == ["lang", "source", "part", "item", "value", "rank"] and dict(df.dtypes)["value"] == "bigint" and dict(df.dtypes)["rank"] == "int"
    return sorted(tuple(r) for r in df.collect())


def made(spark, rows):
    return spark.createDataFrame([(i, t, la, s, 1, 2, "x") for i, (t, la, s) in enumerate(rows)], SCHEMA)


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(divergence, "ENTRIES", 5)
    r = random.Random(3)
    words = [f"{a}{b}" for a in ("The", "of", "ÄÖ", "日", "x\xa0y", "q") for b in ("", "a", "bc", "Z")]
    rows = [(" ".join(words[min(int(r.expovariate(0.3)), 23)] + r.choice(("", ".", "7")) for _ in range(r.choice((1, 5, 60)))), r.choice(("en", "de", None, "")), r.choice(("s1", "s2", "s3", "é", None))) for _ in range(150)]
    rows += [(None, "en", "s9"), ("", "xx", "s1"), ("one two", "xx", "s2"), ("@[`{ 12", "yy", "s1"), ("a " * 50000, "en", "s1"), *[("same text here", "zz", f"k{i % 3}") for i in range(9)]]
    assert got(divergence.report(made(spark, rows))) == brute(rows)


def test_ranks_stop_at_the_top(spark):
    rows = [(" ".join(f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)), "en", s) for s in ("a", "a", "a")] + [("other word", "en", "b")] * 3
    found = got(divergence.report(made(spark, rows)))
    assert found == brute(rows) and sum(x[2] == "term" and x[1] == "a" for x in found) == 200


def test_empty_table(spark):
    assert divergence.report(made(spark, [("a", "b", "c")]).limit(0)).count() == 0


def test_shares_of_large_counts(spark):
    from pyspark.sql import functions as F

    cases = [(0, 0, 1), (10**12, 10**13, 10**6), (123456789012, 9 * 10**14, 7), (5, 10, 0), (0, 0, 0)]
    df = spark.createDataFrame(cases, "c long, n long, v long").select("*", divergence.share(F.col("c"), F.col("n"), F.col("v")).alias("p"))
    assert all(r.p == 1 + 10**9 * (r.c + 1) // max(r.n + r.v, 1) for r in df.collect())
