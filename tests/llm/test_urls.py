"""URL filters: splits against all splits, rules, model and verdicts against brute force."""

import itertools
import math
import random
import re
from collections import Counter

import pytest

from geoloom.llm import common, urls

SCHEMA = "page_id long, url string, html string, host int, odds int"


@pytest.fixture(scope="module")
def words():
    return urls.unigrams(common.tokenizer_path(urls.VOCABULARY))


def test_names_are_split_into_words(words):
    for name in ("cheap pills", "free bets", "casino win", "spam farm", "read the morning paper", "online poker"):
        assert urls.segmented(name.replace(" ", ""), words) == name.split()


def test_split_is_the_best_of_all(words):
    r = random.Random(5)

    def worth(parts):
        return sum(words[p] if p in words else -urls.UNKNOWN - urls.UNKNOWN_LETTER * len(p) for p in parts)

    for _ in range(60):
        run = "".join(r.choice("theinovwr") for _ in range(r.randint(1, 11)))
        every = [[run[a:b] for a, b in itertools.pairwise((0, *cut, len(run)))] for n in range(len(run)) for cut in itertools.combinations(range(1, len(run)), n)]
        assert math.isclose(worth(urls.segmented(run, words)), max(map(worth, every)))


def test_long_runs_take_linear_time(words):
    assert len("".join(urls.segmented("casinothe" * 20_000, words))) == 180_000


def brute(rows, words):
    def parts(u):
        if u is None or "://" not in u:
            return "", ""
        m = re.match(r"([^/?#]*)([^?#]*)", u.split("://", 1)[1], re.S)
        return "".join(c.lower() if c.isascii() else c for c in m[1]), m[2]

    def tokens(t):
        return [x for run in re.findall(r"[a-z]+|[0-9]+|[^\x00-\x7F]+", t) for x in (["#"] if run[0] in "0123456789" else [run] if not run.isascii() else urls.segmented(run, words))]

    counts, seen = {True: Counter(), False: Counter()}, Counter()
    for _, u in rows:
        h, p = parts(u)
        if h:
            bad = bool(urls.SEEDS & set(tokens(h)))
            seen[bad] += 1
            counts[bad].update(urls.bucket(t) for t in set(tokens(h) + tokens(p.lower())))
    kinds = len(counts[True] | counts[False])
    odds = lambda b: math.log((counts[True][b] + 1) / (counts[True].total() + kinds)) - math.log((counts[False][b] + 1) / (counts[False].total() + kinds)) if counts[True][b] + counts[False][b] else 0.0
    out = []
    for i, u in rows:
        h, p = parts(u)
        fits = [(r, v) for v, r in urls.RULES for rh, rp in [(r[: r.index("/")], r[r.index("/") :])] if (h == rh or h.endswith("." + rh)) and p.startswith(rp)]
        rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, None))
        score = math.log((seen[True] + 1) / (seen[False] + 1)) + sum(odds(urls.bucket(t)) for t in set(tokens(h) + tokens(p.lower())))
        out.append((i, h, p, rule, verdict or ("block" if score > 0 else "allow")))
    return out


ODD = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/1?x=://y", "http://a.com", "http://com/", "http://xcom/", "http://a.net/es", "http://a.net/es/", "http://Ünï.ÀB.net/FR/fr/",
    "http://a://b.net/fr/", "x://y?z/en/", "http://u:p@h.example.com:80/en/#a", "http://example.com/en/", "http://www.example.com/en/?q", "http://wwww.example.com/en/", "a\nb://c.net/fr/\nq", "http://" + "ab" * 5000 + ".org/" + "x/" * 5000,
]


def test_matches_brute_force(spark, words):
    r = random.Random(2)
    hosts = ["cheappills.example.org", "free-bets.example.net", "casinowin.example.net", "adult-x.example.com"] + ["www.therth.example.org", "m.ththen.example.org", "news.example.net"] * 4
    rows = list(enumerate(ODD)) + [(100 + i, f"http://{r.choice(hosts)}/{r.choice(('en', 'fr', 'es', 'de'))}/{r.choice(('win', 'story', 'bonus'))}/{i}") for i in range(200)] + [(7, "http://free-bets.example.net/de/1")] * 3
    df = urls.judged(spark.createDataFrame([(i, u, "", 1, 2) for i, u in rows], SCHEMA))
    key = lambda x: (x[0], str(x))
    got = sorted((tuple(x)[:5] for x in df.collect()), key=key)
    assert got == sorted(brute(rows, words), key=key)
    by_host = {h: v for _, h, p, rule, v in got if rule is None and p.startswith("/de")}
    assert by_host["cheappills.example.org"] == by_host["free-bets.example.net"] == "block" and by_host["www.therth.example.org"] == by_host["news.example.net"] == "allow"


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, None, None, 1, 2), (None, "x", "", 1, 2)], SCHEMA)
    assert sorted((r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in urls.judged(df).collect()) == [(0, "", "", None, "allow"), (1, "", "", None, "allow")]
    assert urls.judged(df.limit(0)).count() == 0
