"""Suffix-array dedup against a brute-force version."""

import hashlib
import random

import numpy as np

from geoloom.llm import suffixes


def brute(rows):
    first = {}
    data = [(float("inf") if d is None else d, (t or "").encode()) for d, t in rows]
    for d, t in data:
        for i in range(len(t) - 49):
            w = t[i : i + 50]
            first[w] = min(first.get(w, d), d)
    out = []
    for (d, _), (k, t) in zip(rows, data, strict=True):
        off = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - 49):
            if first[t[i : i + 50]] < k:
                off[i : i + 50] = True
        off = off[: len(t)]
        kept = bytes(np.frombuffer(t, np.uint8)[~off])
        spans = sum(1 for i in range(len(t)) if off[i] and (i == 0 or not off[i - 1]))
        out.append((d, len(t), int(off.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(seed, n=60):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé日") for _ in range(r.randrange(1, 7)))
    passages = [" ".join(word() for _ in range(r.choice((9, 12, 30, 200)))) for _ in range(12)] + ["a" * 120, "ab" * 60, "x" * 49, "y" * 50]
    rows = [(0, None), (1, ""), (2, "z" * 49), (3, "z" * 50), (4, "z" * 51), (5, "z" * 300)]
    for d in range(10, 10 + n):
        parts = []
        for _ in range(r.randrange(1, 6)):
            p = r.choice(passages)
            if r.random() < 0.4:
                a = r.randrange(len(p))
                p = p[a : a + r.randrange(30, 200)]
            parts += [p, "".join(word() for _ in range(r.randrange(8)))]
        rows.append((d, "".join(parts)))
    rows += [(r.choice(rows)[0], t) for _, t in rows[6:14]] + [(None, rows[9][1]), (None, rows[10][1])]
    r.shuffle(rows)
    return rows


def test_report_matches_brute_force(spark):
    for seed, size in ((1, 3000), (2, 1 << 20)):
        rows = made(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as batch", "2 as blob").repartition(3)
        got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.report(df, size, 2000).collect()), key=str)
        assert got == brute(rows)


def test_empty(spark):
    assert suffixes.report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pieces_of_long_texts_hold_every_window(monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE_BITS", 8)
    r = random.Random(0)
    texts = [bytes(r.choice(b"ab") for _ in range(n)) for n in (0, 49, 50, 51, 255, 256, 300, 1000)]
    h, text, first, last, at = suffixes.anchors(texts)
    seen = sorted((t, s) for t, a, b in zip(text.tolist(), first.tolist(), last.tolist(), strict=True) for s in range(a, b + 1))
    assert seen == [(i, s) for i, t in enumerate(texts) for s in range(len(t) - 49)]


def test_hot_anchors_are_cut_again(spark):
    """With every shared anchor taken for a hot one."""
    rows = made(3, 40)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.report(df, 3000, 2000, hot=2).collect()), key=str)
    assert got == brute(rows)


def test_arrays_are_in_byte_order_and_merge():
    r = random.Random(4)
    text = bytes(r.choice(b"ab\0") for _ in range(3000))
    _, _, first, last, at = suffixes.anchors([text])
    buf = np.frombuffer(text, np.uint8)
    e = suffixes.entries(buf, np.arange(len(at)), at - first, last + 50 - at, at)
    a = e.take(suffixes.byte_order(e))
    suffix = lambda i: text[at[i] : last[i] + 50].ljust(50, b"\0")
    assert [x.tobytes() for x in a.suffix] == sorted(suffix(i) for i in range(len(at)))
    assert (np.sort(a.keys(), kind="stable") == a.keys()).all()
    half = np.arange(len(at)) % 3 == 0
    both, source = suffixes.merged(a.take(np.flatnonzero(half)), a.take(np.flatnonzero(~half)))
    assert (both.keys() == a.keys()).all() and sorted(source.tolist()) == list(range(len(at)))
    again = suffixes.unpacked([a.packed()])
    assert all((x == y).all() for x, y in zip(again, a, strict=True))


def test_levels_are_geometric():
    one = lambda i: suffixes.entries(np.frombuffer(b"%050d" % i, np.uint8), np.array([i]), np.array([0]), np.array([50]), np.array([0]))
    levels = {}
    for i in range(11):
        levels = suffixes.carried(levels, one(i))
    assert {i: len(x.doc) for i, x in levels.items()} == {0: 1, 1: 2, 3: 8}


def test_batches_are_scanned_against_an_existing_family(spark):
    """Four tables one after another: each against all before it, whatever their ids; the levels are tables."""
    rows = [(d, t) for d, t in made(5, 48) if d is not None]
    seen, family = [], suffixes.Family(parts=8)
    for i in range(4):
        part = rows[i::4]
        got = sorted(((r.doc_id, r.n_removed, r.kept_sha256) for r in family.add(spark.createDataFrame(part, "doc_id long, text string"), 3000).collect()), key=str)
        late = [(10_000 * (i + 1) + d, t) for d, t in part]
        want = [(d - 10_000 * (i + 1), n, sha) for d, _, n, _, sha in brute(seen + late) if d >= 10_000 * (i + 1)]
        assert got == sorted(want, key=str)
        seen += late
        kinds = {r.kind for r in family.levels().select("kind").distinct().collect()}
        assert kinds <= [{"level0"}, {"level1"}, {"level0", "level1"}, {"level2"}][i] | ({"level0", "level1"} if i == 3 else {"level0"})


def test_very_long_text(spark):
    r = random.Random(6)
    text = "".join(r.choice("abcdefgh ") for _ in range(2_500_000))
    rows = [(1, text), (2, text[700_000:700_049] + "#" + text[1_200_000:1_200_060]), (3, text)]
    got = {x.doc_id: (x.n_removed, x.n_spans) for x in suffixes.report(spark.createDataFrame(rows, "doc_id long, text string"), kept=False).collect()}
    assert got == {1: (0, 0), 2: (60, 1), 3: (2_500_000, 1)}


def test_only_changed_levels_are_written(spark):
    """Eight tables of the same size: what each writes is what the binary count of tables changes; plain rewriting would write 36 units."""
    r = random.Random(12)
    family, written = suffixes.Family(parts=8), []
    for i in range(8):
        part = [(100 * i + j, "".join(r.choice("abcdefghij ") for _ in range(1500))) for j in range(20)]
        family.add(spark.createDataFrame(part, "doc_id long, text string"), 3000).collect()
        written.append(family.tables[family.number].where("kind like 'level%'").selectExpr("sum(length(blob)) AS n").first().n)
    unit = written[0]
    assert [round(w / unit) for w in written] == [1, 2, 1, 4, 1, 2, 1, 8]
    assert {x.kind for x in family.levels().select("kind").distinct().collect()} == {"level3"} and len(family.tables) == 1
