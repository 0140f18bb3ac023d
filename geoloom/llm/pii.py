"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base entities (email, ip, card, phone) come from fixed patterns and always stay. They are the seeds, and so is half (by
hash) of the strings in the form of a key or token, for the kind `secret`. The words around each seed form lexical
patterns; the graph of patterns and instances is scored in rounds. A pattern that nearly always surrounds known
instances of one kind labels whatever other identifier-like string it surrounds, of any form, with spaces or without;
these count as known, as sure as their pattern, in the next round. Secrets are reported where a pattern labels them
only, so half of the token forms must be found again by context: `recovered` counts how many are.

Confidence of a pattern: known instances of its kind, by score, to all known ones and UNKNOWN times the unlabelled ones.

Regular expressions are written for one linear scan: a match can only begin where a run begins or where the last match
ended, and repeated groups are possessive, so that long runs neither backtrack nor recurse. Positions are running sums by blocks,
overlaps one sort and a running furthest end, and contexts are cut from short pieces of the text: the work grows with the text's length, not its square. Contexts are cut from REACH
characters on either side, which is part of what a pattern is; identifiers themselves have no greatest length.

Defined results: null and empty texts have no spans; spans are in code points, end excluded; equal rows get equal
spans; rows are told apart by a row number, so repeated rows and null doc_ids are rows like any other; an empty table
gives no rows; report() reads only doc_id and text, and redact() keeps every other column, whatever its name. Base spans
of different kinds may overlap; added spans overlap no base span and begin after the last added one ended.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm import common

KINDS = ("email", "ip", "card", "phone")
EVERY = (*KINDS, "secret")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What may be an identifier: a whole token with a digit or an at sign, with the groups of digits that follow it after single spaces; what it ends with is trimmed to a letter, a digit or a bracket, and LEAST characters must be left.
CANDIDATE = r"(?<![0-9A-Za-z@._+(-])[A-Za-z+(._-]*+[0-9@][0-9A-Za-z().:_@+-]*+(?:\x20[0-9(][0-9().-]*+)*+"
LEAST = 5
#: The form of a key or token: long, without spaces, with letters and digits.
TOKEN = r"^(?=[^0-9]*+[0-9])(?=[^A-Za-z]*+[A-Za-z])[0-9A-Za-z_-]{20,}$"
#: Characters on either side that contexts are cut from.
REACH = 40
#: A pattern needs this score of different known instances of its kind, and this confidence; unlabelled instances count UNKNOWN each against it.
SUPPORT, CONFIDENCE, UNKNOWN, ROUNDS = 4, 0.75, 0.25, 3
SPAN = "struct<kind:string,start:int,end:int,value:string>"
SPANS = f"array<{SPAN}>"
#: Numbers that running() folds together, and code points of a text that cut() keeps together.
BLOCK, PIECE = 64, 512


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    n = F.length(digits)
    at = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(F.substring(digits, n - i + 1, F.lit(1)).cast("int").alias("d"), (i % 2 == 0).alias("twice")))
    total = F.aggregate(at, F.lit(0), lambda a, x: a + F.when(x["twice"], x["d"] * 2 - F.when(x["d"] > 4, 9).otherwise(0)).otherwise(x["d"]))
    return total % 10 == 0


def valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.lpad(F.ltrim(p, F.lit("0")), 3, "0") <= "255"))
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(13, 19) & F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    return F.length(digits).between(9, 15)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once however often use names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, fold: Callable[[Column, Column], Column], levels: int = 3) -> Column:
    """What fold makes of 0 and all values before each, and in the end of all of them: one number more than values. Blocks of
    BLOCK numbers are folded by themselves and then from where the ones before them ended, so an array is never copied more than a block at a time."""
    zero = F.lit(0)

    def within(start: Column, block: Column) -> Column:
        state = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(block, state, lambda a, v: F.struct(fold(a["at"], v).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])

    if not levels:
        return bound(values, lambda v: F.concat(within(zero, v), F.array(F.aggregate(v, zero, fold))))

    def blockwise(v: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.call_function("div", F.size(v), F.lit(BLOCK)).cast("int")), lambda i: F.slice(v, i * BLOCK + 1, F.lit(BLOCK)))
        return bound(cut, whole)

    def whole(blocks: Column) -> Column:
        starts = running(F.transform(blocks, lambda b: F.aggregate(b, zero, fold)), fold, levels - 1)
        return bound(starts, lambda at: F.concat(F.flatten(F.transform(blocks, lambda b, i: within(F.get(at, i), b))), F.slice(at, -1, 1)))

    return bound(values, blockwise)


def cut(text: Column) -> Column:
    """text in pieces of PIECE code points, for between()."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))


def between(pieces: Column, start: Column, end: Column) -> Column:
    """The text from start to end (code points from 0, clipped to the text), by way of the pieces that hold it alone."""
    low = F.greatest(start, F.lit(0))
    first = F.call_function("div", low, F.lit(PIECE)).cast("int")
    count = F.call_function("div", F.greatest(end - 1, low), F.lit(PIECE)).cast("int") - first + 1
    return F.substring(F.array_join(F.slice(pieces, first + 1, count), ""), low - first * PIECE + 1, F.greatest(end - low, F.lit(0)))


def located(text: Column, kind: str, pattern: str) -> Column:
    """All matches as spans. What stands between matches comes from a split by the same pattern, so positions are running sums of lengths."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def spans(z: Column) -> Column:
        steps = F.transform(z["m"], lambda m, i: F.length(F.element_at(z["g"], i + 1)) + F.length(m))
        return bound(running(steps, lambda a, x: a + x), lambda at: F.transform(z["m"], lambda m, i: F.struct(F.lit(kind).alias("kind"), (F.get(at, i + 1) - F.length(m)).alias("start"), F.get(at, i + 1).alias("end"), m.alias("value"))))

    return F.when(text.rlike(pattern), bound(F.struct(gaps.alias("g"), found.alias("m")), spans)).otherwise(F.array().cast(SPANS))


def base(text: Column) -> dict[str, Column]:
    """Valid base spans by kind."""

    def checked(kind: str, pattern: str) -> Column:
        return F.filter(located(text, kind, pattern), lambda s: valid(kind, s["value"]))

    return {k: checked(k, p) for k, p in PATTERNS.items()}


def mentions(text: Column, spans: Column) -> Column:
    """Spans with their contexts: the two and the three words before (what touches the span counts as one), and the word before with the word after; digits stand as #."""

    def side(s: Column) -> Column:
        return F.regexp_replace(F.lower(s), "[0-9]+", "#")

    def of(pieces: Column, s: Column) -> Column:
        left, right = side(between(pieces, s["start"] - REACH, s["start"])), side(between(pieces, s["end"], s["end"] + REACH))
        three, two = F.regexp_extract(left, r"([^\s]+\s+[^\s]+\s+[^\s]*\s*)$", 1), F.regexp_extract(left, r"([^\s]+\s+[^\s]*\s*)$", 1)
        one, nxt = F.regexp_extract(left, r"([^\s]+\s*)$", 1), F.regexp_extract(right, r"^(\s*[^\s]*)", 1)
        words = F.array(F.concat(F.lit("l3 "), F.trim(three)), F.concat(F.lit("l "), F.trim(two)), F.concat(F.lit("lr "), F.trim(one), F.lit(" _ "), F.trim(nxt)))
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), words.alias("contexts"))

    some = bound(cut(text), lambda pieces: F.transform(spans, lambda s: of(pieces, s)))
    return F.when(F.size(spans) > 0, some).otherwise(F.transform(spans, lambda s: of(F.array(F.lit("")), s)))


def apart(known: Column, others: Column) -> Column:
    """Those of others (in order, without overlap) that overlap no known span: one sort by place, and the furthest end so far."""
    at = lambda s: F.struct(s["start"].alias("at"), F.lit(1).alias("turn"), s["end"].alias("reach"), F.lit(None).cast(SPAN).alias("span"))
    end = lambda s: F.struct(s["end"].alias("at"), F.lit(0).alias("turn"), F.lit(0).alias("reach"), s.alias("span"))
    events = F.array_sort(F.concat(F.transform(known, at), F.transform(others, end)))

    def free(e: Column) -> Column:
        reach = running(F.transform(e, lambda x: x["reach"]), lambda a, x: F.greatest(a, x))
        zipped = bound(reach, lambda r: F.filter(F.transform(e, lambda x, i: F.struct(x["turn"].alias("turn"), F.get(r, i).alias("reach"), x["span"].alias("span"))), lambda x: (x["turn"] == 0) & (x["reach"] <= x["span"]["start"])))
        return F.transform(zipped, lambda x: x["span"])

    return F.when((F.size(known) > 0) & (F.size(others) > 0), bound(events, free)).otherwise(others)


def candidates(text: Column) -> Column:
    """Identifier-like strings as spans without a kind."""

    def trimmed(s: Column) -> Column:
        value = F.regexp_replace(s["value"], r"[^0-9A-Za-z)]+$", "")
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), (s["start"] + F.length(value)).alias("end"), value.alias("value"))

    return F.filter(F.transform(located(text, "", CANDIDATE), trimmed), lambda s: F.length(s["value"]) >= LEAST)


def extracted(docs: DataFrame, keep_rows: bool = False) -> DataFrame:
    """key (a row number), doc_id, the base spans of each kind, and all mentions (candidates have no kind): a written table. keep_rows: with all columns of docs in the struct `whole`."""
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")] if keep_rows else []
    one = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *whole)
    two = one.select("*", *[c.alias(f"s_{k}") for k, c in base(F.col("text")).items()], candidates(F.col("text")).alias("other"))
    known = F.concat(*[f"s_{k}" for k in KINDS])
    three = two.withColumn("free", apart(known, F.col("other")))
    return common.written(three.select("key", "doc_id", *[f"s_{k}" for k in KINDS], mentions(F.col("text"), F.concat(known, "free")).alias("mentions"), *(["whole"] if keep_rows else [])))


def is_seed(value: Column) -> Column:
    """The half of the token forms that patterns are learned from."""
    return value.rlike(TOKEN) & (F.pmod(F.xxhash64(F.lower(value)), F.lit(2)) == 0)


def labelled(m: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """instance, kind, score of the strings that confident patterns label, from mentions (kind, value, contexts)."""
    seed = F.when(F.col("kind") != "", F.col("kind")).when(is_seed(F.col("value")), F.lit("secret"))
    edges = common.written(m.select(F.explode("contexts").alias("pattern"), F.lower("value").alias("instance"), seed.alias("kind")).groupBy("pattern", "instance").agg(F.max("kind").alias("kind")))
    seeds = common.written(edges.where("kind is not null").groupBy("instance").agg(F.max("kind").alias("kind"), F.lit(1.0).alias("score")))
    known, new = seeds, None
    for _ in range(rounds):
        scored = edges.select("pattern", "instance").join(known.select("instance", F.col("kind").alias("as_kind"), "score"), "instance", "left")
        by = scored.groupBy("pattern").agg(F.count_if(F.col("as_kind").isNull()).alias("unknown"), *[F.sum(F.when(F.col("as_kind") == k, F.col("score")).otherwise(0.0)).alias(k) for k in EVERY])
        best = F.greatest(*EVERY)
        kind = F.coalesce(*[F.when(F.col(k) == best, F.lit(k)) for k in EVERY])
        every = sum((F.col(k) for k in EVERY), F.lit(0.0))
        good = by.select("pattern", kind.alias("as_kind"), best.alias("support"), (best / (every + UNKNOWN * F.col("unknown"))).alias("confidence")).where((F.col("support") >= SUPPORT) & (F.col("confidence") >= CONFIDENCE))
        # an instance is as sure as its surest pattern; base entities keep their own kind
        hits = edges.where("kind is null or kind = 'secret'").join(good, "pattern")
        new = common.written(hits.groupBy("instance").agg(F.max_by("as_kind", F.struct("confidence", "as_kind")).alias("kind"), F.max("confidence").alias("score")))
        known = seeds.unionByName(new.join(seeds, "instance", "left_anti"))
    return new


def discovered(table: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """key, kind, start, end of the strings that confident patterns label, from an extracted() table."""
    m = table.where(F.size("mentions") > 0).select("key", F.explode("mentions").alias("m")).select("key", "m.*")
    new = labelled(m, rounds).select("instance", F.col("kind").alias("as_kind"))
    return m.where("kind = ''").join(new, F.lower("value") == F.col("instance")).select("key", F.col("as_kind").alias("kind"), "start", "end")


def recovered(docs: DataFrame) -> tuple[int, int]:
    """Of the different token forms that are no seeds: how many patterns label as secrets, and how many there are."""
    m = extracted(docs).select(F.explode("mentions").alias("m")).select("m.*")
    hidden = m.where("kind = ''").where(F.col("value").rlike(TOKEN) & ~is_seed(F.col("value"))).select(F.lower("value").alias("instance")).distinct()
    found = labelled(m).where("kind = 'secret'")
    return hidden.join(found, "instance", "left_semi").count(), hidden.count()


def found(docs: DataFrame, keep_rows: bool = False) -> DataFrame:
    """The columns of extracted() without mentions, and added (the method's spans, in order) of each row. Only rows with candidates are joined."""
    table = extracted(docs, keep_rows)
    more = discovered(table).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("added"))
    plain = lambda a: F.transform(a, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    rest = [*(plain(F.col(f"s_{k}")).alias(f"s_{k}") for k in KINDS), *(["whole"] if keep_rows else [])]
    some = F.exists("mentions", lambda s: s["kind"] == "")
    joined_rows = table.where(some).select("key", "doc_id", *rest).join(more, "key", "left").withColumn("added", F.coalesce(plain("added"), none))
    return joined_rows.unionByName(table.where(~some).select("key", "doc_id", *rest, none.alias("added")))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, digest of the base spans, all spans, how many the method added, and how many there are in all."""
    f = found(docs)
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")

    def of(kind: str) -> Column:
        return F.array_sort(F.concat(F.col(f"s_{kind}") if kind in KINDS else none, F.filter("added", lambda s: s["kind"] == kind)))

    every = F.concat(*map(of, EVERY))
    seeds = F.concat(*[f"s_{k}" for k in KINDS])
    counts = [F.size(f"s_{k}").cast("long").alias(f"n_{k}") for k in KINDS]
    return f.select("doc_id", *counts, F.sha2(joined(seeds), 256).alias("base_sha256"), joined(every).alias("spans"), F.size("added").cast("long").alias("n_added"), F.size(every).cast("long").alias("n_spans"))


def redact(docs: DataFrame) -> DataFrame:
    """docs with each span of text replaced by its kind in square brackets; overlapping spans become one, named after the first. Texts without spans stay as they are."""
    f = found(docs, keep_rows=True)
    spans = F.array_sort(F.transform(F.concat(*[f"s_{k}" for k in KINDS], "added"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    text, f = F.col("whole.text"), f.select("whole", spans.alias("spans"))

    def cleaned(z: Column) -> Column:
        """Spans that begin where all before them have ended are named; each takes the text since then with it."""
        p, reach = z["pieces"], z["reach"]
        parts = F.transform("spans", lambda s, i: F.when(s["start"] >= F.get(reach, i), F.concat(between(p, F.get(reach, i), s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))))
        return F.concat(F.array_join(parts, ""), between(p, F.element_at(reach, -1), F.length(text)))

    ends = running(F.transform("spans", lambda s: s["end"]), lambda a, x: F.greatest(a, x))
    clean = bound(F.struct(cut(text).alias("pieces"), ends.alias("reach")), cleaned)
    return f.select(*[F.when(F.size("spans") > 0, clean).otherwise(text).alias("text") if c == "text" else F.col("whole").getField(c).alias(c) for c in docs.columns])
