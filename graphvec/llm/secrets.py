"""Secret scans: three fixed patterns plus sliding-window Shannon entropy.

Matches are located with DataFrame functions only: a text is split at a pattern's matches,
so a match starts where the pieces and matches before it end.  Candidate strings are whole
runs of 20 key characters or more.  What the allow-list matches is taken out of a candidate.
Over each stretch of a class's characters in the rest, a window of 20 characters slides, with a
count for each character of the class: a step adds one to the count of the character that
enters and takes one from that of the character that leaves, and the sum of c * log2(c) changes
by these two counts alone.  A candidate with a stretch whose largest window entropy reaches its
class's limit is a span of kind `entropy`, unless it lies within a fixed pattern's span; one that
reaches beyond such a span stands whole beside it.

Work grows with the length of a text: sums over its matches run in two levels, and a text is
cut from chunks of CHUNK characters.

Edge cases: a null or empty text has no spans; ties of start go by kind (assign, access, hex,
entropy); repeated rows are scanned alike; an empty table gives no rows; all input columns stay,
save that base_spans, secret_spans and n_confirmed replace columns of these names in
`secret_scan`; `redact` changes no column but the text, whatever the others are called.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the contract. Group 2 of the first is the secret.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# AKIA[A-Z0-9]+ of 20 characters or more, and [0-9a-f]+ of 24 or more: a run too short to
# count leaves nothing for a later match, so the lengths can stand in the patterns.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
MIN_SECRET = 6

KINDS = ("assign", "access", "hex", "entropy")
CANDIDATE = r"[A-Za-z0-9+/=_-]{20,}"
WINDOW = 20
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# class name, its characters, pattern of a stretch of them, what it must also contain, bits of entropy
CLASSES = (
    ("hex", DIGITS + "ABCDEFabcdef", r"[0-9a-fA-F]{20,}", (r"[0-9]", r"[a-fA-F]"), 3.0),
    ("alnum", DIGITS + UPPER + LOWER, r"[A-Za-z0-9]{20,}", (r"[0-9]", r"[A-Z]", r"[a-z]"), 3.7),
    ("base64", DIGITS + UPPER + LOWER + "+/=_-", r"[A-Za-z0-9+/=_-]{20,}", (r"[0-9]", r"[A-Z]", r"[a-z]"), 3.9),
)
# What looks random but is no secret: identifiers, digests, and placeholders with the letters
# and digits that they are joined to. Only what a pattern matches is allowed, not its candidate.
ALLOW = (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"(?i)[a-z0-9]{0,64}(example|sample|dummy|placeholder|changeme|redacted)[a-z0-9]{0,64}",
    r"(?i)^(sha1|sha256|sha512|md5)-([0-9a-f]{128}|[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32}|[a-z0-9+/]{86}==|[a-z0-9+/]{43}=|[a-z0-9+/]{27}=|[a-z0-9+/]{22}==)",
    r"(?i)[a-z0-9]{0,64}(abcdefgh|01234567)[a-z0-9]{0,64}",
)

CHUNK = 4096
LEVEL = 512

SPAN = "array<struct<start:int,kind:int,end:int>>"
FOUND = "array<struct<start:int,kind:int,end:int,match:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), where value is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _before(name: str, combine: Callable[[Column, Column], Column]) -> Column:
    """For each number of column `name`, an array, what `combine` makes of 0 and all numbers
    before it.  Two levels: within blocks of LEVEL, and over blocks."""
    v = F.col(name)

    def scan(numbers: Column) -> Column:
        begin = F.struct(F.lit(0).alias("now"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(numbers, begin, lambda acc, x: F.struct(combine(acc["now"], x).alias("now"), F.concat(acc["out"], F.array(acc["now"])).alias("out")))

    blocks = F.transform(F.sequence(F.lit(0), F.size(v) - 1, F.lit(LEVEL)), lambda i: scan(F.slice(v, i + 1, F.lit(LEVEL))))
    sums = _let(blocks, lambda b: F.flatten(F.zip_with(b, scan(F.transform(b, lambda x: x["now"]))["out"], lambda x, head: F.transform(x["out"], lambda y: combine(y, head)))))
    return F.when(F.size(v) > 0, sums).otherwise(F.array().cast("array<int>"))


PATTERNS = (ASSIGN, ACCESS, HEX, CANDIDATE)


def _located(d: DataFrame) -> DataFrame:
    """Column text -> for each pattern k, found<k>: the leftmost non-overlapping matches."""
    kinds = range(len(PATTERNS))
    text = F.col("text")
    none = F.array().cast("array<string>")
    matches = {f"m{k}": F.when(text.rlike(p), F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none) for k, p in enumerate(PATTERNS)}
    gaps = {f"g{k}": F.when(text.rlike(p), F.transform(F.split(text, p, -1), lambda x: F.length(x))).otherwise(F.array().cast("array<int>")) for k, p in enumerate(PATTERNS)}
    d = d.withColumns(matches | gaps | {"values": F.when(text.rlike(ASSIGN), F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))).otherwise(none)})
    d = d.withColumns({f"s{k}": F.zip_with(F.slice(F.col(f"g{k}"), 1, F.size(f"m{k}")), f"m{k}", lambda g, m: g + F.length(m)) for k in kinds})
    d = d.withColumns({f"b{k}": _before(f"s{k}", lambda a, b: a + b) for k in kinds})

    def spans(k: int) -> Column:
        rows = F.arrays_zip(F.col(f"b{k}").alias("b"), F.slice(F.col(f"g{k}"), 1, F.size(f"m{k}")).alias("g"), F.col(f"m{k}").alias("m"), (F.col("values") if k == 0 else F.col(f"m{k}")).alias("v"))
        if k == 0:
            rows = F.filter(rows, lambda x: F.length(x["v"]) >= MIN_SECRET)
        return F.transform(rows, lambda x: F.struct((x["b"] + x["g"]).alias("start"), F.lit(k).alias("kind"), (x["b"] + x["g"] + F.length(x["m"])).alias("end"), x["m"].alias("match"))).cast(FOUND)

    return d.select("row", "text", *[spans(k).alias(f"found{k}") for k in kinds])


def window_entropy(s: Column, characters: str, window: int = WINDOW) -> Column:
    """Largest Shannon entropy, in bits, of a window of `s`, a string of the given characters;
    null if `s` is shorter."""
    weights = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 1)])
    # each character's place among `characters`, and that of the one that leaves with it
    codes = F.transform(F.regexp_extract_all(s, F.lit("(?s)."), F.lit(0)), lambda c: F.position(c, F.lit(characters)) - 1)
    pairs = _let(codes, lambda c: F.arrays_zip(c.alias("into"), F.concat(F.array_repeat(F.lit(-1), window), F.slice(c, 1, F.greatest(F.size(c) - window, F.lit(0)))).alias("out")))

    def step(acc: Column, x: Column) -> Column:
        counts, into, out = acc["counts"], x["into"], x["out"]
        count = lambda i: F.get(counts, i)
        weigh = lambda c: F.get(weights, c)
        gained = weigh(count(into) + 1) - weigh(count(into)) - F.when(out >= 0, weigh(count(out)) - weigh(count(out) - 1)).otherwise(0.0)
        same = into == out
        total = F.when(same, acc["total"]).otherwise(acc["total"] + gained)
        moved = F.when(same, counts).otherwise(F.transform(counts, lambda c, i: c + (i == into).cast("int") - (i == out).cast("int")))
        full = acc["n"] + 1 >= window
        return F.struct(moved.alias("counts"), total.alias("total"), (acc["n"] + 1).alias("n"), F.when(full, F.least(acc["least"], total)).otherwise(acc["least"]).alias("least"))

    begin = F.struct(F.array_repeat(F.lit(0), len(characters)).alias("counts"), F.lit(0.0).alias("total"), F.lit(0).alias("n"), F.lit(math.inf).alias("least"))
    least = F.aggregate(F.filter(pairs, lambda x: x["into"].isNotNull()), begin, step)["least"]
    return F.when(F.length(s) >= window, F.lit(math.log2(window)) - least / F.lit(float(window)))


def _suspicious(s: Column, classes: Sequence, allow: Sequence[str]) -> Column:
    for pattern in allow:
        s = F.regexp_replace(s, pattern, " ")
    hit = F.lit(False)
    for _, characters, stretch, also, bits in classes:

        def of_class(x: Column, characters=characters, also=also, bits=bits) -> Column:
            has = F.lit(True)
            for pattern in also:
                has = has & x.rlike(pattern)
            return F.when(has, window_entropy(x, characters) >= bits).otherwise(False)

        hit = hit | F.exists(F.regexp_extract_all(s, F.lit(stretch), F.lit(0)), lambda x: of_class(x))
    return hit


def _scanned(docs: DataFrame, text_col: str, classes: Sequence, allow: Sequence[str]) -> DataFrame:
    """row (all of a row's columns), text, base and spans (arrays of spans), n_confirmed."""
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    d = _located(d)
    plain = lambda found: F.transform(found, lambda x: F.struct(x["start"], x["kind"], x["end"])).cast(SPAN)
    entropy = F.filter("found3", lambda x: _suspicious(x["match"], classes, allow))
    d = d.select("row", "text", F.sort_array(F.concat(*[plain(F.col(f"found{k}")) for k in range(3)])).alias("base"), plain(entropy).alias("entropy"))
    # both lists merge in one order, in which a running largest end says what a span lies in or meets
    event = lambda at, entropy, x: F.struct(at.alias("at"), F.lit(entropy).alias("entropy"), x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))
    of = lambda name, entropy, at: F.transform(name, lambda x: event(x[at], entropy, x))
    ends = lambda events, entropy: F.transform(events, lambda x: F.when(x["entropy"] == entropy, x["end"]).otherwise(0))
    d = d.withColumns({"by_start": F.sort_array(F.concat(of("base", 0, "start"), of("entropy", 1, "start"))), "by_end": F.sort_array(F.concat(of("base", 0, "end"), of("entropy", 1, "start")))})
    d = d.withColumns({"base_ends": ends("by_start", 0), "entropy_ends": ends("by_end", 1)})
    d = d.withColumns({f"{c}_before": _before(c, lambda a, b: F.greatest(a, b)) for c in ("base_ends", "entropy_ends")})
    both = lambda events, before: F.arrays_zip(F.col(events).alias("x"), F.col(before).alias("reached"))
    inside = F.filter(both("by_start", "base_ends_before"), lambda y: (y["x"]["entropy"] == 1) & (y["reached"] < y["x"]["end"]))
    free = F.transform(inside, lambda y: F.struct(y["x"]["start"], y["x"]["kind"], y["x"]["end"])).cast(SPAN)
    met = F.filter(both("by_end", "entropy_ends_before"), lambda y: (y["x"]["entropy"] == 0) & (y["reached"] > y["x"]["start"]))
    return d.select("row", "text", "base", F.sort_array(F.concat("base", free)).alias("spans"), F.size(met).cast("bigint").alias("n_confirmed"))


def secret_scan(docs: DataFrame, text_col: str = "text", classes: Sequence = CLASSES, allow: Sequence[str] = ALLOW) -> DataFrame:
    """`docs` with base_spans and secret_spans (base and entropy), arrays of (start, kind, end) in
    code points, by start and then kind, and n_confirmed: base spans that a random string meets."""
    made = {"base": "base_spans", "spans": "secret_spans", "n_confirmed": "n_confirmed"}
    rest = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in made.values()]
    return _scanned(docs, text_col, classes, allow).select(*rest, *[F.col(k).alias(v) for k, v in made.items()])


def spans_text(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"], x["end"])), ",")


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[REDACTED]", classes: Sequence = CLASSES, allow: Sequence[str] = ALLOW) -> DataFrame:
    """`docs` with every secret span replaced by `mask`; overlapping spans merge."""
    d = _scanned(docs, text_col, classes, allow)
    d = d.select("row", "text", "spans", F.transform("spans", lambda x: x["end"]).alias("ends"))
    chunks = F.when(F.size("spans") > 0, F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % CHUNK), F.lit(0)))
    d = d.select("row", "text", "spans", "ends", _before("ends", lambda a, b: F.greatest(a, b)).alias("reached"), chunks.alias("chunks"))

    def cut(a: Column, b: Column) -> Column:
        first, last = F.floor(a / CHUNK).cast("int"), F.floor((b - 1) / CHUNK).cast("int")
        return F.when(b > a, F.substring(F.array_join(F.slice("chunks", first + 1, last - first + 1), ""), a % CHUNK + 1, b - a)).otherwise("")

    parts = F.zip_with("spans", "reached", lambda x, at: F.when(x["start"] >= at, F.concat(cut(at, x["start"]), F.lit(mask))).otherwise(""))
    tail = cut(F.array_max("ends"), F.length("text"))
    masked = F.when(F.size("spans") > 0, F.concat(F.array_join(parts, ""), tail)).otherwise(F.col("row").getField(text_col))
    return d.select(*[masked.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
