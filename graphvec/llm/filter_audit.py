"""Filter interaction audit: what five filters remove in every order of application.

Relational word pipeline: words are exploded and counted by (document, word), these counts by
document give total and distinct words, and an outer join with the other flags gives each
document its five failures as bits; all of this stands behind one shuffle of the texts.  Documents of one text, part, failures and labels are counted
together; the smallest doc_id of a text says which of them repeat it, so a text that a third of
all rows share is a partial sum per task and never a join key.  One row a part with 32
conditional counts (and 32 for good and for toxic documents) answers all 120 orders: a step's
numbers are sums over the failure sets that meet it.

Failures (bit i of the set is filter i): A under 100 words; B 100 * distinct < 80 * words;
C 100 * [A-Z] > 10 * code points; D any of [#$%&*|]; E the text of a smaller doc_id.

Edge cases: a null text is empty and fails A; a null lang is the part ''; a document is a (doc_id,
text): repeated rows count as often as they occur and none fails E for another of the same doc_id; a
null doc_id never fails E, makes no other fail, and has no label; a doc_id is good or toxic if
any of its labels says so; an empty table has no part and gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import math
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
SPACE = r"[\x20\x09-\x0D]+"
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 100, 80, 10
SYMBOLS = r"[#$%&*|]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


KEY = ["doc_id", "h", "part"]


def word_totals(texts: DataFrame) -> DataFrame:
    """(KEY, n_words, n_distinct) of each row (KEY, n, text) that has a word."""
    words = texts.select(*KEY, "n", F.explode(F.split("text", SPACE)).alias("word")).where("word <> ''")
    counts = words.groupBy(*KEY, "n", "word").agg(F.count("*").alias("times"))
    return counts.groupBy(*KEY, "n").agg(F.sum("times").alias("n_words"), F.count("*").alias("n_distinct")).drop("n")


def failures(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", part_col: str = "lang") -> DataFrame:
    """(part, failed, good, toxic, n): how many documents of each part fail just the filters of
    the set `failed` and are labelled so."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part")).withColumn("h", F.xxhash64("text"))
    # the one shuffle of texts: repeated rows are one before it, and all counting by document and word stays behind it
    d = d.groupBy(*KEY).agg(F.min("text").alias("text"), F.count("*").alias("n"))
    upper = F.length("text") - F.length(F.translate("text", UPPER, ""))
    flags = d.select(*KEY, "n", F.sha2("text", 256).alias("digest"), (100 * upper > UPPER_PERCENT * F.length("text")).alias("c"), F.col("text").rlike(SYMBOLS).alias("d"))
    met = [F.col(f"f.{k}").eqNullSafe(F.col(f"w.{k}")) for k in KEY]
    all_flags = flags.alias("f").join(word_totals(d).alias("w"), met[0] & met[1] & met[2], "left").select("f.*", F.coalesce("n_words", F.lit(0)).alias("n_words"), F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(*[F.coalesce(F.max(F.col(a) == 1), F.lit(False)).alias(b) for a, b in (("quality", "good"), ("toxic", "toxic"))])
    all_flags = all_flags.join(marks, "doc_id", "left").withColumns({b: F.coalesce(b, F.lit(False)) for b in ("good", "toxic")})
    bit = lambda c, i: F.when(c, 1 << i).otherwise(0)
    failed = bit(F.col("n_words") < MIN_WORDS, 0) + bit(100 * F.col("n_distinct") < DISTINCT_PERCENT * F.col("n_words"), 1) + bit(F.col("c"), 2) + bit(F.col("d"), 3)
    # rows of one text: all of them, those without a doc_id, and those of the smallest one
    same = all_flags.groupBy("digest", "part", failed.alias("failed"), "good", "toxic").agg(
        F.sum("n").alias("all"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"), F.min("doc_id").alias("least"), F.min_by("n", F.col("doc_id")).alias("of_least"))
    least = F.min("least").over(Window.partitionBy("digest"))  # a few rows a text: its parts and labels
    same = same.withColumn("first", F.col("unnamed") + F.when(F.col("least") == least, F.col("of_least")).otherwise(0))
    both = same.select("part", "good", "toxic", F.inline(F.array(F.struct("failed", F.col("first").alias("n")), F.struct((F.col("failed") + (1 << 4)).alias("failed"), (F.col("all") - F.col("first")).alias("n")))))
    return both.groupBy("part", "failed", "good", "toxic").agg(F.sum("n").alias("n"))


def audit(counts: DataFrame) -> DataFrame:
    """From `failures`: a row for each part, order and step."""
    sets = range(1 << len(FILTERS))
    kinds = {"n": F.lit(True), "g": F.col("good"), "t": F.col("toxic")}
    table = counts.groupBy("part").agg(*[F.coalesce(F.sum(F.when((F.col("failed") == s) & keep, F.col("n"))), F.lit(0)).alias(f"{k}{s}") for k, keep in kinds.items() for s in sets])
    table = table.select("part", *[F.array(*[F.col(f"{k}{s}") for s in sets]).alias(k) for k in kinds])
    steps = [{"filter_order": o, "step": i + 1, "own": 1 << FILTERS.index(f), "before": sum(1 << FILTERS.index(x) for x in o[:i])} for o in map("".join, permutations(FILTERS)) for i, f in enumerate(o)]
    r = table.select("*", F.inline(F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, own: int, before: int>>")))

    def over(column: str, meets) -> Column:
        """Sum over the failure sets s that `meets` accepts."""
        kept = F.transform(column, lambda x, s: F.when(meets(s), x).otherwise(F.lit(0).cast("bigint")))
        return F.aggregate(kept, F.lit(0).cast("bigint"), lambda acc, x: acc + x)

    own, before = F.col("own"), F.col("before")
    here = lambda s: (s.bitwiseAND(own) != 0) & (s.bitwiseAND(before) == 0)
    # a document goes at this filter in the orders in which it comes first of those it fails
    orders = F.lit(math.factorial(len(FILTERS)))
    share = F.transform("n", lambda x, s: F.when(s.bitwiseAND(own) != 0, x * (orders / F.bit_count(s)).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return r.select(
        "part", "filter_order", "step", over("n", lambda s: s.bitwiseAND(own.bitwiseOR(before)) == 0).alias("kept"), over("n", here).alias("removed"),
        over("n", lambda s: (s.bitwiseAND(own) != 0) & (s.bitwiseAND(before) != 0)).alias("redundant"), over("n", lambda s: s == own).alias("unique_fails"),
        over("g", here).alias("good_lost"), over("t", here).alias("toxic_lost"), F.aggregate(share, F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("shapley"))
