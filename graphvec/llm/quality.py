"""Quality rules: text statistics, then a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word uni- and bigrams are counted, one over the trusted target
(four of five documents whose label says quality 1) and one over the whole raw corpus.  A
document's score is the mean over its n-grams of log(p_target / p_raw), smoothed towards 0
where a bucket is rare, so length does not matter.  The fifth of the trusted documents that
was not counted tells how trusted text scores, and sets one threshold for every document: four
standard deviations below their mean, but at most one below their smallest score.  Only
DataFrame functions run here.

Edge cases: a null text has no words; a document without words scores 0 and is not kept,
since it also fails the base rules; without labels the target equals the raw corpus and all
scores are 0.  Repeated rows are judged alike; an empty table gives no rows.  All input columns
stay, save that quality_rules replaces columns with the names of its own.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphvec.storage import broadcast_if_small, materialize

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
BUCKETS = 1 << 14
PRIOR = 10.0  # n-grams of raw text that each target bucket starts with
MAX_BROADCAST_LABELS = 2_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _repeat_words(words: str) -> Column:
    """Words that stand in a 3-word window found twice or more in the text.  Windows are
    hashed and sorted; those with an equal neighbour repeat, and their positions are merged."""
    n = F.size(words)
    windows = F.when(
        n >= 3,
        F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(
            F.xxhash64(F.get(F.col(words), i), F.get(F.col(words), i + 1), F.get(F.col(words), i + 2)).alias("h"),
            i.alias("p"))),
    )
    return F.sort_array(windows)


def _covered(places: str) -> Column:
    """Length of the union of [p, p + 3) over sorted positions p."""
    p = F.col(places)
    steps = F.zip_with(F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), lambda a, b: F.least(F.lit(3), b - a))
    return F.when(F.size(p) > 0, F.aggregate(steps, F.lit(3).cast("bigint"), lambda acc, x: acc + x)).otherwise(F.lit(0).cast("bigint"))


def base_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs`, whose columns begin with no underscore, with _words and the base columns."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    d = docs.withColumns({"_words": words_of(F.col(text_col)), "_lines": lines})
    d = d.withColumns({
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "_windows": _repeat_words("_words"),
    })
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    repeated = F.filter("_windows", lambda x, i: same(F.get(F.col("_windows"), i - 1), x) | same(F.get(F.col("_windows"), i + 1), x))
    d = d.withColumn("_places", F.sort_array(F.coalesce(repeated["p"], F.array().cast("array<int>"))))
    d = d.withColumn("n_repeat_words", _covered("_places"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return d.withColumn("base_failed", failed).drop("_lines", "_windows", "_places")


def ngram_buckets(words: str, buckets: int) -> Column:
    """Bucket of every uni- and bigram, repeats included."""
    w = F.col(words)
    uni = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int"))
    bi = F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w), F.lit(1))),
                    lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int"))
    return F.concat(uni, bi)


def target_ids(labels: DataFrame, held_out: bool, max_broadcast: int = MAX_BROADCAST_LABELS) -> DataFrame:
    """Trusted doc_ids: a fifth by hash is held out from the counts."""
    ids = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    fifth = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    return broadcast_if_small(ids.where(fifth if held_out else ~fifth), max_broadcast)


def log_ratio_table(docs: DataFrame, labels: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, log_ratio) for every bucket: log of the target's count over what the raw share
    would give it, both with PRIOR added.
    All documents and all labels are counted; a bucket's counts are summed before the shuffle."""
    marked = docs.select("doc_id", text_col).join(
        target_ids(labels, False).withColumn("_target", F.lit(1)), "doc_id", "left"
    )
    grams = marked.select(F.col("_target"), words_of(F.col(text_col)).alias("_w")).select("_target", F.explode(ngram_buckets("_w", buckets)).alias("bucket"))
    counted = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("_target").alias("target"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    full = materialize(every.join(counted, "bucket", "left").na.fill(0, ["raw", "target"]), "ngrams")  # one row a bucket
    total = full.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    raw, target = total["raw"] or 0, total["target"] or 0
    ratio = F.log((F.col("target") + PRIOR) / (F.col("raw") * F.lit(target / max(raw, 1)) + PRIOR))
    return full.select("bucket", (ratio if target else F.lit(0.0)).alias("log_ratio"))


FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr")


def learned_threshold(trusted: DataFrame) -> float:
    """From judged trusted documents: max(mean - 4 sd, least - sd) of those that pass the base
    rules; with fewer than two nothing says what to reject, and all pass.  Sums are of decimals, so that they do not
    depend on the order in which tasks end."""
    llr = F.when(~F.col("base_failed"), F.round("llr", 9).cast("decimal(18,9)"))
    total, squares, least, n = trusted.agg(F.sum(llr), F.sum((llr * llr).cast("decimal(28,18)")), F.min(llr), F.count(llr)).first()
    if n < 2:
        return -math.inf
    total, squares = Fraction(total), Fraction(squares)
    sd = math.sqrt((squares - total * total / n) / (n - 1))
    return max(float(total / n) - 4 * sd, float(least) - sd)


def _judged(docs: DataFrame, labels: DataFrame, text_col: str, buckets: int, threshold: float | None, carry: Sequence[str]) -> DataFrame:
    """row (the columns `carry` of a row), FEATURES and kept.  Texts are judged once: the written
    rows tell the threshold and take it."""
    table = log_ratio_table(docs, labels, text_col, buckets)
    # as many rows as there are buckets, whatever the corpus holds
    ratios = table.agg(F.sort_array(F.collect_list(F.struct("bucket", "log_ratio")))["log_ratio"].alias("r")).first()["r"]
    held = F.lit(ratios) if ratios else F.array()
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col("doc_id").alias("id"), F.col(text_col).cast("string").alias("text"))
    d = base_features(d).withColumn("_grams", ngram_buckets("_words", buckets))
    total = F.aggregate("_grams", F.lit(0.0), lambda acc, b: acc + F.get(held, b))
    d = d.withColumn("llr", F.when(F.size("_grams") > 0, total / F.size("_grams")).otherwise(F.lit(0.0)))
    d = materialize(d.select("row", "id", *FEATURES), "judged")
    if threshold is None:
        threshold = learned_threshold(d.join(target_ids(labels, True).withColumnRenamed("doc_id", "id"), "id", "left_semi"))
    return d.select("row", *FEATURES, (~F.col("base_failed") & (F.col("llr") >= threshold)).alias("kept"))


def keep(docs: DataFrame, labels: DataFrame, text_col: str = "text", buckets: int = BUCKETS, threshold: float | None = None) -> DataFrame:
    """The rows of `docs` that quality_rules keeps, whatever their other columns are called."""
    return _judged(docs, labels, text_col, buckets, threshold, docs.columns).where("kept").select("row.*")


def quality_rules(docs: DataFrame, labels: DataFrame, text_col: str = "text", buckets: int = BUCKETS, threshold: float | None = None, carry: Sequence[str] | None = None) -> DataFrame:
    """The columns `carry` of `docs` (all, unless given) with the base columns, llr (mean log
    ratio per n-gram) and kept."""
    names = docs.columns if carry is None else list(carry)
    rest = [F.col("row").getField(c).alias(c) for c in names if c.lower() not in (*FEATURES, "kept")]
    return _judged(docs, labels, text_col, buckets, threshold, names).select(*rest, *FEATURES, "kept")
