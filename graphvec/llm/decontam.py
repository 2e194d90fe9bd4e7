"""Benchmark decontamination by spaced seeds.

Fixed masks ignore some of the token positions they span, so a passage whose words were
partly substituted still hashes alike under one of them.  The masks' hashes of every document
position meet those of the benchmark in a broadcast join; around each hit the document is laid
over the whole item, position by position, and the best-scoring stretch (match +1, mismatch
-2) is the overlap.  A hit takes along only those words of the document that the item covers: a task
holds all hits of a document at once.  A pair counts as leaked if the stretch has `min_matched` equal words, or
covers `min_coverage` of the item.  Only DataFrame functions run here.

A benchmark of more than MAX_SLICE hashes is put in order and cut into slices of so many, wherever
an item begins or ends: each slice is broadcast in turn, with the items that reach into it, so what is broadcast
has a bound (hashes: the slice; words: the slice and two items) however large the benchmark and its items are. The
documents' word hashes are then written once and every slice reads those; what it finds is written before the next.

Edge cases: null or word-less texts and items match nothing; items too short for a mask match
as a whole; items with equal words are reported under their smallest item_id; repeated
documents are each reported once per (doc_id, item_id); empty tables give no rows; `decontaminate`
keeps all columns, whatever they are called.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphvec.operators.ordering import running
from graphvec.storage import discard, materialize

# 1: the word must be equal; 0: it is ignored.
MASKS = ("1101100111", "1110010111", "1111011", "111111")
MIN_MATCHED = 13
MIN_COVERAGE = 0.8
MAX_SLICE = 1_000_000


def token_hashes(text: Column) -> Column:
    """64-bit hash of each lower-cased word (run of letters and digits)."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seed(wh: Column, at: Column, number: int, mask: str) -> Column:
    """Hash of the words under `mask` at `at`; null where the mask passes the end."""
    kept = [F.get(wh, at + i) for i, c in enumerate(mask) if c == "1"]
    return F.when(at + (len(mask) - 1) < F.size(wh), F.xxhash64(F.lit(number), *kept))


def _benchmark(items: DataFrame, text_col: str) -> DataFrame:
    """Distinct word sequences: item_id (smallest), iw, n_items and ik, which tells texts of one item_id apart."""
    d = items.select("item_id", token_hashes(F.col(text_col)).alias("iw")).where((F.size("iw") > 0) & F.col("item_id").isNotNull())
    return d.groupBy("iw").agg(F.min("item_id").alias("item_id"), F.countDistinct("item_id").alias("n_items")).withColumn("ik", F.xxhash64("iw"))


def _covered(doc: str, n: str, diag: str) -> Column:
    """The words of the document that an item of `n` words covers when laid over it at `diag`."""
    return F.slice(doc, F.greatest(F.col(diag), F.lit(0)) + 1, F.col(n) + F.least(F.col(diag), F.lit(0)))


def _best_stretch(covered: str, item: str, diag: str) -> Column:
    """Best-scoring stretch of the item laid over the document at `diag`."""
    wh, iw, d = F.col(covered), F.col(item), F.least(F.col(diag), F.lit(0))

    def step(acc: Column, w: Column) -> Column:
        i = acc["i"]
        same = F.coalesce(F.when(d + i >= 0, F.get(wh, F.greatest(d + i, F.lit(0)))) == w, F.lit(False))
        fresh = acc["score"] <= 0
        score = F.greatest(acc["score"], F.lit(0)) + F.when(same, 1).otherwise(-2)
        start = F.when(fresh, i).otherwise(acc["start"])
        matched = F.when(fresh, 0).otherwise(acc["matched"]) + F.when(same, 1).otherwise(0)
        better = score > acc["best"]
        now = {"i": i + 1, "score": score, "start": start, "matched": matched, "best": F.greatest(acc["best"], score),
               "b_start": F.when(better, start).otherwise(acc["b_start"]), "b_end": F.when(better, i + 1).otherwise(acc["b_end"]),
               "b_matched": F.when(better, matched).otherwise(acc["b_matched"])}
        return F.struct(*[v.cast("int").alias(k) for k, v in now.items()])

    zero = F.struct(*[F.lit(0).alias(k) for k in ("i", "score", "start", "matched", "best", "b_start", "b_end", "b_matched")])
    return F.aggregate(iw, zero, step)


def _leads(masks: Sequence[str]) -> Column:
    """True for the first of a chain of hits: the same mask one word earlier is no hit.
    All hits of a chain lie on one diagonal and would verify the same overlap."""
    p, q = F.col("p"), F.col("q")
    kept = F.get(F.array(*[F.array(*[F.lit(i) for i, c in enumerate(m) if c == "1"]) for m in masks]), F.col("k"))
    chained = F.forall(kept, lambda i: F.get("covered", F.least(p, q) + i - 1) == F.get("iw", q + i - 1))
    return ~((p > 0) & (q > 0) & F.coalesce(chained, F.lit(False)))


def find_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_text_col: str = "text", masks: Sequence[str] = MASKS,
               min_matched: int = MIN_MATCHED, min_coverage: float = MIN_COVERAGE, max_slice: int = MAX_SLICE) -> DataFrame:
    """One row per leaked (doc_id, item_id): n_matched, n_overlap (words of the stretch),
    doc_start (its first word in the document), coverage (matched share of the item), n_items."""
    bench = materialize(_benchmark(items, item_text_col), "benchmark")
    span = max(map(len, masks))
    short = [r[0] for r in bench.where(F.size("iw") < min(map(len, masks))).select(F.size("iw")).distinct().collect()]  # fewer than a mask's span
    every = [*masks, *("1" * n for n in sorted(short))]
    cost = F.size("iw").cast("bigint") * len(every)
    total = bench.agg(F.sum(cost)).first()[0] or 0
    slices = max(1, math.ceil(total / max_slice))
    d = docs.select("doc_id", token_hashes(F.col(text_col)).alias("wh"))
    if slices > 1:
        unplaced = bench
        bench = materialize(running(unplaced.withColumn("cost", cost), [], ["item_id", "ik"], "cost", "benchmark-order").select("item_id", "iw", "n_items", "ik", "cost", "start"), "benchmark")
        discard(unplaced)
        d = materialize(d, "word-hashes")
    at = d.select("doc_id", "wh", F.explode(F.sequence(F.lit(0), F.size("wh") - 1)).alias("p"))
    seeds = at.select("doc_id", "wh", "p", F.posexplode(F.array(*[_seed(F.col("wh"), F.col("p"), k, m) for k, m in enumerate(every)])).alias("k", "h")).where(F.col("h").isNotNull())
    parts = []
    for k in range(slices):
        own = bench.where((F.col("start") < (k + 1) * max_slice) & (F.col("start") + F.col("cost") > k * max_slice)) if slices > 1 else bench
        places = own.select("*", F.explode(F.sequence(F.lit(0), F.size("iw") - 1)).alias("q"))
        if slices > 1:  # a place belongs to the slice of its first hash
            places = places.where(F.floor((F.col("start") + F.col("q") * len(every)) / max_slice) == k)
        keys = [F.when(F.lit(len(m) >= span or len(m) in map(len, masks)) | (F.size("iw") == len(m)), _seed(F.col("iw"), F.col("q"), n, m)) for n, m in enumerate(every)]
        hashes = places.select("item_id", "ik", "q", F.size("iw").alias("n"), F.posexplode(F.array(*keys)).alias("k", "h")).where(F.col("h").isNotNull())
        hits = seeds.join(F.broadcast(hashes), ["k", "h"]).withColumn("diag", F.col("p") - F.col("q"))
        hits = hits.select("doc_id", "k", "p", "q", "item_id", "ik", "n", "diag", _covered("wh", "n", "diag").alias("covered"))
        laid = hits.join(F.broadcast(own.select("item_id", "ik", "iw", "n_items")), ["item_id", "ik"]).where(_leads(every))
        laid = laid.select("doc_id", "item_id", "n_items", "diag", F.size("iw").alias("n"), _best_stretch("covered", "iw", "diag").alias("s"))
        laid = laid.select(
            "doc_id", "item_id", "n_items", F.col("s.b_matched").cast("bigint").alias("n_matched"), (F.col("s.b_end") - F.col("s.b_start")).cast("bigint").alias("n_overlap"),
            (F.col("diag") + F.col("s.b_start")).cast("bigint").alias("doc_start"), (F.col("s.b_matched") / F.col("n")).alias("coverage"))
        # as a generator: a filter would be pushed into the join, which would align each pair again
        leaks = (F.col("n_matched") >= min_matched) | (F.col("coverage") >= min_coverage)
        laid = laid.select("doc_id", "item_id", F.inline(F.when(leaks, F.array(F.struct("n_items", "n_matched", "n_overlap", "doc_start", "coverage")))))
        parts.append(materialize(laid, "leaks") if slices > 1 else laid)  # one slice is broadcast at a time
    found = reduce(DataFrame.unionAll, parts)
    rank = F.struct((-F.col("n_matched")).alias("a"), F.col("n_overlap").alias("b"), F.col("doc_start").alias("c"), F.col("coverage").alias("d"), F.col("n_items").alias("e"))
    best = found.groupBy("doc_id", "item_id").agg(F.min(rank).alias("r"))
    return best.select("doc_id", "item_id", (-F.col("r.a")).alias("n_matched"), F.col("r.b").alias("n_overlap"), F.col("r.c").alias("doc_start"), F.col("r.d").alias("coverage"), F.col("r.e").alias("n_items"))


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """`docs` without those that hold a benchmark passage; a null doc_id always stays."""
    leaked = find_leaks(docs, items, **options).select(F.col("doc_id").alias("_leaked")).distinct()
    return docs.join(leaked, docs["doc_id"] == leaked["_leaked"], "left_anti")
