"""Token counts: an exact length histogram that answers every context limit.

Documents are encoded once; only (length, number of documents) pairs travel, summed before the
shuffle.  Suffix sums over the distinct lengths give, for each length L, how many documents
and tokens lie at or above it, and the total that truncation to L would leave.  The sums run
in two levels, within blocks of lengths and over blocks, so no task sees more than one block
of lengths or one row a block.  Quantiles and context limits are answered from these sums: the
row of the smallest length at or above a limit has all that a limit needs.

A run of white space that the split pattern keeps together is cut out before the library sees
the text: its regular expression engine overflows the stack on a very long one.

Edge cases: a null or empty text has length 0; texts and runs of any length are taken whole; ties share a row; repeated rows count as often
as they occur; an empty table gives an empty histogram, and 0 or null answers.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphvec.storage import materialize

BLOCK = 4096
LONG_RUN = 1000
# Unicode's white space.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_RUN = re.compile(f"[{SPACES}]{{{LONG_RUN},}}")


@functools.lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def count_tokens(encoding, text: str) -> int:
    """How many tokens `encoding` gives for `text`.  Its pattern takes all but the last character
    of a run of white space as one piece, or all of it at the end of the text."""
    n = at = 0
    for run in _RUN.finditer(text):
        end = run.end() - (run.end() < len(text))
        n += len(encoding.encode_ordinary(text[at : run.start()])) + len(encoding._encode_single_piece(text[run.start() : end]))
        at = end
    return n + len(encoding.encode_ordinary(text[at:]))


def encoded_lengths(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """(n_tokens) for each row of `docs`."""
    with open(ranks_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks.value, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([count_tokens(encoding, t) if t else 0 for t in b.column(0).to_pylist()], pa.int64())], names=["n_tokens"])

    return docs.select(F.col(text_col).cast("string")).mapInArrow(run, "n_tokens bigint")


def histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, n_docs): how many documents have each length."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def context_table(hist: DataFrame) -> DataFrame:
    """For each distinct length L: n_docs of that length, docs_at_least and tokens_at_least
    (documents of L tokens or more, and their tokens), total_docs, total_tokens, and
    truncated_tokens, the sum of min(length, L)."""
    hist = materialize(hist, "lengths")  # read twice below, and its documents are encoded once
    h = hist.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("t", F.col("n_tokens") * F.col("n_docs"))
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("t").alias("t"))
    above = Window.orderBy(F.desc("block"))  # one row a block of lengths
    later = above.rowsBetween(Window.unboundedPreceding, -1)
    whole = above.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select("block", *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_later") for c in "dt"], *[F.sum(c).over(whole).alias(f"{c}_total") for c in "dt"])
    within = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = h.join(blocks, "block").withColumns({"dl": F.sum("n_docs").over(within) + F.col("d_later"), "tl": F.sum("t").over(within) + F.col("t_later")})
    return s.select(
        "n_tokens", "n_docs", F.col("dl").alias("docs_at_least"), F.col("tl").alias("tokens_at_least"), F.col("d_total").alias("total_docs"),
        F.col("t_total").alias("total_tokens"), (F.col("t_total") - F.col("tl") + F.col("n_tokens") * F.col("dl")).alias("truncated_tokens"))


def at_limits(table: DataFrame, limits: Sequence[int]) -> DataFrame:
    """From a context_table, one row for each context limit, whether or not a document has that
    length: docs_over, tokens_kept (truncated to the limit) and tokens_cut."""
    n = F.col("n_tokens")
    above = lambda limit: F.min_by(F.struct("docs_at_least", "tokens_at_least"), F.when(n > limit, n))
    sums: list[Column] = [F.coalesce(F.max("total_tokens"), F.lit(0)).alias("total"), *[above(limit).alias(f"a{k}") for k, limit in enumerate(limits)]]
    rows = []
    for k, limit in enumerate(limits):
        docs, tokens = (F.coalesce(F.col(f"a{k}.{c}"), F.lit(0)) for c in ("docs_at_least", "tokens_at_least"))
        cut = tokens - limit * docs
        rows.append(F.struct(F.lit(limit).cast("bigint").alias("context_limit"), docs.alias("docs_over"), (F.col("total") - cut).alias("tokens_kept"), cut.alias("tokens_cut")))
    return table.agg(*sums).select(F.inline(F.array(*rows)))


def quantiles(table: DataFrame, shares: Sequence[float]) -> DataFrame:
    """For each share q the smallest length that at least q of the documents do not exceed."""
    not_over = F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")
    cols = [F.min(F.when(not_over >= F.ceil(F.lit(float(q)) * F.col("total_docs")), F.col("n_tokens"))).alias(f"q{k}") for k, q in enumerate(shares)]
    rows = [F.struct(F.lit(float(q)).alias("share"), F.col(f"q{k}").alias("n_tokens")) for k, q in enumerate(shares)]
    return table.agg(*cols).select(F.inline(F.array(*rows)))
