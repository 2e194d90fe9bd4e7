"""Bounded breadth-first crawl over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphvec.operators.ordering import running
from graphvec.storage import materialize

RETRY_STATUS = (408, 429, 502)


def fetch_action(status: int, tries: int, max_tries: int = 5, retry: tuple[int, ...] = RETRY_STATUS) -> str:
    """What a fetcher does with an answer: use it, retry after a pause, or fail."""
    if status == 200:
        return "use"
    return "retry" if status in retry and tries < max_tries else "fail"


def crawl(start: DataFrame, links: DataFrame, fetched: DataFrame | None = None, max_depth: int = 5) -> DataFrame:
    """(url, depth, ord): pages reached from `start` (url) over `links` (url, ord, link) in
    breadth-first order.  With `fetched` (url), pages outside it count as visited but are left
    out and lead nowhere.  A level joins the frontier with the links and drops visited pages;
    levels end in a written table."""
    seen = frontier = materialize(start.select("url", F.lit(0).alias("depth"), F.lit(0).cast("bigint").alias("ord")), "crawl")
    for depth in range(1, max_depth + 1):
        live = frontier if fetched is None else frontier.join(fetched.select("url"), "url", "left_semi")
        step = live.select("url", F.col("ord").alias("parent")).join(links, "url").groupBy(F.col("link").alias("url")).agg(F.min(F.struct("parent", "ord")).alias("first"))
        step = step.join(seen.select("url"), "url", "left_anti")
        placed = running(step.select("url", "first.parent", "first.ord"), [], ["parent", "ord"], name="crawl-order")
        frontier = materialize(placed.select("url", F.lit(depth).alias("depth"), (F.col("pos") + 1).alias("ord")), "crawl")
        if frontier.isEmpty():
            break
        seen = seen.unionAll(frontier)
    return seen if fetched is None else seen.join(fetched.select("url"), "url", "left_semi")
