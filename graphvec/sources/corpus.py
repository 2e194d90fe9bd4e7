"""Page corpora as text files, and pages fetched by an injected function."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphvec.operators.crawl import fetch_action
from graphvec.storage import materialize


def read_corpora(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, text), a row for each file; a missing file is an error."""
    return spark.read.text(list(paths), wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def write_corpus(fragments: DataFrame, path: str) -> None:
    """Fragments (ord, fragment) in order, through one writer, as a text.  The writer ends each
    row with a line end, which takes the place of the fragment's own last one."""
    fragments.orderBy("ord").select(F.regexp_replace("fragment", r"\n\z", "")).coalesce(1).write.mode("overwrite").text(path)


FETCH = "url string, tries int, action string, status int, markdown string, error string"


def fetch_rounds(urls: DataFrame, fetch: Callable[[str], tuple[int, str]], max_tries: int = 5, pause: float = 35.0, apart: float = 0.0, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """A row (url, tries, action, status, markdown, error) for each of `urls` (url), once each; action is
    use or fail.  `fetch` gives (status, text).

    A round asks for every url that is still open, and its outcome is a written table; between rounds the driver
    pauses, so no task waits for a host.  A host's urls are dealt to one task, which lets `apart` seconds pass between two
    of them and gives the host up for this round when it throttles (429): its other urls stay
    open, without a try counted.  An exception is the url's own failure, and is retried like a bad
    gateway."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        throttled: set[str] = set()
        last: dict[str, float] = {}
        for b in batches:
            out = []
            for url, host, tries in zip(b["url"], b["host"], b["tries"]):
                if host in throttled:
                    out.append((url, tries, "retry", 429, None, None))
                    continue
                if (wait := last.get(host, -apart) + apart - time.monotonic()) > 0:
                    time.sleep(wait)
                last[host] = time.monotonic()
                status, text, error = 502, None, None
                try:
                    status, text = fetch(url)
                except Exception as e:  # whatever a fetcher throws is about this url
                    error = f"{type(e).__name__}: {e}"[:500]
                action = fetch_action(status, tries + 1, max_tries)
                if status == 429:
                    throttled.add(host)
                out.append((url, tries + 1, action, status, (text or "") if action == "use" else None, error))
            yield pd.DataFrame(out, columns=["url", "tries", "action", "status", "markdown", "error"])

    host = F.coalesce(F.try_parse_url("url", F.lit("HOST")), F.lit(""))
    todo = urls.select("url").where("url is not null").distinct().withColumn("tries", F.lit(0))
    done = None
    rounds = 0
    while True:
        asked = todo.withColumn("host", host).repartition("host").sortWithinPartitions("host", "url")
        answers = materialize(asked.mapInPandas(run, FETCH), "fetched")
        over = answers.where("action <> 'retry'")
        done = over if done is None else done.unionAll(over)
        todo = answers.where("action = 'retry'").select("url", "tries")
        rounds += 1
        if todo.isEmpty():
            return done
        if rounds >= 10 * max_tries:  # hosts that throttled whatever the pause
            return done.unionAll(answers.where("action = 'retry'").withColumn("action", F.lit("fail")))
        sleep(pause)


def fetch_pages(urls: DataFrame, fetch: Callable[[str], tuple[int, str]], max_tries: int = 5, pause: float = 0.0) -> DataFrame:
    """(url, markdown) of the urls that could be fetched."""
    return fetch_rounds(urls, fetch, max_tries, pause).where("action = 'use'").select("url", "markdown")
