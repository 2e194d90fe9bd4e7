"""Versions of a set of tables in one folder: incremental commits, a change feed, old versions.

A table's rows are dealt into buckets by a hash of their key, and each bucket is a folder that is
written once.  A commit is one small file, `commits/<number>.json`, which names the folder of every
bucket of every table; it is created only if it does not exist, so of two writers from one version one is
refused and starts again from the other's result.  A change rewrites the buckets that its keys fall
into and takes over all other folders as they are.  Its rows, upserts and deleted keys, are kept
as a feed: a version is an earlier one with the feed between applied.

Creating a file only if it is absent is one step on HDFS and on stores with conditional puts; on a local disk it is
a check and a write, which is for tests.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphvec.storage import remove

BUCKETS = 16
TRIES = 10


class CommitRefused(RuntimeError):
    """Another writer has committed first, again and again."""


class Table(NamedTuple):
    """Layout of a table, and how changed rows meet those of their keys."""

    schema: T.StructType
    key: list[str]
    merge: Callable[[DataFrame, DataFrame], DataFrame]


class VersionedTables:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    # --- the log ---

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path, path(self.root).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _numbers(self) -> list[int]:
        path, fs = self._fs()
        folder = path(f"{self.root}/commits")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def entry(self, number: int) -> dict:
        """What commit `number` says: tables (name to bucket to folder), change, buckets.  Number 0 is the
        empty store; one that a writer left unfinished says what the one before says."""
        if number <= 0:
            return {"tables": {}, "change": None}
        path, fs = self._fs()
        file = path(f"{self.root}/commits/{number:020d}.json")
        if fs.exists(file):
            stream = fs.open(file)
            try:
                text = bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
            if text.endswith("\n"):
                return json.loads(text)
        return {**self.entry(number - 1), "change": None}

    def version(self) -> int:
        """Number of the last commit."""
        return max(self._numbers(), default=0)

    def _commit(self, number: int, tables: dict, change: dict | None) -> bool:
        path, fs = self._fs()
        try:
            stream = fs.create(path(f"{self.root}/commits/{number:020d}.json"), False)
        except Exception as e:
            if "AlreadyExists" in str(e):
                return False
            raise
        stream.write(bytearray((json.dumps({"tables": tables, "change": change, "buckets": self.buckets}) + "\n").encode()))
        stream.close()
        return True

    def commit(self, change: Callable[[dict], tuple[dict, dict | None]]) -> int:
        """Commit what `change` makes of the tables of the last version, from that version anew each time another
        writer comes first.  Returns the new version."""
        for _ in range(TRIES):
            last = self.version()
            tables, feed = change(self.entry(last)["tables"])
            if self._commit(last + 1, tables, feed):
                return last + 1
        raise CommitRefused(f"{TRIES} commits in a row met a newer version")

    # --- tables ---

    def _bucket(self, key: list[str]):
        return F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int")

    def _folders(self, df: DataFrame, key: list[str]) -> dict[str, str]:
        """Write `df` in buckets; the folder of each bucket that has rows."""
        name = f"data/{uuid.uuid4().hex}"
        df.withColumn("_bucket", self._bucket(key)).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/{name}")
        path, fs = self._fs()
        found = [s.getPath().getName() for s in fs.listStatus(path(f"{self.root}/{name}"))]  # one for each bucket
        return {n.split("=")[1]: f"{name}/{n}" for n in found if n.startswith("_bucket=")}

    def _rows(self, folders: list[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def names(self, version: int | None = None) -> list[str]:
        return sorted(self.entry(self.version() if version is None else version)["tables"])

    def read(self, name: str, table: Table, version: int | None = None) -> DataFrame:
        """The table at `version`, or as it is now; without rows if it is not there."""
        tables = self.entry(self.version() if version is None else version)["tables"]
        return self._rows(list(tables.get(name, {}).values()), table.schema)

    def replace(self, frames: dict[str, tuple[Table, DataFrame | None]]) -> int:
        """Whole tables anew, in one commit; None drops a table.  Such a version has no feed."""
        written = {n: None if df is None else self._folders(df.select(*t.schema.names), t.key) for n, (t, df) in frames.items()}

        def change(tables: dict) -> tuple[dict, dict | None]:
            kept = {n: f for n, f in tables.items() if n not in written}
            return {**kept, **{n: f for n, f in written.items() if f is not None}}, None

        return self.commit(change)

    def apply(self, changes: dict[str, tuple[Table, DataFrame | None, DataFrame | None]]) -> int:
        """Upsert rows and delete keys of several tables, (table, rows or None, keys or None) each, in one
        commit; a key that is in both is deleted.  Only buckets that hold a changed key are read and
        written."""
        feed, touched = {}, {}
        for name, (table, rows, keys) in changes.items():
            for kind, df in (("upserts", rows), ("deletes", keys)):
                if df is not None:
                    folders = self._folders(df if kind == "upserts" else df.select(*table.key).distinct(), table.key)
                    feed.setdefault(name, {})[kind] = folders
                    touched.setdefault(name, set()).update(folders)

        def change(tables: dict) -> tuple[dict, dict | None]:
            after = {n: dict(f) for n, f in tables.items()}
            for name, (table, rows, keys) in changes.items():
                old = after.setdefault(name, {})
                met = [old.pop(b) for b in sorted(touched[name]) if b in old]
                new = self._applied(self._rows(met, table.schema), table, feed[name], rows, keys)
                old.update(self._folders(new, table.key))
            return after, feed

        return self.commit(change)

    def _applied(self, old: DataFrame, table: Table, feed: dict, rows: DataFrame | None, keys: DataFrame | None) -> DataFrame:
        new = old
        if rows is not None:
            new = table.merge(new, self._rows(list(feed["upserts"].values()), rows.schema))
        if keys is not None:
            gone = self._rows(list(feed["deletes"].values()), keys.select(*table.key).schema)
            new = new.join(gone, table.key, "left_anti")
        return new.select(*table.schema.names)

    def changes(self, name: str, table: Table, after: int, until: int | None = None) -> list[tuple[int, DataFrame | None, DataFrame | None]]:
        """(version, upserted rows, deleted keys) of each commit that changed the table, in order."""
        found = []
        for number in self._numbers():
            if number <= after or (until is not None and number > until):
                continue
            feed = (self.entry(number)["change"] or {}).get(name)
            if feed:
                frame = lambda kind, f=feed: self.spark.read.parquet(*[f"{self.root}/{x}" for x in f[kind].values()]) if f.get(kind) else None
                found.append((number, frame("upserts"), frame("deletes")))
        return found

    def replay(self, name: str, table: Table, after: int, until: int) -> DataFrame:
        """The table at `until`, from that at `after` and the feed between."""
        rows = self.read(name, table, after)
        for _, upserts, deletes in self.changes(name, table, after, until):
            if upserts is not None:
                rows = table.merge(rows, upserts)
            if deletes is not None:
                rows = rows.join(deletes.select(*table.key), table.key, "left_anti")
        return rows.select(*table.schema.names)

    def vacuum(self, keep: int = 1) -> int:
        """Delete the folders that none of the last `keep` versions names; how many went.  Readers
        of older versions must have ended."""
        numbers = self._numbers()[-keep:]
        entries = [self.entry(n) for n in numbers]
        used = {f.split("/")[1] for e in entries for t in e["tables"].values() for f in t.values()}
        used |= {f.split("/")[1] for e in entries for t in (e["change"] or {}).values() for k in t.values() for f in k.values()}
        path, fs = self._fs()
        data = path(f"{self.root}/data")
        gone = [s.getPath().getName() for s in fs.listStatus(data) if s.getPath().getName() not in used] if fs.exists(data) else []
        remove(self.spark, f"{self.root}/data", gone)
        return len(gone)
