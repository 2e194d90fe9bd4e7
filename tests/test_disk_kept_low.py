import glob
import random
import time

from pyspark.sql import functions as F

from graphvec.operators import metrics
from graphvec.storage import CLEANUP, materialize


def shuffle_files(spark):
    root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in root for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, conf = shuffle_files(spark), spark.conf.get(CLEANUP)
    df = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    written = materialize(df, "counts")
    for _ in range(100):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)  # files go in the background
    assert not shuffle_files(spark) - before and spark.conf.get(CLEANUP) == conf
    assert written.agg(F.sum("count")).first()[0] == df.agg(F.sum("count")).first()[0] == 10_000


def test_paths_in_waves_of_sources(spark, monkeypatch):
    r = random.Random(3)
    links = {(i, i + 1) for i in range(199)} | {(r.randrange(200), r.randrange(200)) for _ in range(40)}
    near = {i: {b for a, b in links if a == i} | {a for a, b in links if b == i} for i in range(200)}
    far = []
    for s in range(200):
        seen = {s: 0}
        queue = [s]
        for x in queue:
            for y in sorted(near[x] - seen.keys()):
                seen[y] = seen[x] + 1
                queue.append(y)
        far += seen.values()
    pairs = metrics.simple_pairs(spark.createDataFrame(sorted(links), "src int, dst int"))
    held = []
    written = metrics.materialize

    def noted(df, label, *rest):
        out = written(df, label, *rest)
        if label == "reached":
            held.append(out.select("block").distinct().count())
        return out

    monkeypatch.setattr(metrics, "materialize", noted)
    assert metrics.path_totals(pairs, spark.range(200), part=64, block=64, wave_bytes=2 * 64 * 200 // 8 * 9) == (max(far), sum(far))
    assert max(held) == 2  # four blocks, two at a time
