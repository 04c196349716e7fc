"""Weighted counts of a point stream against the static polygon index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from evenground.operators.clean import usable
from evenground.operators.spatial import CellIndex, point_in_polygon
from evenground.session import discard_paths


def stream_counts(points: DataFrame, index: CellIndex, keys: Sequence[str] = ("dataset_id",)) -> DataFrame:
    """Running weighted count per key and area.

    A stream-static left join followed by a grouped sum; the state holds one
    row per key and area, however many points arrive.
    """
    joined = point_in_polygon(usable(points), index)
    return joined.groupBy(*keys, "GEOID").agg(
        F.sum("weight").alias("weighted_counts"), F.count("*").alias("n_joined")
    )


def write_counts(counts: DataFrame, path: str, checkpoint: str, available_now: bool = True, compact_every: int = 50,
                 keys: Sequence[str] = ("dataset_id", "GEOID")) -> StreamingQuery:
    """Write the counts that each micro batch has changed.

    A batch writes ``changes/batch=<n>`` with one row for each changed key, its
    new totals; a repeated batch replaces its folder.  Every ``compact_every``
    batches the newest row of each key goes to ``base/upto=<n>``, and what it
    replaces is deleted.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/changes/batch={batch_id:012d}")
        if (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, path, batch_id, keys)

    writer = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(save)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _complete(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders whose job has ended, in ascending order."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place):
        return []
    done = [f.getPath() for f in store.listStatus(place)]
    return sorted(p.getName() for p in done if store.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def latest_counts(spark: SparkSession, path: str, keys: Sequence[str] = ("dataset_id", "GEOID"), upto: int | None = None) -> DataFrame:
    """The newest row of each key, up to a batch if one is given."""
    number = lambda name: int(name.split("=")[1])
    bases = [b for b in _complete(spark, f"{path}/base") if upto is None or number(b) <= upto]
    least = number(bases[-1]) if bases else -1
    later = [c for c in _complete(spark, f"{path}/changes") if number(c) > least and (upto is None or number(c) <= upto)]
    folders = [f"{path}/base/{bases[-1]}"] if bases else []
    folders += [f"{path}/changes/{c}" for c in later]
    if not folders:
        raise ValueError(f"no counts at {path}")
    # the folder's number orders the rows of a key
    batch = F.regexp_extract(F.col("_metadata.file_path"), "(?:batch|upto)=([0-9]+)", 1).cast("bigint")
    rows = spark.read.parquet(*folders).withColumn("batch_", batch)
    values = [c for c in rows.columns if c not in (*keys, "batch_")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_").alias("v"))
    return newest.select(*keys, "v.*")


def compact(spark: SparkSession, path: str, upto: int, keys: Sequence[str] = ("dataset_id", "GEOID")) -> None:
    """Newest rows up to a batch as one folder; older folders go when it is
    whole, so a failure on the way leaves the counts as they were."""
    name = f"upto={upto:012d}"
    # a repeated batch finds its own base and adds nothing to it
    if name not in _complete(spark, f"{path}/base"):
        latest_counts(spark, path, keys, upto).write.mode("overwrite").parquet(f"{path}/base/{name}")
    old = [f"{path}/changes/{c}" for c in _complete(spark, f"{path}/changes") if int(c.split("=")[1]) <= upto]
    old += [f"{path}/base/{b}" for b in _complete(spark, f"{path}/base") if int(b.split("=")[1]) < upto]
    discard_paths(spark, old)
