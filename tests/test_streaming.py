"""Counts of a stream: only changed keys are written, and repeats change nothing."""

import glob

import pytest
from pyspark.sql import functions as F

from evenground.functions.geometry import box_rings
from evenground.operators.clean import usable
from evenground.operators.spatial import cell_index, weighted_counts
from evenground.streaming.counts import compact, latest_counts, stream_counts, write_counts

SCHEMA = "dataset_id string, lon double, lat double, weight double, drop_reason string, row_error string"
FILES = [[(0.5, 1.0), (0.6, 2.0), (1.5, 1.0)], [(0.5, 3.0)], [(9.0, 1.0)], [(1.2, 1.0), (2.5, 4.0)], [(0.1, 0.5)]]


@pytest.mark.parametrize("every", [50, 2, 1])
def test_changed_keys_only(spark, tmp_path, every):
    squares = spark.range(3).select(F.col("id").cast("string").alias("GEOID"), box_rings(F.col("id"), F.lit(0), F.col("id") + 1, F.lit(1)).alias("rings"))
    index = cell_index(squares)
    for i, rows in enumerate(FILES):
        table = spark.createDataFrame([("d", x, 0.5, w, None, None) for x, w in rows], SCHEMA)
        table.coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    out = f"{tmp_path}/out"
    write_counts(stream_counts(stream, index), out, f"{tmp_path}/state", compact_every=every).awaitTermination()
    read = lambda: sorted(map(tuple, latest_counts(spark, out).select("dataset_id", "GEOID", "weighted_counts", "n_joined").collect()), key=repr)
    everything = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/in/*")
    want = sorted(map(tuple, weighted_counts(usable(everything), index).select("dataset_id", "GEOID", "weighted_counts", "n_joined").collect()), key=repr)
    assert read() == want
    left = sorted(glob.glob(f"{out}/changes/batch=*"))
    assert len(left) == {50: 5, 2: 1, 1: 0}[every]
    if every == 50:
        assert [spark.read.parquet(f).count() for f in left] == [len({int(x) for x, _ in rows}) for rows in FILES]
    compact(spark, out, 4)
    compact(spark, out, 4)
    assert read() == want and not glob.glob(f"{out}/changes/batch=*")
