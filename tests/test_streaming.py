from pyspark.sql import functions as F

from textloom.operators import analyzers as A
from textloom.session import new_table_path
from textloom.streaming import jobs


def feed(spark, rows, schema, files):
    path = new_table_path(spark, "feed")
    spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_upsert_equals_batch_and_survives_a_restart(spark):
    schema = "_id string, seq int, v string"
    rows = [(str(i % 7), i, f"v{i}") for i in range(50)]
    stream = feed(spark, rows, schema, 4)
    path, log = new_table_path(spark, "changes"), new_table_path(spark, "log")
    for _ in range(2):
        jobs.upsert_stream(stream, path, log, ["seq"]).awaitTermination()
    changes = spark.read.parquet(path)
    want = {(str(k), max(i for i in range(50) if i % 7 == k)) for k in range(7)}
    assert {(r._id, r.seq) for r in jobs.current_state(changes, ["seq"]).collect()} == want
    packed = new_table_path(spark, "packed")
    jobs.compact(changes, packed, ["seq"])
    assert {(r._id, r.seq) for r in spark.read.parquet(packed).collect()} == want


def test_late_rows_are_dropped(spark):
    schema = "ts timestamp, text string"
    path, log, out = (new_table_path(spark, n) for n in ("late", "late-log", "late-out"))
    for n, rows in enumerate(([("2024-01-01 10:00:00", "a b")], [("2024-01-01 15:00:00", "c")], [("2024-01-01 10:30:00", "late")], [("2024-01-01 20:00:00", "d")])):
        df = spark.createDataFrame(rows, "ts string, text string").withColumn("ts", F.to_timestamp("ts"))
        df.coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        counts = jobs.token_counts(stream, "text", A.standard(), "ts")
        counts.writeStream.format("parquet").option("path", out).option("checkpointLocation", log).trigger(availableNow=True).start().awaitTermination()
    assert {(r.token, r.n) for r in spark.read.parquet(out).collect()} == {("a", 1), ("b", 1), ("c", 1)}
