from pyspark.sql import functions as F

from sievewright import streaming

SCHEMA = "seq long, filename string, source string, download_url string, license string"


def feed(spark, folder, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.json(str(folder / name))


def test_upsert_by_batches(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    stream = lambda: spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").json(str(src))
    feed(spark, src, [(1, "a.jpg", "s", "u1", "CC0"), (2, "b.jpg", "s", "u1", "CC0"), (3, "c.jpg", "s", "u3", "GFDL")], "one")
    for name, rows in (("two", [(4, "d.jpg", "s", "u1", "CC0"), (5, "e.jpg", "s", "u5", "CC0")]), (None, None)):
        q = streaming.upsert_batches(stream(), out, "seq", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
        if name:
            feed(spark, src, rows, name)
    assert sorted(r.filename for r in streaming.current(spark, out).collect()) == ["a.jpg", "e.jpg"]
    assert streaming.current(spark, str(tmp_path / "none")) is None
    wrote = lambda: sorted(p.name for p in (tmp_path / "out").iterdir() if "=" in p.name)
    assert len(wrote()) == 2 and spark.read.parquet(f"{out}/{wrote()[1]}").count() == 1  # a batch holds its own rows
    streaming.compact(spark, out)
    assert len(wrote()) == 1 and wrote()[0].startswith("base=") and sorted(r.filename for r in streaming.current(spark, out).collect()) == ["a.jpg", "e.jpg"]
    feed(spark, src, [(6, "f.jpg", "s", "u6", "CC0"), (7, "g.jpg", "s", "u5", "CC0")], "three")
    streaming.upsert_batches(stream(), out, "seq", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.filename for r in streaming.current(spark, out).collect()) == ["a.jpg", "e.jpg", "f.jpg"]


def test_first_seen_and_windows(spark, tmp_path):
    src = tmp_path / "ev"
    rows = [("2024-01-01 00:01:00", "u1", "a"), ("2024-01-01 00:02:00", "u1", "a"), ("2024-01-01 00:12:00", "u2", "b"), ("2024-01-01 05:00:00", "u3", "b")]
    spark.createDataFrame(rows, "t string, download_url string, event_type string").withColumn("ts", F.col("t").cast("timestamp")).drop("t").write.parquet(str(src))
    read = lambda: spark.readStream.schema("download_url string, event_type string, ts timestamp").parquet(str(src))

    def run(df, name, mode="append"):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name)

    assert run(streaming.first_seen(read()), "seen").count() == 3
    assert run(streaming.first_seen(read(), time="ts"), "seen_late").count() == 3
    got = {(str(r.start), r.event_type): r.n for r in run(streaming.counts_by_window(read(), "ts", "event_type"), "windows", "complete").collect()}
    assert got == {("2024-01-01 00:00:00", "a"): 2, ("2024-01-01 00:10:00", "b"): 1, ("2024-01-01 05:00:00", "b"): 1}
