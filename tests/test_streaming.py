import random
import tempfile

from tessera.streaming import tracker as T


def test_stream_equals_batch(spark):
    rng = random.Random(3)
    rows = [(s, f, o, rng.random() < 0.6) for s in range(4) for f in range(20) for o in range(3) if f >= o * 3]
    rule = T.HotStart(delay=4, unmatched=2)
    frames = spark.createDataFrame(rows, T.FRAME)
    batch = {(r["session"], r["frame"], r["obj"]) for r in T.hot_start_output(frames, ["session", "obj"], "frame", "matched", rule).collect()}
    source, sink, check = (tempfile.mkdtemp(prefix="spark-", dir="/tmp") for _ in range(3))
    for at in range(0, 20, 7):  # frames of a session arrive in order, in files of seven
        part = [r for r in rows if at <= r[1] < at + 7] + ([(s, 20, -1, False) for s in range(4)] if at + 7 >= 20 else [])
        spark.createDataFrame(part, T.FRAME).coalesce(1).write.mode("append").json(source)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = spark.readStream.schema(T.FRAME).option("maxFilesPerTrigger", 1).json(source)
    q = T.hot_start_stream(stream, rule).writeStream.format("parquet").option("path", sink).option("checkpointLocation", check).trigger(availableNow=True).start()
    q.awaitTermination(180)
    out = [(r["session"], r["frame"], r["obj"]) for r in spark.read.parquet(sink).collect()]
    assert len(out) == len(set(out)) and set(out) == batch


def test_keep_alive_limits(spark):
    rows = [(1, f, 1, f < 12) for f in range(30)]
    out = {r["frame"]: r for r in T.keep_alive(spark.createDataFrame(rows, T.FRAME), ["session", "obj"], "frame", "matched").collect()}
    assert out[11]["keep"] == 8 and out[29]["keep"] == -4 and out[19]["keep"] == 0 and out[19]["suppressed"] and not out[18]["suppressed"]
