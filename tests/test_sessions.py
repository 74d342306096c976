"""Session lifecycle: cases by hand, stream against batch, and a restart in the middle."""

import random
import tempfile
from datetime import datetime, timedelta

from tessera.streaming import sessions

T0, TTL = datetime(2024, 1, 1), timedelta(minutes=10)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_lifecycle(spark):
    rows = [
        (1, 1, at(0), "add_prompt", 7), (1, 2, at(1), "start", None), (1, 3, at(2), "add_prompt", 7), (1, 4, at(2), "add_prompt", 7), (1, 5, at(3), "add_prompt", None),
        (1, 6, at(4), "remove_object", 9), (1, 7, at(5), "what", None), (1, 8, at(14), "reset", None), (1, 9, at(15), "add_prompt", 1), (1, 10, at(16), "close", None),
        (1, 11, at(17), "close", None), (1, 12, at(18), "propagate", None), (1, 13, at(19), "start", None), (1, 14, at(29), "propagate", None), (1, 15, at(40), "propagate", None),
        (None, 1, at(0), "start", None), (2, 1, at(0), "close", None), (3, 1, at(0), "start", None), (3, 2, at(5), "start", None), (3, 3, at(39), "start", 4),
    ]
    got = {(r["session"], r["seq"] or r["at"]): (r["action"], r["ok"], r["lifetime"], r["prompts"], r["objects"]) for r in sessions.session_answers(spark.createDataFrame(rows, sessions.REQUEST), TTL).collect()}
    want = [("add_prompt", False, None, 0, 0), ("start", True, 1, 0, 0), ("add_prompt", True, 1, 1, 1), ("add_prompt", True, 1, 2, 1), ("add_prompt", True, 1, 3, 1), ("remove_object", True, 1, 3, 1), ("what", False, 1, 3, 1), ("reset", True, 1, 0, 0),
            ("add_prompt", True, 1, 1, 1), ("close", True, 1, 0, 0), ("close", True, None, 0, 0), ("propagate", False, None, 0, 0), ("start", True, 2, 0, 0), ("propagate", True, 2, 0, 0), ("propagate", False, None, 0, 0)]
    assert [got[(1, k + 1)] for k in range(15)] == want
    expired = {k: v for k, v in got.items() if v[0] == "expired"}
    assert expired == {(1, at(39)): ("expired", True, 2, 0, 0), (None, at(10)): ("expired", True, 1, 0, 0), (3, at(15)): ("expired", True, 2, 0, 0)}
    assert got[(3, 3)] == ("start", True, 3, 0, 0) and got[(2, 1)] == ("close", True, None, 0, 0)
    assert sessions.session_answers(spark.createDataFrame([], sessions.REQUEST), TTL).count() == 0


def test_stream_equals_batch_across_a_restart(spark):
    r = random.Random(4)
    rows = [(r.randrange(5), k, at(2 * k + r.random()), r.choice([*sessions.ACTIONS, "add_prompt", "what"]), r.choice([None, 1, 2, 3])) for k in range(120)]
    rows.append((99, 1000, at(300), "close", None))  # moves the watermark past every open session's time
    source, sink, check = (tempfile.mkdtemp(prefix="spark-", dir="/tmp") for _ in range(3))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def run(part):
        for i in range(0, len(part), 25):
            spark.createDataFrame(part[i : i + 25], sessions.REQUEST).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(sessions.REQUEST).option("maxFilesPerTrigger", 1).parquet(source)
        q = sessions.session_stream(stream, TTL).writeStream.format("parquet").option("path", sink).option("checkpointLocation", check).trigger(availableNow=True).start()
        q.awaitTermination(300)
        assert q.exception() is None

    run(rows[:70])
    run(rows[70:])  # a new query on the same checkpoint: open sessions go on
    batch = plain(sessions.session_answers(spark.createDataFrame(rows, sessions.REQUEST), TTL))
    assert plain(spark.read.parquet(sink)) == batch
    assert any(x[3] == "expired" for x in batch)
