"""State from frame to frame: cases by hand, and stream against table across a restart."""

import random
import tempfile

import duckdb
import pytest

from tessera.plans import tracking
from tessera.plans.common import ORACLES
from tessera.streaming import folds


def test_recent_occlusion(spark):
    rows = [
        (1, 0, 1, False, False, [2]), (1, 0, 2, True, False, [1]),  # neither was occluded before: none goes; 2 has last 0
        (1, 1, 1, False, False, [2]), (1, 1, 2, False, False, [1]),  # 1 never was: 2 is not later than an occluded one
        (1, 2, 1, True, False, []), (1, 2, 2, False, False, []),  # 1 has last 2
        (1, 3, 1, False, False, [2]), (1, 3, 2, False, False, None),  # 1 was occluded later than 2: it goes
        (1, 4, 2, False, False, []), (1, 5, 1, False, True, [2]), (1, 5, 2, True, False, [1]),  # 1 was forgotten and is new, taken out: always occluded
        (None, 0, 1, True, False, []), (None, 1, 1, False, False, []),
    ]
    out = {tuple(r)[:3]: tuple(r)[3:] for r in folds.rule_table(spark.createDataFrame(rows, folds.RecentOcclusion.row), folds.RecentOcclusion()).collect()}
    assert out == {
        (1, 0, 1): (False, -1), (1, 0, 2): (False, 0), (1, 1, 1): (False, -1), (1, 1, 2): (False, 0), (1, 2, 1): (False, 2), (1, 2, 2): (False, 0),
        (1, 3, 1): (True, 3), (1, 3, 2): (False, 0), (1, 4, 2): (False, 0), (1, 5, 1): (True, 5), (1, 5, 2): (False, 5), (None, 0, 1): (False, 0), (None, 1, 1): (False, 0)}
    back = {tuple(r)[:3]: r["suppressed"] for r in folds.rule_table(spark.createDataFrame(rows[:8], folds.RecentOcclusion.row), folds.RecentOcclusion(reverse=True)).collect()}
    assert {k for k, v in back.items() if v} == {(1, 1, 1), (1, 3, 2)} - ({(1, 3, 2)} if rows[7][5] is None else set())


def test_reconditioning(spark):
    box, far = (0.0, 0.0, 10.0, 10.0), (8.0, 8.0, 18.0, 18.0)
    rows = [
        (1, 1, 1, *box, 0.9, 0.9), (1, 1, 2, *box, 0.9, 0.9),
        (1, 2, 1, *far, 0.5, 0.9), (1, 2, 2, *box, 0.9, 0.9),  # left, but not sure
        (1, 3, 1, *far, 0.9, 0.9), (1, 3, 2, *box, 0.9, 0.5),  # left and sure: all are renewed but the one of low score
        (1, 4, 1, *far, 0.9, 0.9), (1, 8, 2, *far, 0.1, 0.9), (1, 9, 2, *far, 0.9, 0.9),
    ]
    rule = folds.Reconditioning(every=8, iou=0.5)
    out = {tuple(r)[1:3]: tuple(r)[3:] for r in folds.rule_table(spark.createDataFrame(rows, rule.row), rule).collect()}
    assert out == {(1, 1): (False, False, 0), (1, 2): (False, False, 0), (2, 1): (False, False, 1), (2, 2): (False, False, 1), (3, 1): (True, True, 0), (3, 2): (False, False, 2), (4, 1): (False, False, 1), (8, 2): (False, True, 0), (9, 2): (False, False, 1)}
    never = folds.Reconditioning(every=0, iou=0.0)
    assert not any(r["reconditioned"] for r in folds.rule_table(spark.createDataFrame(rows, never.row), never).collect())


def test_reconditioning_at_the_threshold_is_as_in_sql(spark, tmp_path):
    """Boxes 20 apart have an IoU of exactly 0.2; of half of these pairs the corners give areas of not quite 300."""
    rows = "select 2 * k + second as event_id, timestamp '2024-01-02' + second * interval '1 day' as ts, k as user_id, 'click' as event_type, round(70 + k / 100 + 20 * second, 2)::double as value from range(2000) a(k), range(2) b(second)"
    con = duckdb.connect()
    con.execute(f"create table events as select event_id // 2 * 10 + event_id % 2 * 5 as event_id, * exclude (event_id) from ({rows})")
    con.execute(f"copy events to '{tmp_path}/events.parquet' (format parquet)")
    names = "session, frame, obj, mismatched, reconditioned, age"
    theirs = sorted(con.execute(f"select {names} from ({ORACLES['n11_recondition']})").fetchall())
    assert len(theirs) == 4000
    assert sorted(map(tuple, tracking.n11_recondition(spark, str(tmp_path)).select(*names.split(", ")).collect())) == theirs


@pytest.mark.parametrize("rule", [folds.RecentOcclusion(), folds.Reconditioning(every=5)], ids=["occlusion", "recondition"])
def test_stream_equals_table_across_a_restart(spark, rule):
    r = random.Random(6)
    rows = []
    for f in range(18):
        for s in range(3):
            objs = [o for o in range(4) if r.random() < 0.8]
            for o in objs:
                x = 10 * r.random()
                rows.append((s, f, o, r.random() < 0.3, r.random() < 0.1, [p for p in objs if r.random() < 0.5]) if isinstance(rule, folds.RecentOcclusion) else (s, f, o, x, 0.0, x + 8, 8.0, r.random(), r.random()))
    source, sink, check = (tempfile.mkdtemp(prefix="spark-", dir="/tmp") for _ in range(3))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    for frames in ((range(0, 5), range(5, 9)), (range(9, 18),)):
        for part in frames:
            spark.createDataFrame([x for x in rows if x[1] in part], rule.row).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rule.row).option("maxFilesPerTrigger", 1).parquet(source)
        q = folds.rule_stream(stream, rule).writeStream.format("parquet").option("path", sink).option("checkpointLocation", check).trigger(availableNow=True).start()
        q.awaitTermination(300)
        assert q.exception() is None
    table = sorted(map(tuple, folds.rule_table(spark.createDataFrame(rows, rule.row), rule).collect()))
    assert sorted(map(tuple, spark.read.parquet(sink).collect())) == table
    assert any(x[3] for x in table) and any(x[4] for x in table)


def test_nothing(spark):
    assert folds.rule_table(spark.createDataFrame([], folds.RecentOcclusion.row), folds.RecentOcclusion()).count() == 0
