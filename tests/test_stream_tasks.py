import json

from checks.applying import fields_into, fold_users
from tidefold.sinks.bucket_table import BucketTable
from tidefold.streaming import apply


def records(spark, upto):
    rows = [("t", 0, o, o * 1000, str(o % 7), f'{{"_id":{o % 7},"a":"{o}"}}') for o in range(upto)]
    log = spark.createDataFrame(rows, "topic string, partition int, offset long, ms long, id string, after string").coalesce(1)
    return log.selectExpr(
        "topic", "partition", "offset", "timestamp_millis(ms) AS timestamp", "'CREATE_TIME' AS timestamp_type",
        "named_struct('id', id) AS key", "named_struct('op', 'c', 'after', after, 'patch', CAST(null AS string)) AS value")


def test_one_large_split_is_folded_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(apply, "DEALT_ROWS", 10, raising=False)
    table, tasks = BucketTable(spark, str(tmp_path / "users"), ("k",), 2), []

    def fold(log):
        tasks.append(log.rdd.getNumPartitions())
        return fold_users(log)

    for batch, upto in enumerate((100, 100, 105)):  # the second brings nothing new, the third five records
        apply.apply_batch(table, records(spark, upto), fold, fields_into, batch)
    got = sorted(json.loads(r["doc"])["a"].strip('"') for r in table.read().collect())
    assert tasks[0] == 10 and tasks[2] < 10
    assert got == sorted(str(o) for o in range(98, 105))
