"""Late updates as keyed state: several files, out of order, a restart in between, against the plain fold."""

import random

from pyspark.sql import functions as F

from folio.sources import store
from folio.streaming import latest
from tests.test_jobs import ROW, fold, random_input


def test_latest(spark, tmp_path):
    r = random.Random(11)
    inputs = [random_input(r, r.randrange(1, 9)) for _ in range(5)]
    at = lambda n: str(tmp_path / n)
    schema = ROW + ", n int"

    def put(numbers):
        for k in numbers:
            df = spark.createDataFrame([(*x, k) for x in inputs[k]], schema)
            df.coalesce(1).write.mode("append").parquet(at("in"))

    run = lambda: latest.ingest(spark, at("in"), schema, at("store"), at("check"), lambda d: d.withColumn("ord", F.format_string("%09d", "n")).drop("n"), buckets=8)
    put([0, 1])
    run()
    assert sorted(tuple(x) for x in store.rows(spark, at("store")).collect()) == fold(inputs[:2])
    writes = lambda: {p.name for p in (tmp_path / "store" / "data").iterdir()}
    before = writes()
    run()  # nothing new
    assert writes() == before
    put([2])
    put([3, 4])
    run()  # a new query goes on from the state of the last one
    assert sorted(tuple(x) for x in store.rows(spark, at("store")).collect()) == fold(inputs)


def test_latest_in_one_batch(spark, tmp_path):
    """Versions of one document in one file: folded in order, whatever the last one is."""
    rows = [("abstract", 1, "a", 1, 0, 1, "1"), ("abstract", 1, "b", 2, 0, 3, "2"), ("abstract", 1, "c", 3, 0, 2, "3"), ("abstract", 1, "b", 2, 0, 4, "4"), ("fulltext", 1, "f", 1, 5, -1, "1")]
    spark.createDataFrame(rows, latest.VERSION).coalesce(1).write.parquet(str(tmp_path / "in"))
    latest.ingest(spark, str(tmp_path / "in"), latest.VERSION, str(tmp_path / "s"), str(tmp_path / "c"), lambda d: d)
    assert sorted((r.kind, r.body, r.file_index) for r in store.rows(spark, str(tmp_path / "s")).collect()) == [("abstract", "b", 3), ("fulltext", "f", -1)]


def test_folded_side_by_side(spark, tmp_path):
    """Documents of a group share a value of state, and each is folded as if it were alone."""
    r = random.Random(5)
    rows = [("abstract", r.randrange(3000), f"{k}", r.randrange(3), 0, r.randrange(4), f"{k:06d}") for k in range(9000)]
    for part in (rows[:5000], rows[5000:]):
        spark.createDataFrame(part, latest.VERSION).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        latest.ingest(spark, str(tmp_path / "in"), latest.VERSION, str(tmp_path / "s"), str(tmp_path / "c"), lambda d: d, buckets=4)
    want = {}
    for x in rows:
        h, t = x[3], x[5]
        if x[1] not in want or not (t < want[x[1]][1] and h != want[x[1]][0] or t > want[x[1]][1] and h == want[x[1]][0]):
            want[x[1]] = (h, t, x[2])
    assert {x.pmid: (x.hash, x.file_index, x.body) for x in store.rows(spark, str(tmp_path / "s")).collect()} == want and len(want) > 2500
    values = spark.read.format("statestore").option("stateVarName", "stand").load(str(tmp_path / "c")).count()
    assert 0 < values <= latest.GROUPS < len(want)
