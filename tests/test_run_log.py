"""Counts and digests that come with a run against counting its tables."""

import pytest
from pyspark.sql import functions as F

from thicket.plans import ingest, queries
from thicket.plans.run_log import RunLog, row_digest


def test_ingest_tells_what_it_read_and_wrote(spark, sf_dir, tmp_path):
    path = f"file://{tmp_path}/out"
    parsed, master = queries._parsed(spark, sf_dir), queries._master(spark, sf_dir)
    rows = {r.step: r for r in ingest.run(spark, parsed, master, path, skip=("answers",)).collect()}
    table = lambda name: spark.read.parquet(f"{path}/{name}")
    for step, made, read in (("records", table("records"), parsed.count()), ("essential", table("essential"), table("records").count()), ("chunks", table("chunks"), table("records").count()), ("vectors", table("vectors/chunks"), table("chunks").count() + table("essential").count()), ("keywords", table("keywords/docs"), table("chunks").count())):
        assert (rows[step].rows, rows[step].rows_read, rows[step].skipped, rows[step].error) == (made.count(), read, False, None), step
        assert rows[step].digest == made.agg(row_digest(made)).first()[0] and rows[step].seconds > 0
    assert rows["answers"].skipped and (rows["answers"].rows, rows["answers"].rows_read, rows["answers"].digest) == (0, 0, None)
    again = {r.step: r for r in ingest.run(spark, parsed.repartition(3), master, path).collect()}
    assert all(again[s].digest == rows[s].digest for s in ("records", "essential", "chunks", "keywords")) and again["answers"].rows > 0
    assert spark.read.json(f"{path}/runs").count() == 2 * len(ingest.STEPS)


def test_digest_of_rows(spark):
    digest = lambda df: df.agg(row_digest(df)).first()[0]
    df = spark.createDataFrame([(1, "a", {"k": 1}), (2, None, None), (2, None, None)], "x int, `a.b` string, m map<string,int>")
    assert digest(df) == digest(df.repartition(3)) == digest(df.orderBy(F.desc("x")))
    assert digest(df) != digest(df.limit(2)) and digest(df.limit(0)) is None


def test_a_failing_step_keeps_its_error(spark, tmp_path):
    log = RunLog(spark, k=3)
    with log.step("first"):
        log.write(log.read(spark.range(7)).filter("id > 2"), f"file://{tmp_path}/a")
    with pytest.raises(ZeroDivisionError):
        with log.step("second"):
            log.read(spark.range(3))
            raise ZeroDivisionError("no")
    first, second = sorted(log.frame().collect(), key=lambda r: r["at"])
    assert (first.rows, first.rows_read, first.error, first.settings) == (4, 7, None, '{"k": 3}')
    assert (second.rows, second.rows_read, second.error) == (0, 0, "ZeroDivisionError: no")
    log.save(f"file://{tmp_path}/log")
    assert spark.read.json(f"file://{tmp_path}/log").count() == 2
