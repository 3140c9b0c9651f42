from datetime import UTC, date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewell import cli
from tidewell.sources import bronze


def test_list_names_every_query(capsys):
    assert cli.main(["list"]) == 0
    assert "p4_found" in capsys.readouterr().out


def test_selection_rules():
    import argparse

    p = argparse.ArgumentParser()
    cli.add_selection(p)
    read = lambda *a: cli.selection(p, p.parse_args(a))
    assert read("--ingested-date", "2025-01-02") == cli.Selection("daily", "2025-01-02")
    for bad in ([], ["--source-mode", "historical", "--ingested-date", "2025-01-02"], ["--ingested-date", "2025-1-2"]):
        with pytest.raises(SystemExit):
            read(*bad)
    with pytest.raises(ValueError):
        cli.window("2025-01-01", "2025-03-01", 35)


def test_history_writers(spark, tmp_path):
    df = spark.createDataFrame([(0, 2, date(2025, 1, 1)), (0, 1, date(2025, 1, 1)), (1, 5, date(2025, 1, 2))], "kafka_partition int, kafka_offset int, ingest_date date")
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    assert not bronze.write_history(df, a, 2) and bronze.write_history(df, a, 2, execute=True)
    with pytest.raises(FileExistsError):
        bronze.write_history(df, a, 2)
    bronze.write_days(df, b)
    assert spark.read.parquet(b).filter("ingest_date = '2025-01-01'").count() == 2
    with pytest.raises(Exception, match="null ingest_date"):
        bronze.write_days(df.withColumn("ingest_date", F.lit(None).cast("date")), str(tmp_path / "c"))


def test_partition_time_falls_back(spark):
    t = datetime(2025, 1, 1, tzinfo=UTC)
    df = spark.createDataFrame([(t, t, t), (None, t, t), (None, None, t)], "f timestamp, kafka_timestamp timestamp, ingested_at timestamp")
    assert rows(df.select(bronze.safe_partition_time("f")[1].alias("s"))) == [("field",), ("ingested",), ("kafka",)]
