"""Overwrites in one step."""

import json

import pytest
from pyspark.sql import functions as F

from lakeweave.sinks.ledger import create_new
from lakeweave.sinks.versions import Versioned


@pytest.fixture
def sink(spark, tmp_path):
    return Versioned(spark, str(tmp_path / "sink"))


def test_a_failed_overwrite_leaves_what_was_there(spark, sink, rows):
    with pytest.raises(ValueError, match="no version"):
        sink.read()
    assert sink.replace(spark.range(3)) == 0
    broken = spark.range(9).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="no"):
        sink.replace(broken)
    assert rows(sink.read()) == [(0,), (1,), (2,)] and len(sink.history()) == 1
    assert sink.sweep() == 1 and rows(sink.read()) == [(0,), (1,), (2,)]


def test_a_job_may_read_what_it_replaces(spark, sink, rows):
    sink.replace(spark.range(4).selectExpr("id", "id % 2 AS part"), ["part"])
    before = sink.read()
    assert sink.replace(before.selectExpr("part", "cast(id + 10 AS string) AS id"), ["part"]) == 1
    assert rows(before, "id", "part") == [(0, 0), (1, 1), (2, 0), (3, 1)]
    assert rows(sink.read(), "id", "part") == [("10", 0), ("11", 1), ("12", 0), ("13", 1)]
    assert rows(sink.read(0), "id") == [(0,), (1,), (2,), (3,)]
    sink.replace(sink.read().limit(0))
    assert sink.read().collect() == [] and sink.read().columns == ["id", "part"]
    assert sink.sweep(keep=1) == 2 and [v.number for v in sink.history()] == [2]


def test_overwrites_side_by_side_get_a_number_each(spark, sink, rows, monkeypatch):
    sink.replace(spark.range(1))
    other, inner = Versioned(spark, sink.path), sink.history

    def overtaken():
        found = inner()
        monkeypatch.setattr(sink, "history", inner)
        other.replace(spark.range(5, 6))
        return found

    monkeypatch.setattr(sink, "history", overtaken)
    assert sink.replace(spark.range(7, 8)) == 2
    assert rows(sink.read()) == [(7,)] and rows(sink.read(1)) == [(5,)]
    assert not create_new(spark, f"{sink.list}/{2:020d}.json", json.dumps({}))
