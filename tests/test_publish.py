"""The three array files that the dashboard fetches."""
import datetime as dt
import decimal
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from weekwise.config import FIXTURE
from weekwise.plans.retention import Base
from weekwise.sources import publish
from weekwise.sources.files import Folder
from weekwise.sources.fixture import fixture_tables
from weekwise.sources.publish import Publication, publish_reports, recover, reports
from weekwise.sources.sinks import read_report_json

NAMES = ["data_raw.json", "data_raw_click.json", "task_group_click.json"]


@pytest.fixture(scope="module")
def base(spark):
    b = Base(fixture_tables(spark, SF_SMALL), FIXTURE).persist("cache")
    yield b
    b.unpersist()


def plain(v):
    return float(v) if isinstance(v, decimal.Decimal) else v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else v


def seen(folder):
    return {n: open(folder / n).read() for n in NAMES}


def test_files_hold_the_reports(spark, base, tmp_path):
    counts = publish_reports(base, str(tmp_path))
    assert sorted(counts) == NAMES
    for name, build in reports().items():
        expected = [{k: plain(v) for k, v in r.asDict().items()} for r in build(base).collect()]
        found = json.load(open(tmp_path / name))
        assert found == expected and counts[name] == len(expected) > 0      # in their order, with their nulls
        again = read_report_json(spark, str(tmp_path / name), build(base).schema, multi_line=True)
        assert again.collect() == build(base).collect()
    assert [n for n in os.listdir(tmp_path) if n.startswith("_")] == []


def small(text):
    return lambda base: base.t.report_business.sparkSession.createDataFrame([(text, None)], "a string, b long")


def test_a_failing_report_leaves_the_old_three(base, tmp_path):
    publish_reports(base, str(tmp_path), {n: small("old") for n in NAMES})
    before = seen(tmp_path)

    def broken(b):
        return small("x")(b).select(F.raise_error(F.lit("third report")).alias("a"))
    with pytest.raises(Exception, match="third report"):
        publish_reports(base, str(tmp_path), {NAMES[0]: small("new"), NAMES[1]: small("new"), NAMES[2]: broken})
    assert seen(tmp_path) == before
    assert json.loads(before[NAMES[0]]) == [{"a": "old", "b": None}]
    assert [n for n in os.listdir(tmp_path) if n.startswith("_")] == []


def test_a_publication_cut_off_between_moves_is_ended(spark, base, tmp_path, monkeypatch):
    publish_reports(base, str(tmp_path), {n: small("old") for n in NAMES})
    moves = []
    real = Folder.replace

    def lost(self, source, target):
        if target in NAMES:
            moves.append(target)
            if len(moves) == 2:
                raise KeyboardInterrupt
        real(self, source, target)
    monkeypatch.setattr(Folder, "replace", lost)
    with pytest.raises(KeyboardInterrupt):
        publish_reports(base, str(tmp_path), {n: small("new") for n in NAMES})
    monkeypatch.undo()
    assert {json.loads(x)[0]["a"] for x in seen(tmp_path).values()} == {"old", "new"}
    recover(Folder(spark, str(tmp_path)))
    assert {json.loads(x)[0]["a"] for x in seen(tmp_path).values()} == {"new"}


def test_a_lost_driver_before_the_mark_leaves_the_old_three(spark, base, tmp_path):
    publish_reports(base, str(tmp_path), {n: small("old") for n in NAMES})
    before = seen(tmp_path)
    abandoned = Publication(spark, str(tmp_path))
    abandoned.stage(small("new")(base), NAMES[0])
    recover(Folder(spark, str(tmp_path)))
    assert seen(tmp_path) == before
    assert abandoned.stage_name in os.listdir(tmp_path)       # it may still be at work
    os.utime(tmp_path / abandoned.stage_name, (0, 0))
    recover(Folder(spark, str(tmp_path)))
    assert abandoned.stage_name not in os.listdir(tmp_path)


def test_empty_report(spark, base, tmp_path):
    none = spark.createDataFrame([], "a string")
    assert publish_reports(base, str(tmp_path), {NAMES[0]: lambda b: none}) == {NAMES[0]: 0}
    assert json.load(open(tmp_path / NAMES[0])) == []
    assert publish.array_json(none).collect()[0].value == "[]"
