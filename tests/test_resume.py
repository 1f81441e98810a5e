"""A job that failed goes on from its finished tables, with equal results."""

import os

import pytest

from airlens.plans import job
from airlens.sources import sinks
from tests.test_job import write_table


def tables_of(spark, written):
    return {name: sorted(map(repr, spark.read.parquet(path).collect())) for name, path in written.items()}


def stamps(out):
    return {name: sorted((f, os.stat(os.path.join(d, f)).st_mtime_ns) for d, _, names in os.walk(f"{out}/{name}") for f in names)
            for name in os.listdir(out) if not name.startswith("_")}


@pytest.fixture()
def source(tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    write_table(src)
    return str(src)


def test_goes_on_after_a_failure(spark, source, tmp_path, monkeypatch):
    opts = dict(readings=source, k=3, maps=False, concurrency=1)
    want = tables_of(spark, job.run(spark, job.JobOptions(out=str(tmp_path / "whole"), **opts)))
    out, write = str(tmp_path / "out"), sinks.write_table

    def fails(df, path, *a):
        if path.endswith("/region_improvement"):      # after the fit
            raise OSError("lost")
        write(df, path, *a)

    monkeypatch.setattr(sinks, "write_table", fails)
    with pytest.raises(OSError):
        job.run(spark, job.JobOptions(out=out, resume=True, **opts))
    monkeypatch.undo()
    before, later = stamps(out), []
    monkeypatch.setattr(sinks, "write_table", lambda df, path, *a: later.append(path.rsplit("/", 1)[-1]) or write(df, path, *a))
    monkeypatch.setattr(sinks, "write_curated", lambda *a, **k: pytest.fail("the readings and regions are there"))
    written = job.run(spark, job.JobOptions(out=out, resume=True, **opts))
    assert "region_improvement" in later and not set(later) & {"centroids", "region_fit", "country_improvement", "profile"}
    after = stamps(out)
    assert all(after[name] == files for name, files in before.items())
    assert tables_of(spark, written) == want
    later.clear()
    job.run(spark, job.JobOptions(out=out, resume=True, **opts))
    assert later == []


def test_other_options_or_files_start_afresh(spark, source, tmp_path):
    o = job.JobOptions(out=str(tmp_path / "out"), readings=source, resume=True)
    key = job._key(spark, o)
    assert job._key(spark, job.JobOptions(out="elsewhere", readings=source, concurrency=2)) == key
    assert job._key(spark, job.JobOptions(out=o.out, readings=source, k=7)) != key
    with open(f"{source}/sensors_20240502.json", "a") as fh:
        fh.write("\n{}")
    assert job._key(spark, o) != key
