"""Bad lines keep their text, file and reason; the rest is what the ingest extracts."""

import json

import pytest
from pyspark.sql import functions as F

from airlens.operators.extract import extract_readings
from airlens.plans import job
from airlens.sources import rejects
from airlens.sources.json_readings import InputError, read_readings


def line(rid, ts="2024-01-01 07:00:00", values=(("P1", "22.5"), ("P2", "14.1")), lat="48.5", lon="2.5", country="FR"):
    return json.dumps({"id": rid, "timestamp": ts, "location": {"latitude": lat, "longitude": lon, "country": country},
                       "sensor": {"id": rid}, "sensordatavalues": [{"value_type": k, "value": v} for k, v in values]})


GOOD = [line(1), line(2, values=(("P1", "-5"), ("P2", "1e9")))]
BAD = {"{not json": "malformed", "[1, 2]": "malformed", '"text"': "malformed", '{"id": 3': "malformed",
       line(4, values=(("P2", "1"), ("P1", "2"))): "measures", line(5, values=()): "measures", "{}": "measures",
       line(6, values=(("P1", "n/a"), ("P2", "1"))): "number", line(7, values=(("P1", None), ("P2", "1"))): "number",
       line(8, ts="yesterday"): "timestamp", line(9, ts=None): "timestamp",
       line(10, lat="north"): "place", line(11, country=None): "place"}


@pytest.fixture()
def folder(tmp_path):
    lines = list(BAD)
    (tmp_path / "sensors_20240101.json").write_text("\n".join([GOOD[0], *lines[:6], "", "   ", GOOD[1]]) + "\n")
    (tmp_path / "sensors_20240102.json").write_text("\n".join(lines[6:]))
    (tmp_path / "codes.json").write_text("[\nnot a reading\n]")
    return str(tmp_path)


def test_every_bad_line_has_its_reason_and_file(spark, folder):
    checked = rejects.checked_lines(rejects.read_lines(spark, folder))
    got = {r.line: (r.reason, r.file.rsplit("/", 1)[-1]) for r in rejects.rejected(checked).collect()}
    want = {text: (reason, f"sensors_2024010{1 + (i >= 6)}.json") for i, (text, reason) in enumerate(BAD.items())}
    assert got == want
    assert sorted(r.line for r in checked.where("reason is null").collect()) == sorted(GOOD)


def test_readings_are_those_of_the_ingest(spark, folder):
    checked = rejects.checked_lines(rejects.read_lines(spark, folder))
    good = checked.where("reason is null").select("reading.*")
    usable = extract_readings(read_readings(spark, folder)).dropna(subset=["P1", "P2", "ts", "country", "latitude", "longitude"])
    assert good.columns == usable.columns and sorted(map(tuple, good.collect())) == sorted(map(tuple, usable.collect()))
    by_name = rejects.checked_lines(rejects.read_lines(spark, folder), match="name")
    assert by_name.where("reason is null").count() == 3          # P2 before P1 is fine then


def test_counts_per_file(spark, folder):
    counts = rejects.reject_counts(rejects.checked_lines(rejects.read_lines(spark, folder))).orderBy("file").collect()
    assert [(r.lines, r.malformed, r.measures, r.number, r["timestamp"], r.place) for r in counts] == [(8, 4, 2, 0, 0, 0), (7, 0, 1, 2, 2, 2)]


def test_threshold_and_missing_path(spark, folder, tmp_path):
    counts = rejects.reject_counts(rejects.checked_lines(rejects.read_lines(spark, folder)))
    rejects.check_share(counts, 0.9)
    with pytest.raises(InputError, match="13 of 15"):
        rejects.check_share(counts, 0.5)
    with pytest.raises(InputError):
        rejects.read_lines(spark, str(tmp_path / "nothing"))
    rejects.check_share(counts.where(F.lit(False)), 0.0)


def test_job_writes_rejects_before_it_fails(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(InputError, match="bad"):
        job.run(spark, job.JobOptions(out=out, readings=folder, k=2, maps=False, rejects=True, most_bad=0.1))
    assert spark.read.parquet(f"{out}/rejected_lines").count() == len(BAD)
    assert spark.read.parquet(f"{out}/reject_counts").agg(F.sum("lines")).first()[0] == len(BAD) + len(GOOD)
