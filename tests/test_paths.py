"""The JSON path and the table path give the same clean readings."""

import json

from airlens.plans import catalog, ingest
from airlens.sources import tables
from tests.conftest import SF_SMALL


def test_json_lines_round_trip_equals_tables(spark, tmp_path):
    nested = tables.nested_readings(spark, SF_SMALL)
    nested.write.partitionBy("date").json(str(tmp_path / "readings"))
    codes = [r.asDict() for r in tables.country_codes(spark, SF_SMALL).collect()]
    (tmp_path / "codes.json").write_text(json.dumps(codes))
    from_json = ingest.build_from_json(spark, str(tmp_path / "readings"), str(tmp_path / "codes.json"),
                                       glob="*.json")
    want = sorted(map(tuple, catalog.readings(spark, SF_SMALL).collect()), key=str)
    got = sorted(map(tuple, from_json.collect()), key=str)
    assert got == want
