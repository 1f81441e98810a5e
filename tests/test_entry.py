"""The driver contract in __spark_entry__.py."""

import os
import re
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import DataFrame

import __spark_entry__ as entry_module
from tests.conftest import SF_SMALL


def is_llm(name):
    """Queries of the optional text operators; their tests are in tests/llm."""
    return name == "pipeline" or re.match(r"op\d+_", name) is not None


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert isinstance(df, DataFrame)
    assert df.columns == ["country", "country_name", "AQI_improvement"]
    assert df.count() > 0
    assert entry_module.entry(spark).schema == df.schema


def test_oracles_belong_to_queries():
    q, o = entry_module.queries(), entry_module.oracle_sql()
    assert set(o) <= set(q)
    assert all(isinstance(v, str) and v.strip() for v in o.values())
    assert {k for k in q if k not in o and not is_llm(k)} == \
        {k for k in q if k.startswith("kmeans_") and not k.endswith("check")}


@pytest.mark.parametrize("name", sorted(k for k in entry_module.queries() if not k.startswith("kmeans_") and not is_llm(k)))
def test_every_query_runs(spark, name):
    df = entry_module.queries()[name](spark, SF_SMALL)
    assert isinstance(df, DataFrame)
    df.limit(1).collect()


@pytest.mark.parametrize("left", [None, "airlens/llm/__pycache__"])
def test_entry_without_the_text_operators(tmp_path, left):
    """Also where only the folder of the text operators is left, without its files."""
    root = os.path.dirname(os.path.abspath(entry_module.__file__))
    shutil.copytree(f"{root}/airlens", tmp_path / "airlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    if left:
        (tmp_path / left).mkdir(parents=True)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"],
                          cwd=tmp_path, env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True, check=True)
    found, sql = (line.split() for line in said.stdout.splitlines())
    assert set(sql) <= set(found)
    assert found == [k for k in entry_module.queries() if not is_llm(k)]
