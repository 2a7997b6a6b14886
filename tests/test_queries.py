"""Every query against its SQL, and the entry module without the optional subpackage."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

from fathom.queries import every
from tests.conftest import DATA, ROOT, oracle_rows, rows_of

SF = f"{DATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(every.ORACLE_SQL))
def test_query_matches_its_sql(spark, duck, name):
    assert rows_of(every.QUERIES[name](spark, SF)) == oracle_rows(duck, every.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(every.QUERIES) - set(every.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    df = every.QUERIES[name](spark, SF)
    assert df.columns
    df.collect()


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 6
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "spark-warehouse", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'metric_revenue_by_flag' in q and not any(n.startswith('op') for n in q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr


def test_an_import_error_inside_the_subpackage_leaves_the_others(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "spark-warehouse", "__pycache__"))
    (copy / "fathom/llm").mkdir()
    (copy / "fathom/llm/__init__.py").touch()
    (copy / "fathom/llm/registry.py").write_text("import no_such_module\n")
    code = "import __spark_entry__ as e; q = e.queries(); assert 'metric_revenue_by_flag' in q and not any(n.startswith('op') for n in q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy,
                          env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True, check=False)
    assert done.returncode == 0 and "no_such_module" in done.stderr, done.stderr


def test_nothing_else_imports_the_subpackage():
    for folder, _, names in os.walk(f"{ROOT}/fathom"):
        if "/llm" in folder:
            continue
        for name in names:
            if name.endswith(".py"):
                with open(f"{folder}/{name}") as f:
                    assert "fathom.llm" not in f.read()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(every.QUERIES) - {"stream_window_counts"}))
def test_no_query_forms_a_product(spark, name):
    plan = plan_of(every.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_scans_read_what_a_query_needs(spark):
    plan = every.QUERIES["metric_revenue_by_flag"](spark, SF)._jdf.queryExecution().toString()
    schema = plan[plan.rindex("ReadSchema:"):].split("\n")[0]
    assert "l_extendedprice" in schema and "l_shipdate" not in schema and "l_orderkey" not in schema
    filtered = plan_of(every.QUERIES["majority_vote"](spark, SF))
    assert "PushedFilters: [IsNotNull(value), GreaterThanOrEqual(value,20.0)" in filtered


def test_unrolled_characters_are_merged(spark):
    """A small file's characters are many: no side of their join is broadcast."""
    assert "Broadcast" not in plan_of(every.QUERIES["characters_by_hint"](spark, SF))


def test_proven_tables_merge_their_characters(spark):
    """Characters meet cells, and then their places, by merge; only tables' numbers may be broadcast."""
    plan = plan_of(every.QUERIES["proven_table_hints"](spark, SF))
    broadcast = [line for line in plan.split("\n") if "BroadcastHashJoin" in line]
    assert not any(word in line for line in broadcast for word in ("ordinal", "_band", "cell")), broadcast
    assert plan.count("SortMergeJoin") >= 3


def test_boxes_without_overlap_are_found_by_merge(spark):
    assert "Broadcast" not in plan_of(every.QUERIES["without_overlap"](spark, SF))


@pytest.mark.parametrize("name", ["row_groups", "interval_merge"])
def test_equal_rows_are_sorted_once(spark, name):
    """What opens a group and what numbers it must see equal rows in one order."""
    assert plan_of(every.QUERIES[name](spark, SF)).count("Sort [") == 1
