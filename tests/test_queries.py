"""Every registered query runs; those with SQL equal it on the smallest tables."""

import ast
import pathlib

import pytest

from skerry.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, sf_dir, same):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLE:
        same(df, ORACLE[name])
    else:
        assert df.count() >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())


def test_nothing_else_imports_llm():
    root = pathlib.Path(__file__).parent.parent / "skerry"
    for path in root.rglob("*.py"):
        if "llm" in path.relative_to(root).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), path


def test_filters_reach_the_scan(spark, sf_dir):
    """Column pruning and pushed filters of a filtered ranking."""
    from skerry.queries.base import Loader
    from skerry.operators import filters

    d = Loader(spark, sf_dir)("events").filter("event_type = 'view'").select("event_id")
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in plan
    assert "value" not in plan.split("ReadSchema")[1]
    assert filters.SearchFilters().active is False
