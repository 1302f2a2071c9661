"""Plan inspection: the checks we run on every operator's physical plan."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "AggregateInPandas",
                "MapInPandas", "MapInArrow", "PythonMapInArrow")


def physical_plan(df: DataFrame, mode: str = "simple") -> str:
    """The physical plan as ``df.explain(mode)`` prints it (AQE's final plan once the
    query has run, its initial plan before)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def shuffles(df: DataFrame) -> int:
    """Number of shuffle exchanges in the physical plan."""
    p = physical_plan(df)
    return sum(p.count(f"Exchange {kind}") for kind in
               ("hashpartitioning", "rangepartitioning", "RoundRobinPartitioning", "SinglePartition"))


def python_nodes(df: DataFrame) -> list[str]:
    """Python-evaluated operators present in the plan (empty = everything runs in the JVM)."""
    p = physical_plan(df)
    return [n for n in PYTHON_NODES if n in p]


def summary(df: DataFrame) -> dict:
    """Shuffles, broadcasts, pushed filters and Python nodes in one dict."""
    p = physical_plan(df)
    return {"shuffles": shuffles(df), "broadcasts": p.count("BroadcastExchange"),
            "pushed_filters": "PushedFilters: [" in p and "PushedFilters: []" not in p,
            "single_partition": "SinglePartition" in p, "python": python_nodes(df),
            "top_k": "TakeOrderedAndProject" in p}
