"""Plan inspection helpers (what ``df.explain`` prints, as a string)."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF", "MapInArrow")


def plan_string(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def python_nodes(df: DataFrame) -> list[str]:
    """Python execution nodes in the physical plan (should be none)."""
    text = plan_string(df, "extended")
    return [n for n in PYTHON_NODES if n in text]
