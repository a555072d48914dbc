"""Custom steps between pipeline steps: SQL text or functions, run in order."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Step = str | Callable[[dict[str, DataFrame]], DataFrame]


def run_steps(spark: SparkSession, inputs: dict[str, DataFrame], steps: list[tuple[str, Step]]) -> DataFrame:
    """Run named steps; each sees the inputs and the earlier steps by name. Gives the last result.

    A SQL step writes its inputs in braces, ``SELECT * FROM {orders}``.
    """
    known = dict(inputs)
    result = None
    for name, step in steps:
        if name in known:
            raise ValueError(f"step name {name} is taken")
        result = spark.sql(step, **_used(step, known)) if isinstance(step, str) else step(known)
        known[name] = result
    if result is None:
        raise ValueError("no steps given")
    return result


def _used(text: str, known: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: df for name, df in known.items() if "{" + name + "}" in text}


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"
