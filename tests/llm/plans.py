"""What ran, as Spark's plans say."""

import re


def python_nodes(df) -> list[str]:
    return re.findall(r"\w*(?:Python|Pandas|Arrow)\w*", df._jdf.queryExecution().executedPlan().toString())


def cross_joins(df) -> list[str]:
    return re.findall(r"CartesianProduct|BroadcastNestedLoopJoin", df._jdf.queryExecution().executedPlan().toString())
