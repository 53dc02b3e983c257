"""Plan inspection: the physical plan as text and the checks the tests apply."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Operators that must never appear: a cartesian product (pairs within a group)
# and Python row/batch evaluation (the slow path).
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


def executed_plan_text(df: DataFrame) -> str:
    """The final (post-AQE) plan after the query ran once (test helper; the
    rows are counted on the executors, nothing is collected)."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString()


def forbidden_operators(df: DataFrame) -> list[str]:
    text = plan_text(df)
    return [op for op in FORBIDDEN if op in text]


def main(argv: list[str]) -> int:
    """``python -m scholarmetrics.plans.inspect <sf_dir> <query>...``: print the
    formatted physical plan of registered queries."""
    import os
    import sys

    from pyspark.sql import SparkSession

    sys.path.insert(0, os.getcwd())
    from scholarmetrics.plans.catalog import QUERIES

    if len(argv) < 3:
        print("usage: python -m scholarmetrics.plans.inspect <sf_dir> <query>...")
        print("queries:", " ".join(sorted(QUERIES)))
        return 2
    spark = (
        SparkSession.builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    for name in argv[2:]:
        print(f"==== {name}")
        print(plan_text(QUERIES[name](spark, argv[1])))
    return 0


if __name__ == "__main__":
    import sys

    raise SystemExit(main(sys.argv))
