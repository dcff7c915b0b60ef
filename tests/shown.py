"""Where the tests' tables lie, and plans as text."""

from __future__ import annotations

SF_DIR = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
