"""Plan properties every registered query must keep at any scale."""

import re

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin"]
# columns of the driver tables the fixture needs; anything else read is waste
LINEITEM_NEEDED = {"l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus"}


def check_plan(name: str, df) -> None:
    """Call after the DataFrame has run (the adaptive plan is then final)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"
    for schema in re.findall(r"lineitem\.parquet\].*?ReadSchema: struct<([^>]*)>", plan):
        cols = {c.split(":")[0] for c in schema.split(",")}
        assert cols <= LINEITEM_NEEDED, f"{name}: lineitem scan reads {cols - LINEITEM_NEEDED}"
