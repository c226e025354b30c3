"""Write PLANS.md: what every registered query runs, writes included.

Each query is built and run into the ``noop`` sink with Spark's event log on
(in a scratch folder). The table counts, over the final plans of all its SQL
executions (a query that writes files or runs a stream has several), the
shuffles, broadcasts, aggregates, joins, sorts, Python steps and file writes.
Usage: ``python tools/plan_report.py [sf_dir]``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KINDS = {
    "shuffles": r"Exchange$|Exchange ",
    "broadcasts": r"BroadcastExchange",
    "hash aggregates": r"HashAggregate|ObjectHashAggregate",
    "sort aggregates": r"SortAggregate",
    "joins": r"Join",
    "sorts": r"Sort$",
    "Python steps": r"MapInArrow|PythonMapInArrow|Python",
    "writes": r"InsertIntoHadoopFsRelationCommand|WriteToDataSource",
}


def nodes(info: dict):
    yield info["nodeName"].split(" (")[0], info["simpleString"]
    for child in info["children"]:
        yield from nodes(child)


def executions(path: str, begin: int) -> tuple[dict[int, dict], int]:
    """Last plan of each SQL execution in the event log after a byte offset."""
    plans = {}
    with open(path, "rb") as f:
        f.seek(begin)
        for line in f:
            if b"sparkPlanInfo" in line and line.endswith(b"\n"):
                e = json.loads(line)
                plans[e["executionId"]] = e["sparkPlanInfo"]
        return plans, f.tell()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import SparkSession

    from pricelens.plans.queries import all_queries
    from pricelens.session import ensure_checkpoint_dir

    log = tempfile.mkdtemp(prefix="pricelens-events-")
    conf = {
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.sql.session.timeZone": "UTC",
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log}", "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false", "spark.eventLog.buffer.kb": "1k",
    }
    spark = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    lines = [
        "# Plans of the registered queries",
        "",
        f"Generated by `tools/plan_report.py` on `{sf_dir}` from Spark's event log: the final (adaptive) plans of all SQL",
        "executions of a query, its writes, micro-batches and read-back included. The shuffle that deals the driver's",
        "single-file tables out before text or pages are built from them is among each query's shuffles, and small sides",
        "that AQE broadcast at run time are among the broadcasts.",
        "",
        "| Query | Executions | " + " | ".join(KINDS) + " |",
        "| --- " * (len(KINDS) + 2) + "|",
    ]
    at = 0
    for name, fn in all_queries().items():
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        plans, at = executions(os.path.join(log, os.listdir(log)[0]), at)
        got: Counter = Counter()
        for info in plans.values():
            for node, text in nodes(info):
                for kind, pattern in KINDS.items():
                    hit = re.search(pattern, node) or kind == "writes" and node.startswith("Execute") and re.search(pattern, node + text)
                    got[kind] += bool(hit) and not (kind == "shuffles" and "Broadcast" in node)
        lines.append(f"| `{name}` | {len(plans)} | " + " | ".join(str(got[k]) for k in KINDS) + " |")
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    print("\n".join(lines))


if __name__ == "__main__":
    main()
