"""Letters' case: no tables of all letters are built while a driver plans, and letters beyond ASCII still change."""

import subprocess
import sys
from pathlib import Path

from tillflow.session import tuned

# in a process of its own, since the tables are built once in a process
PLANNED = """
from pyspark.sql import functions as F
from tillflow.session import build_session, tuned
session = tuned(build_session("case-tables", "local[1]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}))
jvm = session.sparkContext._jvm.java.lang
session.range(1).select(F.concat(F.lit("a"), "id")).collect()
bean, thread = jvm.management.ManagementFactory.getThreadMXBean(), jvm.Thread.currentThread().getId()
before = bean.getThreadAllocatedBytes(thread)
assert session.range(1).select(F.lower(F.lit("HKD")).alias("c")).collect()[0].c == "hkd"
print("allocated", bean.getThreadAllocatedBytes(thread) - before)
"""


def test_a_constant_in_lower_case_costs_the_driver_little():
    run = subprocess.run([sys.executable, "-c", PLANNED], cwd=Path(__file__).parent.parent, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr[-2000:]
    assert int(run.stdout.split("allocated")[1]) < 200 << 20


def test_letters_beyond_ascii_change_their_case(spark):
    rows = tuned(spark).createDataFrame([("ÄÖÜ SGD", "äöü sgd"), ("ΟΔΟΣ", "οδος"), ("Straße", None), (None, None)], "a string, b string")
    assert [tuple(r) for r in rows.selectExpr("lower(a)", "upper(b)", "upper(a)").collect()] == [
        ("äöü sgd", "ÄÖÜ SGD", "ÄÖÜ SGD"), ("οδος", "ΟΔΟΣ", "ΟΔΟΣ"), ("straße", None, "STRASSE"), (None, None, None)]
