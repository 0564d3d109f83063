import subprocess
import sys

import __spark_entry__ as entry


def test_sql_only_for_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {f"p{n}_found" for n in range(1, 7)} <= set(entry.queries())


def test_core_stands_without_text_operators():
    code = "import sys, __spark_entry__ as e; [__import__(f'tidemark.plans.{x}') for x in e.CORE]; print(any(m.startswith('tidemark.llm') for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.strip() == "False"


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
