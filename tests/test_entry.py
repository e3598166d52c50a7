"""The entry module works with and without the training-data subpackage."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(before=""):
    code = f"import sys\n{before}\nimport __spark_entry__ as e\nprint(len(e.queries()), len(e.oracle_sql()), sum(n.startswith('op') for n in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True, timeout=120)
    return [int(x) for x in out.stdout.split()]


def test_other_queries_are_there_without_the_subpackage():
    queries, oracle, operators = names("sys.modules['tidemark.llm'] = None")
    assert queries >= 70 and oracle >= 70 and operators == 0


def test_other_import_errors_are_not_swallowed():
    code = "import sys\nsys.modules['tidemark.plans.catalog'] = None\nimport __spark_entry__"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, timeout=120).returncode
