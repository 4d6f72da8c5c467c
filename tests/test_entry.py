"""The driver's entry works with and without the corpus operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
BLOCK = """
import sys
for name in {missing!r}:
    sys.modules[name] = None
import __spark_entry__ as entry
print(len(entry.queries()), set(entry.oracle_sql()) <= set(entry.queries()), 'monthly_revenue' in entry.queries())
"""


def run(missing):
    return subprocess.run([sys.executable, "-c", BLOCK.format(missing=missing)], cwd=ROOT, capture_output=True, text=True)


def test_queries_without_the_corpus_operators():
    out = run(["corpus_pipeline", "tillroll.llm"]).stdout.split()
    assert out[1:] == ["True", "True"] and int(out[0]) >= 39


def test_another_missing_module_is_an_error():
    done = run(["harness.oracles"])
    assert done.returncode and "harness.oracles" in done.stderr
