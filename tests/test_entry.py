"""The driver contract without the training-data operators."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name == {hidden!r}:
            raise ImportError(name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
assert not any(n.startswith("op") or n == "pipeline" for n in entry.queries()), "operators without their library"
assert "shop_comparison" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())
"""


@pytest.mark.parametrize("hidden", ["zstandard", "soldscope.llm", "corpus_pipeline"])
def test_other_queries_stay_where_a_module_is_missing(hidden):
    done = subprocess.run([sys.executable, "-c", HIDE.format(hidden=hidden)], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
