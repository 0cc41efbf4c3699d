import subprocess
import sys
from pathlib import Path

import pytest

CODE = """
import sys
sys.modules[{blocked!r}] = None
import __spark_entry__ as e
print(len(e.queries()) == len(e.QUERIES) > 100, set(e.oracle_sql()) <= set(e.queries()))
"""


@pytest.mark.parametrize("blocked", ["corpus_pipeline", "tiktoken"])
def test_listing_queries_register_where_a_dependency_is_missing(blocked):
    run = [sys.executable, "-c", CODE.format(blocked=blocked)]
    found = subprocess.run(run, cwd=Path(__file__).resolve().parent.parent, capture_output=True, text=True, check=True)
    assert found.stdout.split() == ["True", "True"]
