"""The entry points with and without the optional part."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'timeless_scores' in e.queries())"


@pytest.mark.parametrize("blocked", ["tiktoken", "tokenizers", "sentencepiece", "xxhash", "perennial.llm", "corpus_pipeline"])
def test_entry_without_a_library(blocked):
    """None in sys.modules makes an import fail as if the module were not there."""
    code = f"import sys; sys.modules[{blocked!r}] = None; sys.path.insert(0, {ROOT!r}); {COUNT}"
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    from perennial.plans import oracle
    from perennial.plans.queries import QUERIES

    n, with_sql, scores = out.stdout.split()[-3:]
    assert scores == "True" and int(n) >= len(QUERIES) and int(with_sql) >= len(oracle.oracle_sql())
