"""The entry module without the optional text subpackage or its packages."""

import subprocess
import sys

import pytest

CODE = """
import sys
sys.path.insert(0, {root!r})
sys.modules[{missing!r}] = None          # import raises ModuleNotFoundError
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
assert len(q) >= 124 and set(o) <= set(q) and "pipeline" not in q, len(q)
"""


@pytest.mark.parametrize("missing", ["tiktoken", "xxhash", "tilth.llm", "corpus_pipeline"])
def test_other_keys_stay(missing):
    import os
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", CODE.format(root=root, missing=missing)], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
