"""The driver contract where optional parts are missing."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; print(len(e.queries()), sum(n[:2] == 'op' and n[2].isdigit() for n in e.queries()))"


@pytest.mark.parametrize("missing", ["public_tokenizers", "promptmill.llm", "corpus_pipeline"])
def test_other_queries_stay(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; {COUNT}"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    total, optional = map(int, out.stdout.split()[-2:])
    assert total >= 150
    if missing != "corpus_pipeline":
        assert optional == 0
