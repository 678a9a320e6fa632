"""The entry module without the optional corpus part."""

import json
import os
import subprocess
import sys

import pytest

from skyfold.plans.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = """
import json, sys
for name in sys.argv[1:]:
    sys.modules[name] = None        # importing it fails
import __spark_entry__ as e
print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))
"""


@pytest.mark.parametrize("missing", [["skyfold.llm"], ["xxhash"], ["corpus_pipeline"], ["skyfold.llm", "corpus_pipeline"]])
def test_other_queries_stay_when_a_part_cannot_be_imported(missing):
    out = subprocess.run([sys.executable, "-c", COUNT, *missing], capture_output=True, text=True, cwd=ROOT, timeout=120)
    assert out.returncode == 0, out.stderr
    queries, oracles = json.loads(out.stdout.splitlines()[-1])
    assert set(QUERIES) <= set(queries) and set(QUERIES) <= set(oracles)
    assert "pipeline" not in queries
