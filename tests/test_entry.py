"""The driver's contract where packages are missing."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_a_missing_package_of_the_text_operators_costs_their_queries_only():
    hidden = "import sys; sys.modules['public_tokenizers'] = None; sys.modules['xxhash'] = None; import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert 'hero_winrate' in q and set(o) <= set(q); print('llm', any(n.startswith('op') for n in q))"
    found = subprocess.run([sys.executable, "-c", hidden], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert found.stdout.strip().endswith("llm False"), found.stderr
