"""The driver's entry with and without the optional text queries."""

import subprocess
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent.parent)


def _names(before: str) -> set[str]:
    code = f"import sys; sys.path.insert(0, {ROOT!r})\n{before}\nimport __spark_entry__ as e\nprint(*sorted(e.queries()), '|', *sorted(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr
    names, oracles = out.stdout.split("|")
    assert set(oracles.split()) <= set(names.split())
    return set(names.split())


def test_a_missing_library_of_the_text_operators_leaves_the_others():
    core = _names("sys.modules['panelcast.llm'] = None")
    assert {"panel_nation", "seasonal_naive_cv", "adf_auto", "nearest_event"} <= core and not any(n.startswith("op1") for n in core)
    assert _names("sys.modules['xxhash'] = None") == core
    assert core <= _names("")


def test_a_broken_own_module_is_not_hidden():
    code = f"import sys; sys.path.insert(0, {ROOT!r}); sys.modules['panelcast.plans.q_eval'] = None\nimport __spark_entry__ as e\ne.queries()"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, timeout=300).returncode != 0
