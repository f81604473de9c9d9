"""The entry module with and without the training-data package."""

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent

HIDDEN = """
import importlib.abc, sys

class Hide(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == "clinlake.llm" or name.startswith("clinlake.llm.") {more}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name={reported})

sys.meta_path.insert(0, Hide())
import __spark_entry__ as entry
names, sql = set(entry.queries()), set(entry.oracle_sql())
assert names and sql <= names, sql - names
assert not any(n.startswith("op") and n[2:3].isdigit() for n in names), names
assert "pipeline" not in names
print(len(names))
"""


def run_hidden(more: str = "", reported: str = "name") -> int:
    code = HIDDEN.format(more=more, reported=reported)
    out = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return int(out.stdout.split()[-1])


def test_without_the_package():
    assert run_hidden() >= 60


def test_without_the_package_and_the_pipeline():
    assert run_hidden('or name == "corpus_pipeline"') >= 60


def test_an_import_error_of_another_module_is_not_swallowed():
    code = HIDDEN.format(more="", reported='"numpy"')
    out = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert out.returncode != 0 and "ModuleNotFoundError" in out.stderr
