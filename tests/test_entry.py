"""The driver's entry points with and without the optional operators."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCK = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(%r) or name == 'corpus_pipeline':
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert e.llm is None and 'a01_read_raw_csv' in e.queries() and set(e.oracle_sql()) <= set(e.queries())
"""


@pytest.mark.parametrize("gone", ["marketlane.llm", "ahocorasick", "public_tokenizers"])
def test_entry_works_without_the_optional_operators(gone):
    subprocess.run([sys.executable, "-c", BLOCK % gone], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_the_optional_operators():
    for folder, _, names in os.walk(os.path.join(ROOT, "marketlane")):
        if os.path.basename(folder) != "llm" and "/llm" not in folder:
            for name in (n for n in names if n.endswith(".py")):
                with open(os.path.join(folder, name)) as text:
                    assert "marketlane.llm" not in text.read(), name
