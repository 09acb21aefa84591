"""The contract's module where the corpus part, or what it needs, is missing."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
# Prints the number of queries and of SQL twins, and fails on a twin without a query.
PROGRAM = """
import sys
for name in {missing!r}:
    sys.modules[name] = None
import __spark_entry__ as e
assert set(e.oracle_sql()) <= set(e.queries())
print(len(e.queries()), sum(k.startswith("op") and k[2].isdigit() for k in e.queries()))
"""


def counted(folder, missing=()):
    done = subprocess.run([sys.executable, "-c", PROGRAM.format(missing=list(missing))], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return tuple(map(int, done.stdout.split()))


@pytest.mark.parametrize("missing", ["tiktoken", "tokenizers", "public_tokenizers", "xxhash", "tallywright.llm"])
def test_a_missing_dependency_takes_only_the_corpus_part(missing):
    queries, numbered = counted(ROOT, [missing])
    assert queries >= 90 and numbered == 0


def test_without_the_folders(tmp_path):
    """Also where an emptied folder is left."""
    for name in ("tallywright", "__spark_entry__.py"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    assert counted(tmp_path)[1] == 0
    (tmp_path / "tallywright" / "llm").mkdir()
    assert counted(tmp_path)[1] == 0
