"""The entry module without the llm subpackage and the corpus pipeline."""

import os
import shutil
import subprocess
import sys

from conftest import ROOT

CODE = """
import __spark_entry__ as e
names = set(e.queries())
assert not any(n.startswith("op") and n[2:3].isdigit() for n in names) and "pipeline" not in names
assert len(names) >= 64 and set(e.oracle_sql()) <= names
print("IMPORTED")
"""


def test_entry_without_llm(tmp_path):
    for name in os.listdir(ROOT):
        if name in ("ordermart", "__spark_entry__.py"):
            src = os.path.join(ROOT, name)
            if os.path.isdir(src):
                shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
            else:
                shutil.copy(src, tmp_path / name)
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert "IMPORTED" in done.stdout, done.stderr


def test_nothing_else_imports_llm():
    for folder, _, names in os.walk(os.path.join(ROOT, "ordermart")):
        if os.path.basename(folder) == "llm":
            continue
        for n in names:
            if n.endswith(".py"):
                text = open(os.path.join(folder, n)).read()
                assert "llm" not in text, os.path.join(folder, n)
