"""The entry module with and without the optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; print(*e.queries())"


def names(folder, *before):
    ran = subprocess.run([sys.executable, "-B", "-c", "; ".join([*before, NAMES])], cwd=folder, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr
    return ran.stdout.split()


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_the_llm_folders(tmp_path, pipeline):
    for name in ("inkline", "__spark_entry__.py", *(["corpus_pipeline.py"] if pipeline else [])):
        copy = shutil.copytree if os.path.isdir(f"{ROOT}/{name}") else shutil.copy
        copy(f"{ROOT}/{name}", tmp_path / name, **({"ignore": shutil.ignore_patterns("llm", "__pycache__")} if name == "inkline" else {}))
    got = names(tmp_path)
    assert len(got) > 140 and "pipeline" not in got and not any(n.startswith("op1_") for n in got)


def test_without_a_library_of_the_llm_operators():
    got = names(ROOT, "import sys", "sys.modules['zstandard'] = None")
    assert len(got) > 140 and "op7_warc" not in got
