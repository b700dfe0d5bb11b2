"""The library without its training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CODE = """
import __spark_entry__ as entry
from isobar.plans import registered
assert set(entry.queries()) == set(registered()) and "anomaly_flags" in entry.queries()
assert set(entry.oracle_sql()) <= set(registered())
"""


@pytest.mark.parametrize("gone", [("isobar/llm", "tests/llm"), ("isobar/llm", "tests/llm", "corpus_pipeline.py"), ()])
def test_the_rest_works_without_them(tmp_path, gone):
    for name in ("__spark_entry__.py", "corpus_pipeline.py", "isobar", "tests"):
        source = ROOT / name
        if any(f"{name}" == part for part in gone) or not source.exists():
            continue
        if source.is_dir():
            skip = [part.split("/")[1] for part in gone if part.startswith(f"{name}/")]
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", *skip))
        else:
            shutil.copy(source, tmp_path / name)
    if not gone:
        # Folders that are left without code, as a clean-up may leave them.
        for name in ("isobar/llm", "tests/llm"):
            for file in (tmp_path / name).glob("*.py"):
                file.unlink()
    command = [sys.executable, "-c", CODE]
    done = subprocess.run(command, cwd=tmp_path, capture_output=True, text=True, timeout=120, check=False)
    assert done.returncode == 0, done.stderr[-2000:]
    collected = subprocess.run(
        [sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"],
        cwd=tmp_path, capture_output=True, text=True, timeout=300, check=False,
    )
    assert collected.returncode == 0, collected.stdout[-2000:]
