"""The entry file without its optional part."""

import shutil
import subprocess
import sys
from pathlib import Path

TOP = Path(__file__).resolve().parent.parent
ASK = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') for n in q), 'pipeline' in q, set(e.oracle_sql()) <= set(q))"


def test_imports_without_the_optional_folders(tmp_path):
    for name in ("foliospark", "catalog"):
        shutil.copytree(TOP / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (TOP / name).exists():
            shutil.copy(TOP / name, tmp_path / name)
    out = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    n, numbered, pipeline, covered = out.stdout.split()
    assert int(n) > 200 and (numbered, pipeline, covered) == ("False", "False", "True")
