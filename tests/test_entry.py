"""The entry module with and without its optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
LIST = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q), sum(k.startswith('op') for k in q))"


def names(folder: Path) -> tuple[int, int]:
    out = subprocess.run([sys.executable, "-c", LIST], cwd=folder, capture_output=True, text=True, check=True).stdout.split()
    return int(out[-2]), int(out[-1])


def copy(to: Path) -> Path:
    skip = shutil.ignore_patterns("__pycache__")
    shutil.copytree(ROOT / "tidemark", to / "tidemark", ignore=skip)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, to)
    return to


def test_without_optional_parts(tmp_path):
    whole = names(copy(tmp_path))
    if (tmp_path / "tidemark/llm").exists():
        shutil.rmtree(tmp_path / "tidemark/llm")
    # the pipeline may still be there, or be gone as well
    less = names(tmp_path)
    (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)
    assert less == names(tmp_path) and less[1] == 0 and less[0] <= whole[0] and less[0] > 150
    (tmp_path / "tidemark/llm/__pycache__").mkdir(parents=True)
    assert names(tmp_path) == less
