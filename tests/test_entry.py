"""The entry without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _imported(folder) -> list[str]:
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*sorted(e.queries()))"],
                         cwd=folder, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(folder)})
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


@pytest.mark.parametrize("with_pipeline", [True, False])
@pytest.mark.parametrize("emptied", [True, False])
def test_entry_imports_without_the_subpackage(tmp_path, with_pipeline, emptied):
    shutil.copytree(os.path.join(ROOT, "driftwood"), tmp_path / "driftwood",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    if emptied:                                   # the folder is left, without its modules
        (tmp_path / "driftwood" / "llm").mkdir()
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    if with_pipeline and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
        shutil.copy(os.path.join(ROOT, "corpus_pipeline.py"), tmp_path)
    names = _imported(tmp_path)
    assert len(names) > 70 and "mojibake_segments" in names and "star_publish" in names
    assert "pipeline" not in names and not any(n.startswith("op1_") for n in names)
