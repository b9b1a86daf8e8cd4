"""The entry module where the training-text subpackage, or what it needs, is missing."""

import subprocess
import sys
from pathlib import Path

import pytest

from crisis_posts.plans import catalog

ROOT = Path(__file__).resolve().parents[1]


def registered(path, before=""):
    code = f"{before}; import __spark_entry__ as e; print(*e.queries()); assert e.oracle_sql()"
    done = subprocess.run([sys.executable, "-c", code], cwd=path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    return set(done.stdout.split())


@pytest.mark.parametrize("missing", ["ahocorasick", "tiktoken", "corpus_pipeline", "crisis_posts.llm"])
def test_what_is_missing_takes_its_queries_alone(missing):
    assert registered(ROOT, f"import sys; sys.modules[{missing!r}] = None") == set(catalog.QUERIES)


def test_a_stray_folder_is_no_subpackage(tmp_path):
    (tmp_path / "__spark_entry__.py").symlink_to(ROOT / "__spark_entry__.py")
    package = tmp_path / "crisis_posts"
    (package / "llm" / "__pycache__").mkdir(parents=True)
    for part in (ROOT / "crisis_posts").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (package / part.name).symlink_to(part)
    path = f"import sys; sys.path.insert(0, {str(tmp_path)!r})"
    assert registered(tmp_path, path) == set(catalog.QUERIES)
