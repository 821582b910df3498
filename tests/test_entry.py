import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_imports_without_the_corpus_part(tmp_path):
    """The rest works where the corpus folders are gone."""
    code = (
        "import shutil, sys; from pathlib import Path; src, dst = Path(sys.argv[1]), Path(sys.argv[2]);"
        "shutil.copytree(src / 'gridquill', dst / 'gridquill', ignore=shutil.ignore_patterns('llm', '__pycache__'));"
        "shutil.copy(src / '__spark_entry__.py', dst); sys.path.insert(0, str(dst));"
        "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') for n in q) and 'pipeline' not in q"
    )
    subprocess.run([sys.executable, "-c", code, str(ROOT), str(tmp_path / "")], check=True, cwd=tmp_path)


def test_nothing_else_imports_the_corpus_part():
    for path in (ROOT / "gridquill").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "llm" not in path.read_text(encoding="utf-8"), path
