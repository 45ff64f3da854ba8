"""The entry file without optional parts, and jobs started from another folder than the repository."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
FOLDER = "/root/testdata/sf0.001"
SESSION = """
import sys; sys.path.insert(0, {root!r})
from rosterlake.session import build_session
spark = build_session("outside", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.ui.showConsoleProgress": "false"}})
import __spark_entry__ as entry
for name in {names!r}:
    print(name, entry.queries()[name](spark, {folder!r}).count() > 0)
"""


def run(code: str, cwd) -> list[str]:
    done = subprocess.run([sys.executable, "-c", code], cwd=cwd, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout.split("\n")


@pytest.mark.parametrize("absent", ["rosterlake.llm", "corpus_pipeline", "xxhash"])
def test_missing_parts_leave_the_other_queries(absent, tmp_path):
    code = f"import sys; sys.path.insert(0, {str(ROOT)!r}); sys.modules[{absent!r}] = None; import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"
    count, has_pipeline = run(code, tmp_path)[0].split()
    assert int(count) > 140 and has_pipeline == "False"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
def test_workers_need_no_installed_package(tmp_path):
    names = ["extract_retry", "documents_from_files", "skill_similarity", "fuzzy_location"]
    out = run(SESSION.format(root=str(ROOT), names=names, folder=FOLDER), tmp_path)
    assert [line for line in out if line] == [f"{n} True" for n in names]
