"""The entry without the text operators, and with them but without a package they need."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; print(len(e.queries()), sum(q.startswith('op') and q[2].isdigit() or q == 'pipeline' for q in e.queries()))"


def counted(folder: str, before: str = "") -> list[int]:
    done = subprocess.run([sys.executable, "-c", before + NAMES], cwd=folder, capture_output=True, text=True, check=True)
    return [int(x) for x in done.stdout.split()]


def copied(folder) -> str:
    """The repository without what goes with the text operators."""
    away = shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py", "spark-warehouse", ".pytest_cache")
    return shutil.copytree(ROOT, folder / "repo", ignore=away)


def test_entry_without_the_text_operators(tmp_path):
    total, text = counted(copied(tmp_path))
    assert total > 80 and text == 0


def test_entry_with_a_folder_left_over(tmp_path):
    folder = copied(tmp_path)
    os.makedirs(f"{folder}/fleetlens/llm")
    assert counted(folder)[1] == 0


def test_entry_without_a_package_of_the_text_operators():
    with_all, _ = counted(ROOT)
    total, text = counted(ROOT, "import sys; sys.modules['xxhash'] = None; ")
    assert text == 0 and 80 < total <= with_all


def test_nothing_else_imports_the_text_operators():
    found = []
    for folder, _, files in os.walk(os.path.join(ROOT, "fleetlens")):
        if os.path.basename(folder) != "llm":
            for name in files:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name)) as source:
                        if "fleetlens.llm" in source.read():
                            found.append(name)
    assert found == []
