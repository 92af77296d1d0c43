import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_corpus_subpackage(folder):
    shutil.copy(f"{ROOT}/__spark_entry__.py", folder)
    shutil.copytree(f"{ROOT}/tidemark", f"{folder}/tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(q) == set(s) and len(q) >= 30 and not any(n.startswith('op') for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=folder, env=os.environ | {"PYTHONPATH": ""}, check=True, timeout=120)


def test_nothing_else_imports_it():
    for top, _, names in os.walk(f"{ROOT}/tidemark"):
        for name in names:
            if name.endswith(".py") and "llm" not in os.path.relpath(top, ROOT):
                assert "tidemark.llm" not in open(f"{top}/{name}").read(), name
