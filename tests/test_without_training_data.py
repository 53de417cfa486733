"""The rest works without the training-data package, and a module missing elsewhere is an error."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def copy_without(scratch, *gone):
    shutil.copytree(ROOT, f"{scratch}/repo", ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", ".hypothesis"))
    for name in gone:
        path = f"{scratch}/repo/{name}"
        if os.path.isdir(path):
            shutil.rmtree(path)
        elif os.path.exists(path):  # they may be gone already
            os.remove(path)
    return f"{scratch}/repo"


def ask(repo, code):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", code], cwd=repo, env=env, capture_output=True, text=True, timeout=120)


def test_entry_without_the_package(scratch):
    repo = copy_without(scratch, "logpulse/llm", "tests/llm", "corpus_pipeline.py")
    out = ask(repo, "import __spark_entry__ as e; print(len(e.queries()), set(e.queries()) == set(e.oracle_sql()), "
                    "any(k.startswith('op') or k == 'pipeline' for k in e.queries()))")
    assert out.returncode == 0, out.stderr
    n, same, dealt = out.stdout.split()
    assert int(n) >= 45 and same == "True" and dealt == "False"
    listed = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"], cwd=repo, capture_output=True, text=True,
                            timeout=300, env={**os.environ, "PYTHONPATH": repo})
    assert listed.returncode == 0, listed.stdout[-2000:]


def test_a_module_missing_elsewhere_is_an_error(scratch):
    repo = copy_without(scratch, "logpulse/sources/growing.py")
    out = ask(repo, "import __spark_entry__")
    assert out.returncode != 0 and "logpulse.sources.growing" in out.stderr


def test_nothing_else_imports_the_package():
    for folder, _, files in os.walk(f"{ROOT}/logpulse"):
        if "llm" in os.path.relpath(folder, ROOT).split(os.sep):
            continue
        for name in files:
            if name.endswith(".py"):
                assert "logpulse.llm" not in open(f"{folder}/{name}").read(), name
