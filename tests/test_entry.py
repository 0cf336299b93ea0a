"""The entry module with modules missing."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _names(blocked):
    code = ("import sys\n"
            f"for name in {blocked!r}: sys.modules[name] = None\n"
            "import __spark_entry__ as e\n"
            "print(len(e.queries()), sum(k.startswith('op') or k == 'pipeline' for k in e.queries()), set(e.oracle_sql()) <= set(e.queries()))")
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return out.stdout.split(), out.stderr


def test_library_queries_stay_where_other_modules_are_absent():
    from cadenza.plans.catalog import queries
    for blocked in (["ahocorasick"], ["xxhash"], ["regex"], ["cadenza.llm"], ["corpus_pipeline"]):
        (n, extra, known), said = _names(blocked)
        assert (int(n), int(extra), known) == (len(queries()), 0, "True")
        assert "training-data queries are left out" in said
        if os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
            assert blocked[0].split(".")[-1] in said
