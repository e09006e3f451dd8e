import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the test tables")
def test_entry(spark):
    import __spark_entry__ as e

    assert {r.verdict: r.images for r in e.entry(spark).collect()} == {"pass": 971, "rejected": 347, "review": 182}
    assert set(e.oracle_sql()) <= set(e.queries())


def test_library_stands_without_the_text_operators(tmp_path):
    for name in ("quillsieve", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", f"{REPO}/{name}", str(tmp_path)], check=True)
    subprocess.run(["rm", "-rf", str(tmp_path / "quillsieve" / "llm")], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 70 and not any(k.startswith('op') or k == 'pipeline' for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)
