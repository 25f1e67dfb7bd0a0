"""The catalog must import where ``pyspark`` itself is loaded from a zip file."""

import os
import subprocess
import sys
import zipfile

import pyspark

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_import_with_pyspark_in_a_zip(tmp_path):
    home = os.path.dirname(pyspark.__file__)
    ready = os.path.join(home, "python", "lib", "pyspark.zip")
    if not os.path.exists(ready):
        ready = str(tmp_path / "pyspark.zip")
        with zipfile.ZipFile(ready, "w") as z:
            for d, _, names in os.walk(home):
                if os.path.relpath(d, home).split(os.sep)[0] in ("jars", "python", "bin"):
                    continue
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(d, n)
                        z.write(full, os.path.join("pyspark", os.path.relpath(full, home)))
    code = ("import pyspark, __spark_entry__ as E; "
            "assert '.zip' in pyspark.__file__, pyspark.__file__; "
            "print(len(E.queries()), len(E.oracle_sql()))")
    env = {**os.environ, "PYTHONPATH": f"{ready}:{ROOT}"}
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-2000:]
    n_queries, n_oracles = map(int, out.stdout.split()[-2:])
    assert n_queries >= n_oracles >= 50
