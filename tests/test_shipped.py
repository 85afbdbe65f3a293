"""What workers get of the library: the shipped zip alone, as on a cluster
whose machines have no copy of the repository."""

import glob
import os
import subprocess
import sys

from pyspark import SparkFiles

import sluice
from sluice.session import ship_package


def test_every_module_is_found_in_the_shipped_zip(spark, tmp_dir):
    ship_package(spark)
    top = os.path.dirname(sluice.__file__)
    names = [os.path.relpath(f, os.path.dirname(top))[:-3].replace(os.sep, ".") for f in glob.glob(f"{top}/**/*.py", recursive=True)]
    names = sorted(n for n in names if not n.endswith("__init__"))
    assert "sluice.operators.basic" in names and "sluice.streaming.processors" in names
    code = f"import sys, importlib.util as u; sys.path.insert(0, {SparkFiles.get('sluice.zip')!r}); print([n for n in {names!r} if u.find_spec(n) is None])"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, env=env, capture_output=True, text=True)
    assert done.returncode == 0 and done.stdout.strip() == "[]", done.stdout + done.stderr
