"""A query with Python workers runs from any folder, without the package on the workers' path."""

import os
import subprocess
import sys

import __spark_entry__

CODE = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from dailylake.session import build_session
spark = build_session("local[2]", shuffle_partitions=2)
out = entry.queries()["op10_pii"](spark, "/root/testdata/sf0.001")
print("rows", len(out.collect()))
"""


def test_query_from_a_foreign_folder(tmp_path):
    repo = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE.format(repo=repo)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 200" in done.stdout, done.stderr[-2000:]
