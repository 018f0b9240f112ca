"""The workers find the package whatever folder the driver starts in."""

import os
import subprocess
import sys

CODE = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from tripspark.session import local_session
spark = local_session(2, "elsewhere")
print("ROWS", entry.queries()["op1_line_dedup"](spark, {sf!r}).count())
"""


def test_from_another_folder(sf_dir, tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    found = subprocess.run(
        [sys.executable, "-c", CODE.format(repo=repo, sf=sf_dir)],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300,
    )
    assert "ROWS 200" in found.stdout or "ROWS 1000" in found.stdout, found.stderr[-2000:]
