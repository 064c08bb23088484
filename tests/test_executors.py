import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from ratewell.session import local_session
spark = local_session("elsewhere", "4", 4)
for name in ("j5_dependent_columns", "j8_complexity_table", "j12_poisson_booster", "j20_scored_frame", "e9_adaptive_oversampling"):
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
"""


def test_tasks_need_no_installed_package(tmp_path):
    """Run from another folder, where a worker cannot import this package."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
