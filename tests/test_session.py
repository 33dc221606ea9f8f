import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_launcher_settings_are_kept():
    code = ("from tidemark.session import get_session; s = get_session('local[1]'); "
            "print(s.conf.get('spark.sql.shuffle.partitions'), "
            "s.conf.get('spark.sql.adaptive.enabled'), s.conf.get('spark.driver.memory'))")
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS=(
        "--driver-memory 700m --conf spark.sql.shuffle.partitions=4000 "
        "--conf spark.sql.adaptive.enabled=false --conf spark.ui.enabled=false pyspark-shell"))
    env.pop("PYSPARK_GATEWAY_PORT", None)
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=env, text=True,
                         capture_output=True, timeout=120, check=True).stdout
    assert out.split() == ["4000", "false", "700m"]
