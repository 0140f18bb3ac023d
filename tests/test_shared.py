"""Scratch folders of a local master without a shared folder."""

import os
import subprocess
import sys


def test_local_master_goes_without_a_setting(tmp_path):
    code = """
from geoloom import session
from geoloom.sources import shared
s = session.build("local[1]", 1)
assert s.conf.get("spark.checkpoint.dir", None) is None
a, b = shared.scratch(s), shared.scratch(s)
assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0]
s.range(3).write.parquet(a)
assert s.read.parquet(a).count() == 3
print("fine")
"""
    assert "fine" in subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=200, env=os.environ | {"SPARK_CONF_DIR": str(tmp_path)}).stdout
