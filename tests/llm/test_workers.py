"""Executors need no copy of the package for the training-data operators either."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_operators_run_from_another_folder(tmp_path, sf_dir):
    script = tmp_path / "job.py"
    script.write_text(
        textwrap.dedent(
            f"""
            import sys
            from pyspark.sql import SparkSession
            spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
            sys.path.insert(0, {ROOT!r})
            import __spark_entry__ as entry
            for name, query in entry.queries().items():
                if name.startswith("op"):
                    assert query(spark, {sf_dir!r}).count() > 0, name
            """
        )
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-2000:]
