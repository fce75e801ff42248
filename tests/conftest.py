import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from tallyho.session import scratch_root

    scratch_root(s)  # tests: a private checkpoint folder only when none is set
    yield s


@pytest.fixture()
def tmp_text(tmp_path):
    """Write lines to a fresh text file and return its path."""
    def write(lines, name="m.txt"):
        p = tmp_path / name
        p.write_text("".join(line + "\n" for line in lines), encoding="utf-8")
        return str(p)
    return write
