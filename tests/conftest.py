import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from titlecorpus.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", shuffle_partitions=8, app_name="titlecorpus-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def write_lines(tmp_path):
    """Write text lines into ``tmp_path/<name>`` and return the path."""
    def _write(name, lines):
        p = tmp_path / name
        p.write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(p)
    return _write


@pytest.fixture
def no_broadcast(spark):
    """Call it to have Spark find every table too large to broadcast by itself."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    yield lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
