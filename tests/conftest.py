import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from windrisk.session import configure
    session = (SparkSession.builder.master("local[*]").appName("windrisk-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "4g")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


def rows(df, *order):
    """Collected rows as tuples, in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))
