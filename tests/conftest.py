import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from cargoframe.session import get_spark
    s = get_spark(app="cargoframe-tests", master="local[*]", shuffle_partitions=8,
                  extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def one_col(spark, values, expr, name="x"):
    """Evaluate a Column function over a list of input strings."""
    df = spark.createDataFrame([(v,) for v in values], f"{name} string")
    return [r[0] for r in df.select(expr).collect()]
