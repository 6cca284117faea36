from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.driver.memory", "3g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def shuffled_rows(spark, df) -> int:
    """Rows that the stages of df write to the shuffle."""
    context = spark.sparkContext
    tracker = lambda: {s.stageId(): s.shuffleWriteRecords() for s in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(context._jsc.sc().statusStore().stageList(None, False, False, context._gateway.new_array(spark._jvm.double, 0), None))}
    before = set(tracker())
    df.collect()
    context._jsc.sc().listenerBus().waitUntilEmpty()
    return sum(n for k, n in tracker().items() if k not in before)
