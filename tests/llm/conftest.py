import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[4]").appName("llm-tests").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4")
             .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    # tests set their own checkpoint folder only where the session has none
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cadenza-test-ckpt-"))
    spark.sparkContext.setLogLevel("ERROR")
    return spark


DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from ``(doc_id, text[, lang[, source]])``; extra columns on request."""
    def make(rows, extra=""):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOC)
        for name in extra.split():
            from pyspark.sql import functions as F
            df = df.withColumn(name, F.lit("x"))
        return df
    return make
