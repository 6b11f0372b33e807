import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    made = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    made.sparkContext.setLogLevel("OFF")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{DATA}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def plain(df):
    """Rows of a pandas table by sorted columns, in a set order, with floats rounded."""
    import pandas as pd

    cols = sorted(df.columns)
    value = lambda x: None if pd.isna(x) else round(float(x), 9) if not isinstance(x, (str, bool)) and hasattr(x, "__float__") else x
    return cols, sorted([tuple(map(value, r)) for r in df[cols].astype(object).itertuples(index=False)], key=lambda r: [(x is None, str(x)) for x in r])
