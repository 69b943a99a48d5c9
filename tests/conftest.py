import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "3g").config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    connection = duckdb.connect()
    connection.sql("SET TimeZone='UTC'")
    for path in sorted(Path(DATA).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def same_rows(got, want) -> None:
    """Equal rows in any order, equal column names; floats to twelve digits."""
    import pandas as pd

    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    ordered = []
    for df in (got, want):
        df = df[columns]
        ordered.append(df.loc[df.astype(str).sort_values(columns).index].reset_index(drop=True))
    pd.testing.assert_frame_equal(*ordered, check_dtype=False, rtol=1e-12, atol=1e-12)
