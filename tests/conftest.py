import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    at = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(at / "warehouse")).config("spark.checkpoint.dir", f"file://{at}/shared").config("spark.driver.memory", "3g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def same(a, b) -> None:
    """Equal rows in any order; times compared to the second, doubles to six places."""
    assert sorted(a.columns) == sorted(b.columns)

    def plain(df):
        df = df[sorted(df.columns)].copy()
        for c in df.columns:
            if df[c].dtype.kind in "iuf":  # integers with nulls come back as doubles
                df[c] = df[c].astype("float64").round(5)
            if df[c].dtype.kind == "M" or df[c].map(lambda x: hasattr(x, "isoformat")).any():
                df[c] = df[c].astype(str).str[:19].str.replace(" 00:00:00", "")
        return sorted(map(str, df.astype(object).where(df.notna(), None).to_dict("split")["data"]))

    assert plain(a) == plain(b)
