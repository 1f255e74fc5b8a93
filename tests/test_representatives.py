"""Representative texts of equal keys: the first in the table, as the SQL takes it."""

from pathlib import Path

import duckdb

from convolens import plans

from .oracle import compare


def test_equal_keys(spark, sf_dir, tmp_path):
    for table in Path(sf_dir).glob("*.parquet"):
        if table.name != "lineitem.parquet":
            (tmp_path / table.name).symlink_to(table)
    keys = "1 AS l_orderkey, CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE 2 END AS l_linenumber"
    duckdb.sql(f"COPY (SELECT * REPLACE ({keys}) FROM '{sf_dir}/lineitem.parquet' ORDER BY l_extendedprice) TO '{tmp_path}/lineitem.parquet'")
    got, want = compare(spark, str(tmp_path), plans.QUERIES["representative_texts"], plans.ORACLE_SQL["representative_texts"])
    assert got == want
