
import os

import duckdb

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def test_shared_port_codes_are_reported(spark, workdir):
    """Suppliers 3,000 apart share a code; every other natural key is unique."""
    for name in os.listdir(SF_SMALL):
        if name != "supplier.parquet":
            os.symlink(f"{SF_SMALL}/{name}", f"{workdir}/{name}")
    con = duckdb.connect()
    con.execute(f"COPY (SELECT * REPLACE (CASE WHEN s_suppkey = 2 THEN 3001 ELSE s_suppkey END AS s_suppkey) FROM '{SF_SMALL}/supplier.parquet') "
                f"TO '{workdir}/supplier.parquet' (FORMAT parquet)")
    for name in ("supplier", "nation", "region", "lineitem", "orders", "part", "events"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{workdir}/{name}.parquet'")
    got = {r["check"]: (r["dup_groups"], int(r["dup_rows"])) for r in entry.queries()["dq_unique"](spark, workdir).collect()}
    assert got.pop("dim_port.port_code") == (1, 2)
    assert len(got) == 5 and set(got.values()) == {(0, 0)}
    want = {a: (b, int(c)) for a, b, c in con.execute(entry.oracle_sql()["dq_unique"]).fetchall()}
    assert want == got | {"dim_port.port_code": (1, 2)}
