import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from lodestone.plans import catalogue, sample_questions  # noqa: F401

SF = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not SF.exists(), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for p in SF.iterdir():
        con.sql(f"create view {p.stem} as select * from '{p}'")
    got = catalogue.queries()[name](spark, str(SF))
    cols = sorted(got.columns)
    want = con.sql(catalogue.oracle_sql()[name])
    assert cols == sorted(want.columns)
    rows = sorted(repr(tuple(r[c] for c in cols)) for r in got.collect())
    assert rows == sorted(repr(r) for r in want.project(",".join(f'"{c}"' for c in cols)).fetchall())
