"""Driver contract on sf0.001: entry() runs, and a few queries agree with
their DuckDB oracles."""
import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF0001


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "label" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["entity_table", "stratified_split", "cohort_stats", "roc_auc",
                                  "threshold_sweep", "impute_median", "corr_lower", "boxplot_by_class", "signal_sheet"])
def test_oracle_agreement(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "orders", "events", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    df = E.queries()[name](spark, SF0001)
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(ocols)

    def norm(row, cols):
        d = dict(zip(cols, row))
        return tuple(round(d[c], 6) if isinstance(d[c], float) else d[c] for c in order)
    assert sorted(map(repr, (norm(r, df.columns) for r in df.collect()))) == \
        sorted(map(repr, (norm(r, ocols) for r in orows)))
