"""Numbers that are wider than their place in a label, against the SQL twins."""

import duckdb
import pytest

from newsweft import plans


def matches_sql(spark, folder, name, tables):
    """The query over ``tables`` (name to rows and schema) gives its SQL's rows, which are returned."""
    con = duckdb.connect()
    for t, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{t}.parquet")
        con.execute(f"create or replace view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
    df = plans.QUERIES[name](spark, str(folder))
    want = con.execute(plans.ORACLE_SQL[name])
    cols = [d[0] for d in want.description]
    want = sorted(want.fetchall())
    assert sorted(map(tuple, df.select(cols).collect())) == want
    return want


def test_item_ids_of_a_large_source(spark, tmp_path):
    rows = [(i, "t", "en", "a", 1) for i in range(10_020)]
    found = matches_sql(spark, tmp_path, "item_ids_batches", {"documents": (rows, "doc_id long, text string, lang string, source string, n_chars long")})
    assert max(r[1] for r in found) == 10_020


@pytest.mark.parametrize("name", ["duplicate_components", "extended_components"])
def test_labels_beyond_three_digits(spark, tmp_path, name):
    # Pairs of equal texts, at ids that are no neighbours and, for two of three pairs, in the first run.
    rows = [(17 * i + 5, f"t{i // 2}", "en", "a", i) for i in range(4000)]
    found = matches_sql(spark, tmp_path, name, {"documents": (rows, "doc_id long, text string, lang string, source string, n_chars long")})
    assert len({r[1] for r in found}) == 2000 and {len(r[2]) for r in found} == {5}
