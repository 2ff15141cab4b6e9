"""What only shows on tables larger than those of the checking SQL."""

import duckdb

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def tables(folder, parts):
    """The small events, and parts of the given keys."""
    con = duckdb.connect()
    con.execute(f"COPY (SELECT * FROM '{SF}/events.parquet') TO '{folder}/events.parquet' (FORMAT parquet)")
    con.execute(
        f"""COPY (SELECT * REPLACE (k AS p_partkey) FROM (SELECT * FROM '{SF}/part.parquet' LIMIT 1),
        unnest({parts}) AS t(k)) TO '{folder}/part.parquet' (FORMAT parquet)"""
    )
    return str(folder)


def test_parts_whose_ids_repeat_are_reported_once_each(spark, tmp_path):
    # The bridge cuts ids of five digits to four: both are 1000-mega.
    sf_dir = tables(tmp_path, [1000, 10000, 7])
    found = entry.queries()["assertions_dirty"](spark, sf_dir).where("check_name = 'crlf_residue'")
    assert sorted(r.detail for r in found.collect()) == ["1000-mega", "1000-mega", "7"]
