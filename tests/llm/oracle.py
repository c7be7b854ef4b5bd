"""Compares a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

from checks.compare import compare, connect
from shelftide.llm.oracle import ORACLE
from shelftide.llm.queries import QUERIES


def difference(spark, sf_dir, key):
    return compare(QUERIES[key](spark, sf_dir), connect(sf_dir), ORACLE[key])


def difference_of(df, tmp_path, key):
    """The same over a small table of documents."""
    df.coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/written")
    part = next(tmp_path.glob("written/part-*.parquet"))
    part.rename(tmp_path / "documents.parquet")
    return difference(df.sparkSession, str(tmp_path), key)
