"""Scratch tables and their removal."""

import os

import pytest

from shelfline.session import materialize, scratch_dir, scratch_scope, written


def folders(spark):
    return {f for f in os.listdir(scratch_dir(spark).removeprefix("file:"))}


def test_scope_removes_what_was_written_inside(spark, tmp_path):
    outside = materialize(spark.range(3), "outside")
    before = folders(spark)
    with scratch_scope(spark):
        inside = materialize(spark.range(5), "inside")
        with scratch_scope(spark):
            materialize(spark.range(7), "deeper")
        assert len(folders(spark)) == len(before) + 1
        inside.write.parquet(str(tmp_path / "kept"))
    assert folders(spark) == before
    assert outside.count() == 3 and spark.read.parquet(str(tmp_path / "kept")).count() == 5


def test_scope_ends_with_an_error_too(spark):
    before = folders(spark)
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        materialize(spark.range(5), "inside")
        raise ZeroDivisionError
    assert folders(spark) == before


def test_scope_drops_tables(spark, tmp_path):
    with scratch_scope(spark):
        written("table", "scoped_rows")
        spark.range(3).write.option("path", str(tmp_path / "t")).saveAsTable("scoped_rows")
        assert spark.table("scoped_rows").count() == 3
    assert not spark.catalog.tableExists("scoped_rows")
