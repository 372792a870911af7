import shutil

import pytest

from staymart import scratch
from staymart.scratch import stage


def test_tables_are_read_back_with_all_rows(spark, tmp_path):
    rows = stage(spark.range(10).repartition(3), str(tmp_path), "some")
    assert sorted(r.id for r in rows.collect()) == list(range(10))
    assert stage(spark.range(0), str(tmp_path), "none").count() == 0


def test_missing_rows_fail_where_no_shared_folder_is_named(spark, tmp_path, monkeypatch):
    """A folder that other executors do not see: their files are missing when read back."""
    monkeypatch.setattr(scratch, "shared_folder", lambda session: None)
    real = type(spark.read).parquet

    def lose_a_file(self, path):
        files = sorted(tmp_path.glob("*/part-*.parquet"))
        if files:
            shutil.move(files[-1], tmp_path / "lost")
        return real(self, path)

    assert stage(spark.range(10).repartition(3), str(tmp_path / "good"), "some").count() == 10
    monkeypatch.setattr(type(spark.read), "parquet", lose_a_file)
    with pytest.raises(RuntimeError, match="of 10 rows"):
        stage(spark.range(10).repartition(3), str(tmp_path), "some")
