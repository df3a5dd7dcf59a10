"""A landing zone that empties itself."""

from pathlib import Path

import pytest

from periodica.streaming import ingest


def files(folder) -> set[str]:
    return {p.name for p in Path(folder).rglob("part-*.parquet")}


def test_files_leave_the_landing_folder_and_none_is_taken_twice(spark, tmp_path):
    schema = spark.range(1).schema
    root = str(tmp_path)
    landed = []
    for turn in range(3):
        spark.range(turn * 10, turn * 10 + 10).coalesce(1).write.mode("append").parquet(f"{root}/landing")
        landed.append(files(f"{root}/landing") - set().union(*landed))
        for _ in range(2):  # a run without new files takes and moves nothing
            ingest.empty_landing_zone(
                spark, f"{root}/landing", f"{root}/archive", f"{root}/taken", f"{root}/checkpoint", schema
            )
        assert spark.read.parquet(f"{root}/taken").count() == turn * 10 + 10
    assert files(f"{root}/landing") == landed[2]
    assert files(f"{root}/archive") == landed[0] | landed[1]
    taken = [r[0] for r in spark.read.parquet(f"{root}/taken").collect()]
    assert sorted(taken) == list(range(30))


def test_archive_inside_the_landing_folder_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="lies in the landing folder"):
        ingest.empty_landing_zone(spark, f"{tmp_path}/in", f"{tmp_path}/in/old", "out", "cp", spark.range(1).schema)
