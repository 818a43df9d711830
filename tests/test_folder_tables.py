"""Queries that stream the conversations, where the table is a folder of files."""

from pathlib import Path

import pytest

from replylane.registry import batch

SF_DIR = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not SF_DIR.exists(), reason="test tables not present")
def test_stream_reads_a_folder_of_files(spark, tmp_path):
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    table.repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    (tmp_path / "other.parquet").write_bytes(b"not a table of this stream")
    expected = batch.stream_decisions(spark, str(SF_DIR))
    got = batch.stream_decisions(spark, str(tmp_path))
    assert got.count() == expected.count() > 0
    assert got.exceptAll(expected).count() == 0
