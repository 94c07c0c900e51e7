"""Streams over tables that are one file or a folder of files."""

import pytest

from sluice.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def layouts(spark, sf_dir, tmp_path_factory):
    """The same documents as one file and as a folder of three."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id % 5 = 0")
    found = {}
    for kind, files in (("file", 1), ("folder", 3)):
        sf = tmp_path_factory.mktemp(kind)
        if kind == "file":
            rows.toPandas().to_parquet(sf / "documents.parquet")
        else:
            rows.repartition(files).write.parquet(str(sf / "documents.parquet"))
        # A table whose name only begins alike is another table.
        spark.range(3).write.parquet(str(sf / "documents.parquet.old"))
        found[kind] = str(sf)
    return found


@pytest.mark.parametrize("name", ["stream_kafka_out", "stream_filter_stage_sink", "stream_incremental"])
def test_streams_read_files_and_folders(spark, layouts, name):
    rows = {kind: sorted(map(tuple, QUERIES[name](spark, sf).collect())) for kind, sf in layouts.items()}
    assert rows["folder"] == rows["file"] and rows["file"]
