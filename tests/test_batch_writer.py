"""Batched destinations written to by name."""

import json
import os

import numpy as np
import pyarrow as pa
import pytest

from sluice.operators.batch_writer import cut_batches, register_batch_destination
from sluice.operators.external import batches


@pytest.mark.parametrize("max_rows, max_bytes", [(3, None), (None, 100), (4, 100), (1, 1), (None, 60)])
def test_batches_do_not_depend_on_the_stream(max_rows, max_bytes):
    draw = np.random.default_rng(3)
    sizes = draw.choice([0, 1, 20, 60, 100, 101, 300], 200).tolist()
    table = pa.table({"n": range(200), "size": sizes})
    rows = table.to_pylist()
    want = [[r["n"] for r in b] for b in batches(rows, max_rows, max_bytes, lambda r: r["size"])]
    for step in (1, 7, 64, 200):
        stream = [b for b in table.to_batches(max_chunksize=step)]
        empty = pa.RecordBatch.from_pylist([], table.schema)
        found = list(cut_batches([empty, *stream, empty], max_rows, max_bytes, "size"))
        assert [t["n"].to_pylist() for t, _ in found] == want
        assert [size for _, size in found] == [sum(sizes[n] for n in b) for b in want]


def _destination(spark, name, folder):
    def send(rows, partition, number):
        if "bad" in rows["text"].to_pylist():
            raise ValueError("refused")
        with open(f"{folder}/{partition}-{number}.json", "w") as out:
            json.dump(rows.to_pylist(), out)

    def finish(sent):
        with open(f"{folder}/done", "w") as out:
            json.dump([sum(s.rows for s in sent), sum(s.batches for s in sent)], out)

    def cancel(sent):
        open(f"{folder}/cancelled", "w").close()

    register_batch_destination(spark, name, send, finish, cancel)


def _read(folder):
    names = [n for n in os.listdir(folder) if n.endswith(".json")]
    return [json.load(open(os.path.join(folder, n))) for n in names]


def test_written_by_name(spark, tmp_path):
    _destination(spark, "batches_whole", str(tmp_path))
    rows = spark.range(0, 1050, 1, 3).selectExpr("id", "CAST(id AS string) AS text")
    rows.write.format("batches_whole").option("max_rows", 100).mode("append").save()
    found = _read(tmp_path)
    assert sorted(r["id"] for b in found for r in b) == list(range(1050))
    assert sorted(map(len, found)) == [50] * 3 + [100] * 9
    assert json.load(open(tmp_path / "done")) == [1050, 12]
    assert not (tmp_path / "cancelled").exists()


def test_failed_job_is_not_committed(spark, tmp_path):
    _destination(spark, "batches_failed", str(tmp_path))
    rows = spark.range(0, 30, 1, 3).selectExpr("id", "IF(id = 25, 'bad', 'good') AS text")
    with pytest.raises(Exception, match="refused"):
        rows.write.format("batches_failed").mode("append").save()
    assert not (tmp_path / "done").exists()
    assert (tmp_path / "cancelled").exists()


def test_no_rows(spark, tmp_path):
    _destination(spark, "batches_none", str(tmp_path))
    rows = spark.range(0).selectExpr("id", "'' AS text")
    rows.write.format("batches_none").mode("append").save()
    assert _read(tmp_path) == []
    assert json.load(open(tmp_path / "done")) == [0, 0]
