"""De-duplication on keyed state: what passes and what is late are together the batch result."""

import os

import pytest

from notaflow.streaming import jobs

SCHEMA = "id string, ts timestamp, v int"
FILES = ([("a", "2024-01-01 00:00:00", 1), ("b", "2024-01-01 05:00:00", 2), ("a", "2024-01-01 00:00:00", 1), (None, None, 9),
          ("f", "2024-01-02 00:00:00", 6)],
         [("b", "2024-01-01 05:00:00", 2), ("c", "2024-01-20 00:00:00", 3), ("n", None, 8)],
         [("a", "2024-01-01 00:00:00", 1), ("c", "2024-01-20 00:00:00", 3), ("d", "2024-02-20 00:00:00", 4), ("n", None, 8),
          ("e", "2024-01-05 00:00:00", 5)])


def land(spark, tmp_path, order):
    """One file per list, oldest first in the given order."""
    folder = tmp_path / "in"
    folder.mkdir()
    for n, i in enumerate(order):
        rows = [(k, t, v) for k, t, v in FILES[i]]
        df = spark.createDataFrame(rows, "id string, ts string, v int").selectExpr("id", "cast(ts AS timestamp) ts", "v").coalesce(1)
        df.write.parquet(str(tmp_path / f"part{n}"))
        part = next((tmp_path / f"part{n}").glob("*.parquet"))
        target = folder / f"f{n}.parquet"
        target.write_bytes(part.read_bytes())
        os.utime(target, (1_700_000_000 + n, 1_700_000_000 + n))
    return str(folder)


#: Files by age, and what is late when the newest is read first. A batch's rows are
#: held against the watermark of the batch before the last one.
ORDERS = [((0, 1, 2), {"None", "n", "f"}), ((2, 1, 0), {"None", "n"}), ((1, 2, 0), {"None", "n"})]


@pytest.mark.parametrize("order,expected", ORDERS)
def test_stored_is_the_batch_result_in_any_order(spark, tmp_path, order, expected):
    schema = spark.createDataFrame([], SCHEMA).schema
    out, late = jobs.stream_dedup_state(spark, land(spark, tmp_path, order), schema, "*.parquet", "id", "ts", copies=1, max_files=1)
    got = sorted((str(r.id), str(r.ts), r.v) for r in out.collect())
    assert got == sorted({(str(k), str(t), v) for f in FILES for k, t, v in f})
    assert {str(r.id) for r in late.collect()} == expected


def test_a_resumed_stream_keeps_its_state(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    folder, store, ck = land(spark, tmp_path, (0, 1)), str(tmp_path / "store"), str(tmp_path / "ck")
    for n in range(2):
        jobs.state_dedup(jobs.file_stream(spark, folder, schema), store, ck, "id", "ts")
        if n == 0:  # a copy of the first file, and one with rows before the watermark
            (tmp_path / "in" / "again.parquet").write_bytes((tmp_path / "in" / "f0.parquet").read_bytes())
    from notaflow.sinks import lots
    assert sorted(str(r.id) for r in lots.read_store(spark, store).collect()) == ["None", "a", "b", "c", "f", "n"]


def test_empty_stream(spark, tmp_path):
    (tmp_path / "none").mkdir()
    schema = spark.createDataFrame([], SCHEMA).schema
    out, late = jobs.stream_dedup_state(spark, str(tmp_path / "none"), schema, "*.parquet", "id", "ts")
    assert out.columns == ["id", "ts", "v"] and out.count() == 0 and late.count() == 0
