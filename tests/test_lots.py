"""Exactly-once batches and the key index."""

import itertools
import re

import pytest
from pyspark.sql import functions as F

from notaflow.sinks import lots
from notaflow.sources import files
from notaflow.streaming import jobs, landing


def events(spark, rows):
    return spark.createDataFrame(rows, "id string, v int, dia string")


DAYS = [("a", 1, "2024-01-01"), ("b", 2, "2024-01-01"), (None, 3, "2024-01-01")], [("a", 1, "2024-01-02"), ("c", 4, "2024-01-02")], \
    [("b", 2, "2024-01-03"), ("c", 4, "2024-01-01"), (None, 3, "2024-01-09"), ("d", 5, None), ("d", 5, None)]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[:4])
def test_one_id_on_several_days_is_stored_once(spark, tmp_path, order):
    path = str(tmp_path / "t")
    for i in order:
        lots.append_once(events(spark, DAYS[i]), path, "id", lots.lot_name("ck", i), "dia")
    got = lots.read_store(spark, path).select("id", "v").collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a", 1), ("b", 2), ("c", 4), ("d", 5), (None, 3)], key=str)


def test_a_batch_that_failed_runs_again(spark, tmp_path):
    """Whatever its first attempt left: data without keys, keys without filter, everything."""
    path = str(tmp_path / "t")
    lots.append_once(events(spark, DAYS[0]), path, "id", "s-000000000", "dia")
    for left in (("dados",), ("dados", "chaves"), ("dados", "bloom"), ("dados", "chaves", "bloom")):
        first = lots.append_once(events(spark, DAYS[1]), path, "id", "s-000000001", "dia")
        assert first.count() == 1
        for table in ("chaves", "bloom"):
            if table not in left:
                fs, p = lots._fs(spark, f"{path}/{table}/lote=s-000000001")
                fs.delete(p, True)
        assert lots.append_once(events(spark, DAYS[1]), path, "id", "s-000000001", "dia").count() == 1
        assert sorted(str(r.id) for r in lots.read_store(spark, path).collect()) == ["None", "a", "b", "c"]


def test_data_of_a_batch_that_is_never_retried_is_indexed(spark, tmp_path):
    path = str(tmp_path / "t")
    lots.append_once(events(spark, DAYS[0]), path, "id", "s-000000000", "dia")
    lots.write_lot(events(spark, DAYS[1][1:]), f"{path}/dados", "s-000000001", "dia")  # failed before its keys
    lots.append_once(events(spark, DAYS[2]), path, "id", "other-000000000", "dia")
    assert sorted(str(r.id) for r in lots.read_store(spark, path).collect()) == ["None", "a", "b", "c", "d"]


def test_uncommitted_output_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    lots.append_once(events(spark, DAYS[0]), path, "id", "s-000000000")
    lots.write_lot(events(spark, DAYS[1]), f"{path}/dados", "s-000000001")
    (tmp_path / "t" / "dados" / "lote=s-000000001" / "_SUCCESS").unlink()
    assert lots.read_store(spark, path).count() == 3
    none = lots.append_once(events(spark, []), path, "id", "s-000000002")
    assert none.count() == 0 and lots.read_store(spark, path).count() == 3


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(20_000).selectExpr("cast(id AS string) AS id")
    blocks = lots.bloom_blocks(keys, "id")
    assert lots.maybe_known(keys, blocks, "id").where("NOT __talvez").count() == 0
    others = spark.range(100_000, 120_000).selectExpr("cast(id AS string) AS id")
    assert lots.maybe_known(others, blocks, "id").where("__talvez").count() < 200


def test_only_touched_buckets_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    many = spark.range(3000).selectExpr("cast(id AS string) AS id", "1 AS v", "'2024-01-01' AS dia")
    lots.append_once(many, path, "id", "s-000000000", "dia")
    again = lots.maybe_known(events(spark, [("17", 1, "x"), ("new", 1, "x")]), lots._bloom(spark, path, ["s-000000000"]), "id")
    out = lots.unseen(again, path, "id", "s-000000001")
    assert [r.id for r in out.collect()] == ["new"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*balde#\d+ = \d+", plan)  # one bucket of 32


def test_compaction_keeps_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(3):
        lots.append_once(events(spark, DAYS[i]), path, "id", lots.lot_name("ck", i), "dia")
    assert lots.compact_keys(spark, path, "junto", "string") == 2
    assert len(lots.committed(spark, f"{path}/chaves")) == 2
    for i in range(3):  # the newest batch may run again, older ones come as new batches
        lots.append_once(events(spark, DAYS[i]), path, "id", lots.lot_name("ck", 2) if i == 2 else lots.lot_name("ck2", i), "dia")
    assert sorted(str(r.id) for r in lots.read_store(spark, path).collect()) == ["None", "a", "b", "c", "d"]


def test_stream_counts_an_event_sent_again_on_another_day_once(spark, tmp_path):
    rows = spark.range(60).select("id", (F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int")))
                                  .alias("ts"), F.lit("u").alias("u"), F.lit(1.5).alias("v"))
    again = rows.where("id % 5 = 0").withColumn("ts", F.col("ts") + F.expr("INTERVAL 9 DAYS"))
    folder = str(tmp_path / "in")
    rows.unionByName(again).repartitionByRange(3, "ts").write.parquet(folder)
    out = jobs.stream_dedup(spark, folder, rows.schema, "*.parquet", "id", "ts", copies=1, max_files=1)
    assert out.count() == 60 and out.select("id").distinct().count() == 60
    kpis = jobs.stream_kpis(spark, folder, rows.schema, "*.parquet", "id", "ts", "u", "v", max_files=1)
    assert kpis.agg(F.sum("eventos")).first()[0] == 60


def test_landing_batch_that_fails_half_way(spark, tmp_path, monkeypatch):
    """The raw rows were written, the ledger was not: the retry leaves each once."""
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(2):
        (folder / f"Todos Clientes {i}.xlsx").write_bytes(files.build_workbook(
            {"Aba1": [(0, 0, "CNPJ"), (0, 1, "Cliente"), (1, 0, f"0{i}"), (1, 1, "Ana")]}))
    raw, ledger, checkpoint = (str(tmp_path / x) for x in ("raw", "ledger", "ck"))
    plain = landing.ledger_rows

    def fails(*args):
        raise OSError("disk full")

    monkeypatch.setattr(landing, "ledger_rows", fails)
    with pytest.raises(Exception):
        landing.ingest_landing(spark, str(folder), raw, checkpoint, ledger_path=ledger)
    assert landing.read_stored(spark, raw).count() == 2
    monkeypatch.setattr(landing, "ledger_rows", plain)
    landing.ingest_landing(spark, str(folder), raw, checkpoint, ledger_path=ledger)
    assert landing.read_stored(spark, raw).count() == 2 and landing.read_stored(spark, ledger).count() == 2
    landing.ingest_landing(spark, str(folder), raw, checkpoint + "2", ledger_path=ledger)  # a replay, with its ledger
    assert landing.read_stored(spark, raw).count() == 2 and landing.read_stored(spark, ledger).count() == 2


def test_merged_windows_equal_recomputed_ones(spark, tmp_path):
    """Counts and sums exactly, users by the sketch's bound, whatever file an event comes in or comes again in."""
    rows = spark.range(600).select("id", (F.lit("2024-01-01").cast("timestamp") + F.make_interval(mins=(F.col("id") * 7).cast("int")))
                                   .alias("ts"), (F.col("id") % 37).cast("string").alias("u"), (F.col("id") * 0.25).alias("v"))
    again = rows.where("id % 5 = 0").withColumn("ts", F.col("ts") + F.expr("INTERVAL 9 DAYS"))
    folder = str(tmp_path / "in")
    rows.unionByName(again).repartitionByRange(3, "ts").write.parquet(folder)
    # One micro-batch holds both rows of an id: the smaller row, the earlier one, stays in either job.
    got = jobs.stream_kpis_merged(spark, folder, rows.schema, "*.parquet", "id", "ts", "u", "v").collect()
    want = rows.groupBy(F.window("ts", "3 hours").alias("w")).agg(
        F.count("*").alias("n"), F.countDistinct("u").alias("u"), F.sum("v").alias("v")).collect()
    assert {(r.inicio, r.eventos, r.usuarios, r.valor_total) for r in got} == {(r.w.start, r.n, r.u, r.v) for r in want}
    split = jobs.stream_kpis_merged(spark, folder, rows.schema, "*.parquet", "id", "ts", "u", "v", max_files=1).collect()
    assert sum(r.eventos for r in split) == 600 and sum(r.valor_total for r in split) == sum(r.v for r in want)


def test_status_merges_the_batches_sums(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "cast(id % 3 AS string) AS t", "cast(id AS double) AS v")
    folder = str(tmp_path / "in")
    rows.repartitionByRange(4, "id").write.parquet(folder)
    for n in (None, 1):
        got = jobs.stream_status(spark, folder, rows.schema, "*.parquet", "t", "v", max_files=n).collect()
        assert {(r.t, r.total_linhas, r.valor_total) for r in got} == {
            (str(k), len(range(k, 100, 3)), float(sum(range(k, 100, 3)))) for k in range(3)}
