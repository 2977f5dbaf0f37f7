"""Builds and loads whose cost must follow the rows: shuffles, tasks, generated code, XML reading."""

import glob

import pytest
from pyspark.sql import functions as F

from notaflow.plans import registry as R
from notaflow.session import JIT_LIMIT
from notaflow.sinks import tables
from notaflow.sources import adapter

from tests.conftest import SF
from tests.test_plans import plan


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {n: spark.conf.get(n) for n in names}
    for n, v in zip(names, ("-1", "false")):
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def test_lines_are_shuffled_once(spark, no_broadcast):
    """By order, and the notes of an order are made where its lines then lie."""
    for build in (adapter.invoices, adapter.billing_documents, adapter.invoice_xml_documents):
        p = plan(build(spark, SF))
        assert p.count("Exchange hashpartitioning(l_orderkey") == 1
        lines = [x for x in p.split("\n") if "Exchange" in x and "l_orderkey" not in x and "o_orderkey" not in x]
        assert len(lines) == 4 and not any("l_partkey" in x for x in lines)  # orders, customers, nations


def test_raw_rows_are_written_where_they_lie(spark, tmp_path):
    rows = spark.range(0, 400, 1, 4).select((F.col("id") % 2).cast("string").alias("arquivo_tipo"), F.lit("{}").alias("dados_json"),
                                            F.lit(None).cast("string").alias("cnpj"), F.col("id").alias("n"))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    tables.append_raw(rows, str(tmp_path / "raw"))
    assert len(glob.glob(f"{tmp_path}/raw/arquivo_tipo=*/*.parquet")) == 8  # every task its own of both types
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 400
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_wide_projections_stay_within_the_jit(spark):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    R.stored_path(spark, SF, "prova_de_metodo", lambda s, d: s.range(1), R._write_plain)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= JIT_LIMIT


def test_cells_lie_in_many_files(spark):
    assert adapter.spreadsheet_cells(spark, SF).rdd.getNumPartitions() > 2 * spark.sparkContext.defaultParallelism
