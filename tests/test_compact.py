"""What the marts and reports shuffle: few and narrow rows, or wide ones as compressed columns."""

import glob

import pytest
from pyspark.sql import functions as F

from notaflow.operators import loading, views
from notaflow.plans import registry as R
from notaflow.session import set_while
from notaflow.sinks import tables

from tests.conftest import SF
from tests.test_plans import plan


def months(spark):
    n = F.col("id")
    return spark.range(6000, numPartitions=4).select(
        n, F.when(n % 7 > 0, (2000 + n % 3).cast("bigint")).alias("ano"), (1 + n % 12).cast("bigint").alias("mes"), F.repeat(F.lit("x"), 50).alias("t"))


def test_a_month_lies_in_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "SMALL_ROWS", 500)
    df = months(spark)
    out = tables.by_month(df, "ano", "mes", df.select("ano", "mes"))
    assert "mapInArrow" in plan(out) or "MapInArrow" in plan(out)
    out.write.partitionBy("ano", "mes").parquet(str(tmp_path / "f"))
    back = spark.read.parquet(str(tmp_path / "f")).select(df.columns)
    assert back.exceptAll(df).count() == 0 and back.count() == 6000
    assert len(glob.glob(f"{tmp_path}/f/ano=2001/mes=2/*.parquet")) == 1
    assert tables.by_month(df.limit(0), "ano", "mes", df.limit(0)).count() == 0


def test_fact_rows_are_shuffled_packed_and_not_sorted_to_join(spark):
    """The fact's only exchange of whole rows by row is the join's."""
    R.q_fact_billing(spark, SF)
    seen = {}

    def write(df, path, parts):
        seen["plan"], seen["hash"] = plan(df), spark.conf.get("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold")
    before, R.overwrite = R.overwrite, write
    try:
        R._write_fact(R.marts.fact_billing(R._billing(spark, SF), R._dim(spark, SF)), "", R._billing(spark, SF))
    finally:
        R.overwrite = before
    assert "MapInArrow" in seen["plan"] and "REBALANCE" not in seen["plan"] and seen["hash"] == "64m"


def test_kpis_shuffle_customers_once(spark):
    with set_while(spark, {"spark.sql.adaptive.enabled": "false"}):
        p = plan(views.executive_kpis(R.invoices(spark, SF)))
    assert len([x for x in p.split("\n") if "Exchange hashpartitioning" in x and "tomador_cnpj" in x]) == 1


def test_kpis_of_odd_rows(spark):
    rows = [("2024-01-03", "a", "1", 5.0), ("2024-01-04", "a", "2", 1.0), ("2024-01-04", None, None, 2.0), ("2024-02-01", "b", None, None), (None, "c", "1", 3.0)]
    zero = F.lit(0).cast("decimal(18,2)")
    inv = spark.createDataFrame(rows, "d string, tomador_cnpj string, item_lista_servico string, v double").select(
        F.col("d").cast("date").alias("data_emissao"), "tomador_cnpj", "item_lista_servico", F.col("v").cast("decimal(18,2)").alias("valor_liquido"),
        *[zero.alias(f"valor_{x}") for x in ("pis", "cofins", "inss", "ir", "csll", "iss")])
    got = {(r.ano, r.mes): (r.nfses_emitidas, r.clientes_unicos, r.tipos_servico, r.receita_liquida) for r in views.executive_kpis(inv).collect()}
    assert got == {(2024, 1): (3, 1, 2, 8.0), (2024, 2): (1, 1, 0, None), (None, None): (1, 1, 1, 3.0)}


ROWS = [("a", 2, "x"), ("a", 1, "y"), ("a", 1, None), ("b", 5, "x"), (None, 4, "x"), (None, 3, "x"), ("c", None, "x"), ("c", 7, "x"), ("s", 9, "x"), ("s", 8, "x"), ("t", 1, "x")]


@pytest.mark.parametrize("stored", [[], ["s", "t", "z", "s", None]])
def test_new_rows_packed_are_the_new_rows(spark, stored):
    batch = spark.createDataFrame(ROWS * 3 + [(f"k{i % 700}", i, "w") for i in range(3000)], "k string, v int, w string").repartition(3)
    keys = spark.createDataFrame([(k,) for k in stored], "k string")
    got, want = loading.new_rows_packed(batch, keys, "k"), loading.new_rows(batch, keys, "k")
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert loading.new_rows_packed(batch.limit(0), keys, "k").count() == 0


def test_first_of_each_over_batches():
    import pyarrow as pa
    rows = pa.table({"k": [None, None, "a", "a", "b", "b", "b", "c"], "n": range(8), "__known": [False, False, False, False, True, False, False, False]})
    for size in (1, 2, 3, 8):
        out = loading.first_of_each("k")(rows.to_batches(size))
        assert [n for b in out for n in b.column(1).to_pylist()] == [0, 2, 7]


def test_wide_rows_of_a_load_are_shuffled_packed(spark):
    with set_while(spark, {"spark.sql.adaptive.enabled": "false"}):
        p = plan(R.q_insert_if_absent(spark, SF))
    assert not [x for x in p.split("\n") if "Exchange hashpartitioning" in x and "discriminacao" in x] and "SortMergeJoin" not in p and "min(struct" not in p
