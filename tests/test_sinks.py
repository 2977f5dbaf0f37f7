"""Writers, schema look-ups and listings that no query calls."""

from pyspark.sql import functions as F

from notaflow import schemas
from notaflow.operators import cleaning
from notaflow.sinks import tables
from notaflow.streaming import landing


def test_wide_contract_is_declared():
    s = schemas.struct(schemas.NF_EMITIDAS)
    assert len(s.fields) == 80 and len(schemas.NF_EMITIDAS_REQUIRED) == 11
    assert not s["valor_servicos"].nullable and s["data_competencia"].dataType.simpleString() == "date"


def test_create_and_write_if_absent(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = schemas.struct([("a", "STRING"), ("b", "INTEGER")])
    assert not tables.path_exists(spark, path)
    assert tables.create_if_absent(spark, path, schema).count() == 0
    spark.createDataFrame([("x", 1)], schema).write.mode("append").parquet(path)
    assert tables.create_if_absent(spark, path, schema).count() == 1
    tables.write_if_absent(spark.createDataFrame([("y", 2)], schema), path)
    assert spark.read.parquet(path).count() == 1
    assert schemas.table_schema(spark, path) == {"a": "string", "b": "bigint"}


def test_clustered_layout_sorts_partitions(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("p"), (1000 - F.col("id")).alias("k"))
    out = tables.clustered_layout(df, ["p"], ["k"], 4).withColumn("part", F.spark_partition_id())
    rows = out.collect()
    by = {}
    for r in rows:
        by.setdefault(r.part, []).append((r.p, r.k))
    assert len(rows) == 1000 and all(v == sorted(v) for v in by.values())


def test_routed_write_spreads_a_hot_type(spark, tmp_path):
    cells = spark.range(200).select(F.lit("Faturamento 2008.xlsx").alias("arquivo_nome"), F.lit("S").alias("aba_nome"),
                                    F.col("id").alias("linha"), F.lit(0).alias("coluna"), F.col("id").cast("string").alias("valor"))
    docs = cleaning.documents(cells)
    path = str(tmp_path / "r")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small data would be one file
    try:
        tables.write_routed(docs, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = tables.read_routed(spark, path, "faturamento_historico")
    assert got.count() == 199
    assert spark.read.parquet(path).select(F.input_file_name()).distinct().count() > 1


def test_cut_cells_are_counted(spark):
    clean = spark.createDataFrame([("f", "x" * 12), ("f", "y"), ("g", "z" * 11)], "arquivo_nome string, valor string")
    assert {r[0]: r[1] for r in cleaning.cut_cells(clean, 10).collect()} == {"f": 1, "g": 1}
    v = spark.createDataFrame([("x" * 1200,)], "v string")
    assert v.select(F.length(cleaning.coerce(F.col("v"), "STRING", None))).first()[0] == 1200


def test_pending_files(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(b"1")
    (tmp_path / "b.xlsx").write_bytes(b"2")
    ledger = spark.createDataFrame([("a.xlsx",)], "arquivo_nome string")
    assert [r.arquivo_nome for r in landing.pending_files(spark, str(tmp_path), ledger).collect()] == ["b.xlsx"]
