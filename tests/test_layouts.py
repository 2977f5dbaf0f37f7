"""Layouts that skip and co-locate (SNK-6), documents as Variants (SNK-2), keys without a parent (CHK-3)."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from notaflow.functions.exprs import document_scalars, document_value, document_variant, variant_value
from notaflow.operators import quality, staging
from notaflow.plans import registry as R
from notaflow.sinks import tables

from tests.conftest import SF
from tests.test_plans import plan

KEYS = ("tomador_cnpj", "data_emissao")


def met(path: str, col: str, values: list) -> float:
    """The share of files whose minimum and maximum admit a value, on average."""
    files = glob.glob(f"{path}/*.parquet")
    ranges = []
    for f in files:
        meta = pq.ParquetFile(f).metadata
        i = meta.schema.names.index(col)
        stats = [meta.row_group(g).column(i).statistics for g in range(meta.num_row_groups)]
        ranges.append((min(s.min for s in stats), max(s.max for s in stats)))
    return sum(lo <= v <= hi for v in values for lo, hi in ranges) / len(values) / len(files)


def test_interleaved_files_are_skipped_on_either_key(spark, tmp_path):
    inv = R.invoices(spark, SF).where("tomador_cnpj IS NOT NULL")
    z, sorted_ = str(tmp_path / "z"), str(tmp_path / "s")
    tables.interleaved_layout(inv, KEYS, 64).write.parquet(z)
    tables.clustered_layout(inv, [], KEYS, 64).write.parquet(sorted_)
    probes = inv.select(*KEYS).orderBy("numero_nfse").limit(50).collect()
    customer, day = ([p[k] for p in probes] for k in KEYS)
    assert met(z, KEYS[0], customer) < 0.35 and met(z, KEYS[1], day) < 0.35
    assert met(sorted_, KEYS[1], day) > 0.8  # one key after the other: dates skip next to nothing
    assert spark.read.parquet(z).exceptAll(inv).count() == 0 and inv.count() == spark.read.parquet(z).count()


def test_interleaved_layout_of_hot_keys_nulls_and_nothing(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("quente")).when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 40).alias("d"), F.col("id").alias("n"),
        F.create_map(F.lit("a"), F.col("id")).alias("m"))
    out = tables.interleaved_layout(df, ("k", "d"), 8).withColumn("p", F.spark_partition_id())
    assert out.select("n").distinct().count() == 3000 == out.count()
    assert out.where("k = 'quente'").select("p").distinct().count() > 1  # a hot key is split by the other one
    assert tables.interleaved_layout(df.limit(0), ("k", "d"), 4).count() == 0
    same = spark.range(100).select(F.lit("x").alias("k"), F.lit(None).cast("date").alias("d"))
    assert tables.interleaved_layout(same, ("k", "d"), 4).count() == 100


def test_interleaved_rows_are_shuffled_compressed(spark, tmp_path):
    """No wide row is shuffled alone: blocks of many rows are, and none is lost, whatever its types."""
    df = spark.range(20_000, numPartitions=4).select(
        F.sha2(F.col("id").cast("string"), 256).alias("h"), (F.col("id") % 90).cast("string").alias("k"),
        F.when(F.col("id") % 7 > 0, F.date_add(F.lit("2020-01-01"), (F.col("id") % 300).cast("int"))).alias("d"),
        (F.col("id") - 9999).cast("decimal(18,2)").alias("v"), (F.col("id") * -3).cast("decimal(38,4)").alias("w"),
        F.lit(None).cast("string").alias("leer"), F.lit("x").alias("x"), F.array(F.col("id")).alias("a"),
        F.timestamp_seconds(F.col("id")).alias("t"), F.col("id").cast("double").alias("f"), F.encode(F.col("id").cast("string"), "utf-8").alias("b"),
        F.struct("id", F.lit(None).cast("int").alias("n")).alias("s"))
    out = tables.interleaved_layout(df, ("k", "d"), 6)
    assert out.schema.simpleString() == df.schema.simpleString()
    p = plan(out)
    assert "RangePartitioning" not in p and "rangepartitioning" not in p and p.count("MapInArrow") == 2
    key = F.xxhash64(*df.columns)
    out.write.parquet(path := str(tmp_path / "z"))
    assert len(glob.glob(f"{path}/*.parquet")) == 6
    back = spark.read.parquet(path)
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty() and back.select(key).distinct().count() == 20_000


def test_files_of_a_layout_are_bounded(spark, monkeypatch):
    """Files follow the rows: a sort within one never grows with the table. A hot cell is split."""
    monkeypatch.setattr(tables, "FILE_ROWS", 500)
    monkeypatch.setattr(tables, "SMALL_ROWS", 500)
    df = spark.range(10_000).select(F.when(F.col("id") % 3 > 0, F.lit("quente")).otherwise(F.col("id").cast("string")).alias("k"),
                                    F.lit(None).cast("date").alias("d"), "id")
    sizes = [r["count"] for r in tables.interleaved_layout(df, ("k", "d")).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 10_000 and len(sizes) == 20 and max(sizes) < 1000


def test_cells_keep_together(spark):
    place, spread = tables.cell_files({0: 10, 2: 30, 3: 10}, 5)  # files of 10 rows
    assert spread == [0, 0, 30, 0] and [p * 5 // 50 for p in place] == [0, 1, 1, 4]


def test_ranges_are_cut_without_a_shuffle_of_all_rows(spark):
    """A few of a task's sorted values stand for the others; ranges stay about equal."""
    df = spark.range(64_000, numPartitions=8).select(F.xxhash64("id").alias("v"))
    bounds = tables.range_bounds(df, "v", 16)
    assert 14 <= len(bounds) <= 15
    sizes = [r["count"] for r in df.groupBy(tables.range_rank(F.col("v"), bounds)).count().collect()]
    assert max(sizes) < 2 * 64_000 / 16


def test_interleave_deals_bits_in_turn(spark):
    rows = [(a, b) for a in range(8) for b in range(8)]
    got = spark.createDataFrame(rows, "a int, b int").select("a", "b", tables.interleave([F.col("a"), F.col("b")], 3).alias("z")).collect()
    for r in got:
        want = int("".join(x + y for x, y in zip(f"{r.a:03b}", f"{r.b:03b}")), 2)
        assert r.z == want


@pytest.mark.parametrize("bounds", [[], [5], [1, 3, 3.5, 9], list(range(0, 60, 2))])
def test_rank_counts_bounds(spark, bounds):
    got = spark.range(-2, 70).select(F.col("id").cast("double").alias("v"), tables.range_rank(F.col("id").cast("double"), bounds).alias("r"))
    assert all(r.r == sum(b <= r.v for b in bounds) for r in got.collect())


def test_bucketed_tables_join_in_place(spark):
    p = plan(R.customer_months(spark, SF))
    assert "SortMergeJoin" in p and "Exchange" not in p
    assert p.count("SelectedBucketsCount: 32 out of 32") == 2


DOCS = ['{"a":1.10,"b":"x","c":{"d":1},"e":[1],"f":null,"g":true,"i":"[ABC] Ltda","k":"{\\"a\\":1}","":"vazio"}',
        '{broken', None, '', '[1]', '{"a":"1","a":"2","b":{"c":1}}', '{}']


def test_variant_lookups(spark):
    d = spark.createDataFrame([(x,) for x in DOCS], "j string").select(document_variant("j").alias("v"))
    rows = d.select(*[variant_value(F.col("v"), k).alias(k) for k in "abcefgik"]).collect()
    first = rows[0].asDict()
    assert first == {"a": "1.1", "b": "x", "c": None, "e": None, "f": None, "g": "true", "i": "[ABC] Ltda", "k": '{"a":1}'}
    assert all(v is None for r in (rows[1:5] + rows[6:]) for v in r)
    assert rows[5].a == "1" and rows[5].b is None  # a key twice: the first, as the text path takes it


def test_variant_equals_text_on_what_is_no_number(spark):
    d = spark.createDataFrame([(x,) for x in DOCS], "j string")
    both = d.select(document_variant("j").alias("v"), document_scalars("j").alias("m"))
    pairs = [F.struct(variant_value(F.col("v"), k).alias("x"), document_value(F.col("m"), k).alias("y")) for k in "bcefgi"]
    assert all(p.x == p.y for r in both.select(F.array(*pairs).alias("p")).collect() for p in r.p)


def test_staging_reads_the_variant_alone(spark):
    p = plan(staging.billing(R._raw_variant(spark, SF)))
    assert "from_json" not in p and "parse_json" not in p
    assert "PartitionFilters: [arquivo_tipo" in p
    scan = [line for line in p.split("\n") if "FileScan parquet" in line][0]
    assert "dados_json" not in scan.split("Batched")[0]


def test_orphans_by_filter_and_without(spark):
    child = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (3, "d")], "k int, v string")
    parent = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    want = [(None, "c"), (1, "a"), (1, "a"), (3, "d")]
    for most in (quality.BLOOM_KEYS, 0):
        got = quality.orphans(child, parent, "k", most).collect()
        assert sorted(((r.k, r.v) for r in got), key=lambda x: x[0] or 0) == want
        assert quality.orphans(child.limit(0), parent, "k", most).count() == 0
        assert quality.orphans(child, parent.limit(0), "k", most).count() == 5
        assert quality.orphans(child, child.select("k"), "k", most).where("k IS NOT NULL").count() == 0


def test_orphans_shuffle_few_children(spark):
    """The children meet the filter before any exchange."""
    child = spark.range(20_000).select((F.col("id") % 5000).alias("k"), F.col("id").alias("v"))
    parent = spark.range(100, 6000).select(F.col("id").alias("k"))
    out = quality.orphans(child, parent, "k")
    assert out.count() == 400
    seen = lots_passed(spark, child, parent)
    assert 400 <= seen < 1000  # of 20,000


def lots_passed(spark, child, parent) -> int:
    from notaflow.sinks import lots
    lost = child.select("k").distinct().join(parent, "k", "left_anti")
    return lots.maybe_known(child, lots.bloom_blocks(lost, "k"), "k", in_place=True).where("__talvez").count()
