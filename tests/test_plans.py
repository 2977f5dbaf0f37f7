"""Plan-shape checks: the scale properties the design relies on."""

from notaflow.plans import registry as R

from tests.conftest import SF


def plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # AQE: final plan after execution
    return df._jdf.queryExecution().executedPlan().toString()


def test_staging_prunes_partitions_and_parses_once(spark):
    p = plan(R.q_staging_billing(spark, SF))
    assert "PartitionFilters: [arquivo_tipo" in p
    assert p.count("from_json(") == 1
    assert "Generate explode" in p


def test_flagship_aggregates_partially_on_a_pruned_scan(spark):
    p = plan(R.q_customer_performance(spark, SF))
    assert "partial_sum(valor_liquido" in p
    assert "SinglePartition" not in p
    scan = [line for line in p.split("\n") if "FileScan parquet" in line][0]
    assert "hash_nfse" not in scan and "discriminacao" not in scan  # only the used columns are read


def test_views_without_ranking_have_no_single_partition_exchange(spark):
    for q in (R.q_sales_opportunities, R.q_tax_recovery):
        p = plan(q(spark, SF))
        # a global sort for ORDER BY is a range exchange, never a single partition
        assert "SinglePartition" not in p


def test_fact_join_salts_blank_keys(spark):
    from notaflow.operators import marts
    p = plan(marts.fact_billing(R._billing(spark, SF), R._dim(spark, SF)))
    assert "xxhash64" in p and "LeftOuter" in p


def test_checks_read_each_table_once(spark):
    p = plan(R.q_contract_checks(spark, SF))
    p = p[p.index("Initial Plan"):] if "Initial Plan" in p else p
    assert p.count("Exchange SinglePartition") == 3  # one aggregate per table


def test_kpis_multiply_no_rows(spark):
    p = plan(R.q_executive_kpis(spark, SF))
    assert "Expand" not in p


def test_store_reads_only_the_batch_partitions(spark, tmp_path):
    from pyspark.sql import functions as F
    from notaflow.operators import loading
    path = str(tmp_path / "store")
    old = spark.range(100).select(F.col("id").cast("string").alias("k"), (F.col("id") % 10).cast("int").alias("p"))
    assert loading.append_new(old, path, "k", "p") == 100
    batch = old.filter("p = 3").unionByName(spark.createDataFrame([("new", 3)], "k string, p int"))
    p = plan(loading.new_rows(batch, loading.stored_slice(batch, path, "p"), "k"))
    assert "PartitionFilters: [" in p and "(p#" in p.split("PartitionFilters: [")[1][:200]
    assert loading.append_new(batch, path, "k", "p") == 1


def test_fact_is_stored_by_month(spark):
    from pyspark.sql import functions as F
    p = plan(R.q_fact_billing(spark, SF).filter(F.col("ano") == 1996))
    assert "PartitionFilters: [" in p and "ano#" in p.split("PartitionFilters: [")[1][:200]
