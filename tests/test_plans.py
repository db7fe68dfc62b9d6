"""The shape of the physical plans: what is scanned, what is pushed down, and how hot and missing keys spread."""

from __future__ import annotations

import re
from collections import Counter
from urllib.parse import urlparse
from urllib.request import url2pathname

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyframe import session
from tallyframe.checks.queries import BUILDS
from tallyframe.operators.combine import left_join_spreading_nulls
from tallyframe.plans import cip, nbv, property_tax, rollforward, suppliers
from tallyframe.session import tune
from tallyframe.sources import DerivedTables, TableSet, derived, scratch

REPORTS = [name for name in BUILDS if list(BUILDS).index(name) < list(BUILDS).index("fiscal_calendar")]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The ERP tables as Parquet, and no broadcasts, as for large inputs."""
    root = str(tmp_path_factory.mktemp("erp"))
    derived = DerivedTables(spark, "/root/testdata/sf0.001")
    from tallyframe.sources.schemas import SCHEMAS

    for name in SCHEMAS:
        derived[name].write.parquet(f"{root}/{name}")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.maxMetadataStringLength": "10000",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield TableSet.from_parquet(spark, root)
    for key in settings:
        spark.conf.unset(key)


def physical(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def scans(plan: str) -> Counter:
    return Counter(re.findall(r"FileScan parquet .*?/erp\d*/(\w+)\]", plan))


@pytest.fixture
def every_plan(stored, monkeypatch):
    """Builds a report and gives the plans of all that it writes on the way, by name, and its own under ""."""

    def build(name: str) -> dict[str, str]:
        found: dict[str, str] = {}

        def recorded(frame, label):
            found[label] = physical(frame)
            return scratch.stored(frame, label)

        for module in (cip, nbv, property_tax, rollforward, suppliers):
            monkeypatch.setattr(module, "stored", recorded)
        found[""] = physical(BUILDS[name](stored))
        return found

    return build


def exchanges(plans) -> int:
    return sum(len(re.findall(r"\bExchange ", plan)) for plan in plans)


@pytest.mark.parametrize("name", REPORTS)
def test_no_cross_joins_and_no_python(every_plan, name):
    for plan in every_plan(name).values():
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas"):
            assert word not in plan


@pytest.mark.parametrize(
    "name, tables",
    [
        ("property_tax_detail", {"fa_adjustments": 1, "fa_transaction_headers": 1, "fa_books": 1, "fa_distribution_history": 1, "fa_additions_b": 2}),
        ("property_tax_summary", {"fa_adjustments": 1, "fa_transaction_headers": 1, "fa_books": 1, "fa_distribution_history": 1, "fa_additions_b": 2}),
        ("nbv_summary", {"fa_adjustments": 1, "fa_transaction_headers": 1, "fa_distribution_history": 1, "fa_deprn_summary": 2}),
        ("nbv_detail", {"fa_adjustments": 2, "fa_distribution_history": 1, "fa_deprn_summary": 1}),
        ("asset_rollforward", {"fa_adjustments": 2, "fa_transaction_headers": 2, "fa_deprn_summary": 1, "fa_books": 1, "fa_distribution_history": 1}),
        ("cip_rollforward", {"pjc_cost_dist_lines_all": 1, "pjc_exp_items_all": 1, "pjc_prj_asset_ln_dets": 1}),
        (
            "cip_listing_in_range",
            {"pjc_cost_dist_lines_all": 1, "pjc_exp_items_all": 1, "xla_ae_lines": 1, "xla_ae_headers": 1, "ap_invoice_distributions_all": 1},
        ),
        ("supplier_directory", {"ap_invoice_distributions_all": 1, "ap_invoices_all": 1, "ap_checks_all": 1, "iby_payments_all": 1}),
    ],
)
def test_how_often_facts_are_scanned(every_plan, name, tables):
    found = sum((scans(plan) for plan in every_plan(name).values()), Counter())
    assert {table: found[table] for table in tables} == tables


@pytest.mark.parametrize(
    "name, most",
    [
        ("property_tax_detail", 30),
        ("property_tax_by_location", 32),
        ("property_tax_summary", 32),
        ("asset_rollforward", 49),
        ("nbv_detail", 52),
        ("nbv_summary", 35),
        ("cip_listing_beginning", 59),
    ],
)
def test_exchanges(every_plan, name, most):
    """In all plans of a report together, without any broadcast."""
    assert exchanges(every_plan(name).values()) <= most


def below(plan: str, table: str) -> list[str]:
    """The operators above the scan of ``table`` up to its first exchange, from below."""
    lines = plan.splitlines()
    out = []
    for at, line in enumerate(lines):
        if f"/{table}]" in line:
            depth = line.index("FileScan")
            for above in reversed(lines[:at]):
                place = re.search(r"[A-Z]", above)
                if place and place.start() < depth:
                    depth = place.start()
                    out.append(above[depth:].split()[0])
            break
    return out


@pytest.mark.parametrize(
    "name, part, table",
    [
        ("cip_listing_in_range", "items", "pjc_exp_items_all"),
        ("cip_listing_in_range", "invoice-events", "ap_invoice_distributions_all"),
        ("cip_listing_in_range", "accounts", "xla_ae_headers"),
        ("cip_listing_in_range", "", "pjc_prj_asset_ln_dets"),
        ("cip_listing_in_range", "", "ap_invoices_all"),
        ("cip_rollforward", "", "pjc_prj_asset_ln_dets"),
        ("cip_rollforward", "", "pjc_exp_items_all"),
        ("property_tax_detail", "headers", "fa_transaction_headers"),
        ("asset_rollforward", "charges", "fa_deprn_summary"),
        ("nbv_summary", "", "fa_deprn_summary"),
    ],
)
def test_lookups_are_limited_to_keys_before_they_are_grouped(every_plan, name, part, table):
    plan = every_plan(name)[part]
    above = below(plan, table)
    semi = next(i for i, op in enumerate(above) if op == "SortMergeJoin")
    assert "LeftSemi" in plan and not any("Aggregate" in op for op in above[:semi]), above


def test_payments_are_counted_without_text(every_plan):
    plan = every_plan("supplier_directory")[""]
    count = next(line for line in plan.splitlines() if "distinct payment_id" in line or "count(payment_id" in line)
    keys = re.search(r"keys=\[(.*?)\]", count)[1]
    assert re.fullmatch(r"line#\d+L(, payment_id#\d+L)?", keys), keys


@pytest.mark.parametrize(
    "name, column",
    [
        ("property_tax_detail", "transaction_date_entered"),
        ("asset_rollforward", "transaction_date_entered"),
        ("cip_rollforward", "prvdr_gl_date"),
        ("cip_listing_ending", "prvdr_gl_date"),
        ("nbv_detail", "deprn_run_date"),
        ("supplier_directory", "accounting_date"),
        ("supplier_directory", "payment_date"),
    ],
)
def test_dates_reach_the_scan(every_plan, name, column):
    pushed = [f for plan in every_plan(name).values() for f in re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan)]
    assert any(f"({column}," in filters for filters in pushed)


def test_roll_forward_prunes_the_latest_row_before_the_shuffle(stored):
    plan = physical(BUILDS["latest_distribution"](stored))
    before, after = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_hot_and_missing_keys_spread(spark, stored):
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        n = 60_000
        third = F.col("id") % 3
        left = spark.range(0, n, 1, 8).select(
            "id",
            F.when(third == 0, F.lit(None)).when(third == 1, F.lit(7)).otherwise(F.col("id")).cast("bigint").alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        right = spark.range(0, n, 1, 8).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        joined = left_join_spreading_nulls(left, right, ["k"])
        plan = physical(joined)
        assert "[k#" in plan and re.search(r"SortMergeJoin \[k#\d+L, _spread#\d+L\]", plan)
        rows = joined.agg(F.count("*"), F.count("v"), F.sum("v"), F.countDistinct("id")).first()
        unique = sum(2 * i for i in range(n) if i % 3 == 2)
        assert tuple(rows) == (n, n * 2 // 3, unique + 14 * n // 3, n)
        # No partition of the joined rows holds more than a part of the hot third, nor of the keyless one.
        done = joined.select("payload", F.spark_partition_id().alias("p"))
        sizes = done.groupBy("p").agg(F.count("*").alias("size"), F.max("payload").alias("kept")).collect()
        assert max(row["size"] for row in sizes) < n // 6
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_missing_keys_of_equal_rows_spread(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for key, value in zip(kept, ("16", "-1", "false")):
        spark.conf.set(key, value)
    try:
        left = spark.range(0, 4000, 1, 8).selectExpr("cast(null as bigint) as k", "'same' as v")
        right = spark.range(5).selectExpr("id as k", "id as w")
        out = left_join_spreading_nulls(left, right, ["k"])
        per_task = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    assert sum(per_task) == 4000 and max(per_task) <= 2000


def test_tasks_take_on_bounded_parts_of_large_tables(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows = spark.range(0, 3_000_000, 1, 1).select(F.xxhash64("id").alias("asset_id"), F.xxhash64(F.col("id") + 1).alias("n"))
    rows.write.option("parquet.block.size", str(4 << 20)).parquet(path)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        TableSet(spark, {})
        assert spark.read.parquet(path).rdd.getNumPartitions() >= 3  # 48 MB
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_shuffles_are_dealt_by_the_size_of_the_tables(spark, tmp_path):
    """Adaptive execution merges partitions and splits none: one per 8 MB of input, however few the session states."""
    rows = spark.range(0, 1_500_000, 1, 4).select(F.xxhash64("id").alias("asset_id"), F.xxhash64(F.col("id") + 1).alias("transaction_header_id"))
    rows.write.parquet(str(tmp_path / "fa_transaction_headers"))
    spark.range(1).selectExpr("id asset_id").write.parquet(str(tmp_path / "fa_additions_b"))
    assert spark.conf.get("spark.sql.shuffle.partitions") == "1"
    try:
        headers = TableSet.from_parquet(spark, str(tmp_path))["fa_transaction_headers"]  # 24 MB
        grouped = headers.groupBy("asset_id", "transaction_header_id").count()
        assert grouped.rdd.getNumPartitions() >= 2
        few = TableSet.from_parquet(spark, str(tmp_path))["fa_additions_b"]
        assert few.groupBy("asset_id").count().rdd.getNumPartitions() == 1
    finally:
        tune(spark)


def test_intermediate_tables_are_written_small(spark, tmp_path):
    frames = [scratch.stored(spark.range(100), "range"), DerivedTables(spark, "/root/testdata/sf0.001")["fa_transaction_headers"]]
    for frame in frames:
        for path in frame.inputFiles():
            column = pq.ParquetFile(url2pathname(urlparse(path).path)).metadata.row_group(0).column(0)
            assert column.compression == "ZSTD"


def test_a_long_scope_is_never_broadcast(every_plan, spark, monkeypatch):
    """Its file is small whatever its rows: what the driver holds must not grow with the assets."""
    found = []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        for most in (scratch.MOST_BROADCAST_ROWS, 5):
            monkeypatch.setattr(scratch, "MOST_BROADCAST_ROWS", most)
            plans = every_plan("asset_rollforward")
            found.append([len(re.findall(r"BroadcastHashJoin \[asset_id", plans[label])) for label in ("books", "headers", "charges", "")])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert all(few > 0 for few in found[0])
    assert found[1][:3] == [0, 0, 0] and found[1][3] < found[0][3] - 3


def test_sides_of_a_view_count_more_than_their_files(spark, tmp_path, monkeypatch):
    class View:
        mode = option = lambda self, *_: self

        @property
        def write(self):
            factors.append(float(spark.conf.get(session.SIZE_FACTOR)))
            return self

        def parquet(self, path):
            spark.range(1).select(F.lit(1).alias("asset_id")).write.parquet(path)

    factors = []
    tables = DerivedTables(spark, str(tmp_path))
    monkeypatch.setattr(tables, "_view", lambda name: None)
    monkeypatch.setattr(tables, "conform", lambda name, frame: View())
    tables._stored("fa_books")
    assert factors == [derived.SIDES_TIMES] and spark.conf.get(session.SIZE_FACTOR) == session.SETTINGS[session.SIZE_FACTOR]


def test_the_listing_deals_no_line_by_task_while_tasks_are_few(spark, stored, monkeypatch):
    """Projects and tasks are written first, so that their sizes are known when the lines meet them."""
    labels = []

    def recorded(frame, label):
        if label == "lines":
            labels.append(physical(frame))
        return scratch.stored(frame, label)

    monkeypatch.setattr(cip, "stored", recorded)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        final = physical(BUILDS["cip_listing_beginning"](stored))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "Exchange hashpartitioning(project_id" not in labels[0]
    assert "Exchange hashpartitioning(project_id" not in final


def test_lookups_on_one_key_share_their_dealing(spark, stored):
    left = spark.range(100).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    one = spark.range(0, 100, 2).select(F.col("id").alias("k"), F.lit("a").alias("x"))
    two = spark.range(0, 100, 5).select(F.col("id").alias("k"), F.lit("b").alias("y"))
    joined = left_join_spreading_nulls(left, one, ["k"], two)
    expected = sorted((v, "a" if v % 3 and v % 2 == 0 else None, "b" if v % 3 and v % 5 == 0 else None) for v in range(100))
    apart = left_join_spreading_nulls(left_join_spreading_nulls(left, one, ["k"]), two, ["k"])
    assert exchanges([physical(joined)]) == exchanges([physical(apart)]) - 1
    assert sorted((r.v, r.x, r.y) for r in joined.collect()) == expected
