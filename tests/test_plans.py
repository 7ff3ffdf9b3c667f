"""What the optimizer makes of the queries."""

from __future__ import annotations

import re

import pytest

from pyspark.sql import functions as F

from cardlake import schemas as S
from cardlake import sinks
from cardlake.operators import filters, joins, lookups, matching
from cardlake.plans import authorization_trace, chargebacks, fraud_report, presentments
from cardlake.sinks import orc
from cardlake.sources import day_slice, read_table
from fixtures.adapters import MESSAGES, view
from fixtures.queries import QUERIES
from tests.compare import spark_rows


def physical(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def optimized(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """Feed and messages as files, so that filters can reach a reader."""
    base = tmp_path_factory.mktemp("plans")
    for name in ("presentment_feed", "chargeback_feed", MESSAGES):
        view(spark, sf_dir, name).write.orc(str(base / name))
    return lambda name: spark.read.orc(str(base / name))


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not re.search("sink|stored|incremental|loads|merged|colocated|dynamic|months", n)))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = physical(QUERIES[name](spark, sf_dir))
    for operator in ("EvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert operator not in plan


def test_authorization_parses_once_and_never_shuffles(spark, stored):
    day = day_slice(stored(MESSAGES), "time_stamp", "1997-01-01")
    frame = authorization_trace(day, "2024-01-01")
    assert optimized(frame).count("from_json") + optimized(frame).count(
        "JsonToStructsEvaluator"
    ) == 1
    plan = physical(frame)
    assert "Exchange" not in plan and "Generate" not in plan
    assert "EqualTo(time_stamp,1997-01-01)" in plan


def test_presentments_never_shuffle_the_feed(spark, sf_dir, stored):
    feed = stored("presentment_feed")
    tables = ("issuers", "bins", "categories", "merchant_groups")
    frame = presentments(feed, *[view(spark, sf_dir, t) for t in tables])
    plan = physical(frame)
    assert "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") == 4


def test_filters_reach_the_reader(stored):
    plan = physical(filters.keep_presentments(stored("presentment_feed")))
    pushed = plan.split("PushedFilters:")[1]
    for condition in (
        "Not(EqualTo(day,day))", "EqualTo(l00045,1)", "In(l00016, [05,06,07])",
        "IsNotNull(l00255)", "IsNotNull(l00196)",
    ):
        assert condition in pushed
    plan = physical(filters.keep_chargebacks(stored("chargeback_feed")))
    assert "In(l00016, [15,16,17])" in plan.split("PushedFilters:")[1]


def test_only_used_columns_are_read(spark, sf_dir, stored):
    bins = view(spark, sf_dir, "bins")
    typed = lookups.with_card_type(stored("presentment_feed"), bins).select("c_tp_addbt")
    assert "ReadSchema: struct<l00019:string>" in physical(typed)


def shuffled_rows(frame) -> dict[str, int]:
    """Rows written by each distinct shuffle of a frame that has run, by its keys."""
    found, todo = {}, [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "ShuffleExchangeExec":
            keys = node.outputPartitioning().toString()
            found[re.sub(r"#\d+L?", "", keys)] = node.metrics().apply("shuffleRecordsWritten").value()
        if name != "ReusedExchangeExec":
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return found


def test_only_possible_matches_are_shuffled(spark):
    """Of 20,000 presentments 40 match; the others leave their tasks as one row each day."""
    day = (F.col("id") % 10 + 10).cast("string")
    presented = spark.range(0, 20_000, numPartitions=4).select(
        *[F.concat(F.lit(k), F.col("id")).alias(k) for k in S.MATCH_KEYS],
        F.concat(F.lit("2024-01-"), day).alias("transaction_date"),
    )
    back = presented.where("substr(arn, 4) % 500 = 0").select(*S.MATCH_KEYS)
    counted = matching.count_fraud(presented, back, ["transaction_date"])
    rows = counted.collect()
    assert sum(r.n_presented for r in rows) == 20_000
    assert sum(r.fraud_count or 0 for r in rows) == 40
    shuffles = shuffled_rows(counted)
    assert sum(n for keys, n in shuffles.items() if "transaction_date" in keys) == 4 * 10 + 40
    assert max(shuffles.values()) <= 80


def test_report_reads_each_stored_table_once(spark, sf_dir, tmp_path):
    paths = [str(tmp_path / n) for n in ("presentment", "chargeback")]
    for path in paths:
        QUERIES[path.rsplit("/", 1)[1]](spark, sf_dir).write.orc(path)
    names = ("issuers", "report_groups", "periods", "wallets")
    frame = fraud_report(
        *[spark.read.orc(p) for p in paths], *[view(spark, sf_dir, n) for n in names]
    )
    frame.collect()
    # Both branches of the plan use what one scan of each table shuffled.
    plan = physical(frame).split("Initial Plan")[0]
    for path in paths:
        assert len(re.findall(rf"InMemoryFileIndex[^\n]*{path}", plan)) == 1


@pytest.fixture
def splitting(spark):
    """Settings under which small data is shuffled, and split like large data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in settings if k != "spark.sql.autoBroadcastJoinThreshold"}
    before["spark.sql.autoBroadcastJoinThreshold"] = "10485760"
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def half_hot(spark, rows=20000):
    """Rows of which every second has the key ``hot``."""
    key = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string"))
    return spark.range(0, rows, numPartitions=8).withColumn("key", key)


def rows_of_tasks(frame) -> list[int]:
    return [r[1] for r in frame.groupBy(F.spark_partition_id()).count().collect()]


def test_report_shrinks_a_hot_key_by_itself(spark, splitting):
    """Half of the presentments share a key: they are a row per task and day when shuffled."""
    day = (F.col("id") % 28 + 1).cast("string")
    presented = half_hot(spark).select(
        *[F.col("key").alias(k) for k in S.MATCH_KEYS],
        F.concat(F.lit("2024-01-"), F.lpad(day, 2, "0")).alias("transaction_date"),
    )
    back = half_hot(spark, 2000).select(*[F.col("key").alias(k) for k in S.MATCH_KEYS])
    counted = matching.count_fraud(presented, back, ["transaction_date"])
    hot = counted.where("arn = 'hot'")
    assert hot.count() == 14
    totals = hot.selectExpr("sum(n_presented)", "max(fraud_count)", "min(fraud_count)").first()
    assert tuple(totals) == (10000, 1000, 1000)
    counted.collect()
    assert sum(shuffled_rows(counted).values()) < 20000


def test_stored_months_are_read_alone(spark, sf_dir, tmp_path):
    """Bounds of a month reach the partitions, or the reader's statistics."""
    rows = QUERIES["presentment"](spark, sf_dir).where("transaction_date is not null")
    months = spark.createDataFrame([("1997-03-05",), ("1997-13-32",), ("1997-04-01",)], "d string")
    parts, order = str(tmp_path / "parts"), str(tmp_path / "order")
    months.withColumn("n", F.lit(1)).write.partitionBy("d").orc(parts)
    sinks.overwrite(sinks.ranged(rows, sort=["transaction_date"], files=6), order)
    by_part = read_table(spark, parts, text=["d"]).where(filters.in_months(F.col("d"), ["199703"]))
    assert [r.d for r in by_part.collect()] == ["1997-03-05"]
    plan = physical(by_part)
    assert "d#" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "1997-03" in plan.split("PartitionFilters: [")[1]
    stored = read_table(spark, order)
    kept = stored.where(filters.in_months(F.col("transaction_date"), ["199703", "199811"]))
    pushed = physical(kept).split("PushedFilters: [")[1]
    assert "GreaterThanOrEqual(transaction_date,1997-03)" in pushed
    assert "LessThan(transaction_date,1998-12)" in pushed
    files = stored.select("_metadata.file_name").distinct().count()
    touched = kept.select("_metadata.file_name").distinct().count()
    assert files > touched >= 1


def test_bucketed_presentments_stay_where_they_are(spark, sf_dir, splitting):
    for parts in (1, 3):
        table = f"buckets_{parts}"
        rows, by = QUERIES["presentment"](spark, sf_dir), ["arn"]
        if parts > 1:
            rows, by = matching.with_arn_part(rows, parts), ["arn", matching.ARN_PART]
        sinks.overwrite_bucketed(rows, table, by, 4)
        try:
            names = ("bins", "categories", "merchant_groups")
            frame = chargebacks(
                view(spark, sf_dir, "chargeback_feed"), spark.table(table),
                *[view(spark, sf_dir, n) for n in names], arn_parts=parts,
            )
            assert spark_rows(frame) == spark_rows(QUERIES["chargeback"](spark, sf_dir))
            plan = physical(frame).split("Initial Plan")[0]
            (join,) = re.findall(r"SortMergeJoin \[_raw_arn[^\n]*", plan)
            above = plan[: plan.index("FileScan orc")]
            # from the join down to the presentments there is no shuffle
            assert "Exchange" not in above[above.rindex("SortMergeJoin [_raw_arn") :]
            assert "SelectedBucketsCount" in plan
        finally:
            spark.sql(f"drop table {table}")


def test_hot_arn_is_spread_over_buckets(spark):
    """Half of the presentments share an ARN; stored in parts, no file holds nearly all."""
    rows = half_hot(spark).select(
        F.col("key").alias("arn"), F.col("id").cast("string").alias("trace_id"),
        F.lit("d").alias("dpan"), F.lit("1").alias("v_rcnc"),
    )
    sinks.overwrite_bucketed(
        matching.with_arn_part(rows, 16), "hot_arns", ["arn", matching.ARN_PART], 16
    )
    try:
        stored = spark.table("hot_arns")
        sizes = [r[1] for r in stored.where("arn = 'hot'").groupBy("_metadata.file_name").count().collect()]
        assert sum(sizes) == 10_000 and max(sizes) < 5_000 and len(sizes) > 4
    finally:
        spark.sql("drop table hot_arns")


def test_days_of_another_table_choose_partitions(spark, sf_dir):
    for name in ("ymd_partition_stored", "ymd_partition_dynamic"):
        frame = QUERIES[name](spark, sf_dir)
        frame.collect()
        plan = physical(frame).split("Initial Plan")[0]
        chosen = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
        assert all(re.search(rf"\b{c}#", chosen) for c in ("year", "month", "day"))
        assert ("dynamicpruning" in chosen) == (name == "ymd_partition_dynamic")


def test_large_lookup_has_a_hot_key_split_at_run_time(spark, splitting):
    lookup = half_hot(spark, 2000).select(F.col("key").alias("code")).distinct()
    lookup = lookup.select("code", F.length("code").alias("size"))
    facts = half_hot(spark)
    joined = joins.lookup_join(facts, F.col("key"), spark.createDataFrame(lookup.collect()),
                               F.col("code"), limit=0)
    joined.collect()
    assert "skew=true" in physical(joined)
    sizes = rows_of_tasks(joined)
    assert sum(sizes) == 10000 + 1000 and max(sizes) < 11000 / 2


def test_buckets_and_ranges_follow_the_input(spark, sf_dir, tmp_path, monkeypatch):
    """More stored bytes make more of them, and no row is lost."""
    monkeypatch.setattr(orc, "BUCKET_BYTES", 1 << 10)
    monkeypatch.setattr(orc, "RANGE_BYTES", 1 << 10)
    path = str(tmp_path / "rows")
    spread = F.xxhash64("id").alias("id")
    spark.range(20_000).select(spread, (F.col("id") % 2).alias("p")).write.orc(path)
    rows = spark.read.orc(path)
    sinks.overwrite_bucketed(rows, "sized_buckets", ["id"], 2)
    try:
        table = spark.table("sized_buckets")
        assert table.count() == 20_000
        assert table.select("_metadata.file_name").distinct().count() > 2
    finally:
        spark.sql("drop table sized_buckets")
    ranges = str(tmp_path / "ranges")
    sinks.write_ranged(rows, ranges, ["p"], ["id"], files=2)
    written = spark.read.orc(ranges)
    assert written.count() == 20_000
    assert written.select("_metadata.file_name").distinct().count() > 2
