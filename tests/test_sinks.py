"""Sinks, table to table jobs and incremental loading."""

from __future__ import annotations

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cardlake import schemas as S
from cardlake import sinks
from cardlake.operators import filters, incremental
from cardlake.plans import clearing, jobs
from cardlake.sources import day_slice, read_table, table_exists, ymd_days, ymd_partition
from fixtures.adapters import MESSAGES, view
from fixtures.queries import ELABORATION_DAY, MESSAGE_DAY, QUERIES
from tests.compare import spark_rows


@pytest.fixture
def rows(spark):
    data = [(1, "a"), (2, "a"), (3, "b"), (4, None)]
    return spark.createDataFrame(data, "n int, p string")


@pytest.fixture(params=["path", "table"])
def target(request, spark, tmp_path):
    if request.param == "path":
        yield str(tmp_path / "t")
    else:
        yield "sink_target"
        spark.sql("drop table if exists sink_target")


def stored(spark, target):
    return Counter((r.n, r.p) for r in read_table(spark, target, ["n", "p"]).collect())


def test_append_twice_doubles(spark, rows, target):
    for gather in (True, False):
        sinks.append_partitions(rows, target, ["p"], gather=gather)
    assert stored(spark, target) == Counter({(r.n, r.p): 2 for r in rows.collect()})


def test_overwrite_replaces_all(spark, rows, target):
    sinks.overwrite(rows, target)
    sinks.overwrite(rows.where("n = 3"), target, sort=["n"])
    assert stored(spark, target) == {(3, "b"): 1}


def test_replace_keeps_other_partitions(spark, rows, target):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    sinks.replace_partitions(rows, target, ["p"])
    new = spark.createDataFrame([(9, "a"), (8, None), (7, "c")], "n int, p string")
    for _ in range(2):
        sinks.replace_partitions(new, target, ["p"])
    assert stored(spark, target) == Counter([(9, "a"), (3, "b"), (8, None), (7, "c")])
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


ODD = "x y/z='1'%"


def test_replace_whole_leaves_nothing_behind(spark, rows, target):
    more = rows.union(spark.createDataFrame([(5, ODD), (6, "c")], "n int, p string"))
    sinks.replace_whole(more, target, ["p"])
    assert stored(spark, target) == Counter(map(tuple, more.collect()))
    for left in ("n in (1, 6)", "n = 4 or n = 1"):
        for _ in range(2):
            sinks.replace_whole(rows.where(left), target, ["p"])
        assert stored(spark, target) == Counter(map(tuple, rows.where(left).collect()))


def loads(spark, target):
    frame = read_table(spark, target, text=["day"])
    return Counter((r.n, r.p, r.day) for r in frame.select("n", "p", "day").collect())


def test_a_load_replaces_itself_alone(spark, rows, target):
    days = {"2024-01-01": rows, "2024-01-02": rows.where("n > 1"), "2024-01-03": rows}
    for day in (*days, "2024-01-01", "2024-01-02"):
        sinks.replace_whole(days[day], target, ["p"], scope={"day": day}, gather=day[-1] == "1")
    sinks.replace_whole(rows.where("n = 4"), target, ["p"], scope={"day": "2024-01-03"})
    days["2024-01-03"] = rows.where("n = 4")
    expected = [(r.n, r.p, day) for day, frame in days.items() for r in frame.collect()]
    assert loads(spark, target) == Counter(expected)
    sinks.replace_whole(rows.where("false"), target, ["p"], scope={"day": "2024-01-03"})
    assert loads(spark, target) == Counter(e for e in expected if e[2] != "2024-01-03")
    with pytest.raises(ValueError, match="plain"):
        sinks.replace_whole(rows, target, ["p"], scope={"day": "../x"})


def test_a_write_that_fails_changes_nothing(spark, rows, target):
    """Some tasks write their rows before another one fails; the next run mends all."""
    sinks.replace_whole(rows, target, ["p"], scope={"day": "1"})
    before = loads(spark, target)
    new = spark.range(0, 400, 1, 4).select(
        F.col("id").cast("int").alias("n"), F.lit("a").alias("p"), F.col("id").alias("at")
    )
    bad = F.when(F.col("at") == 399, F.raise_error(F.lit("lost"))).otherwise(F.col("p"))
    with pytest.raises(Exception, match="lost"):
        sinks.replace_whole(
            new.withColumn("p", bad).drop("at"), target, ["p"], scope={"day": "1"}, gather=False
        )
    assert loads(spark, target) == before
    sinks.replace_whole(new.drop("at"), target, ["p"], scope={"day": "1"}, gather=False)
    assert loads(spark, target) == Counter((i, "a", "1") for i in range(400))


@pytest.mark.parametrize("hot", [False, True])
def test_ranged_files_do_not_overlap(spark, tmp_path, hot):
    path = str(tmp_path / "ranges")
    name = F.when(F.lit(hot) & (F.col("id") % 3 > 0), 7).otherwise(F.xxhash64("id") % 1000)
    rows = spark.range(0, 30_000, 1, 5).select(
        (F.col("id") % 2).cast("string").alias("p"), name.alias("n"), F.col("id").alias("at")
    )
    sinks.write_ranged(rows, path, ["p"], ["n"], rows_per_file=2_000, files=6, spread=["at"])
    files = (
        spark.read.orc(path)
        .groupBy("p", "_metadata.file_path")
        .agg(F.count("*").alias("rows"), F.min("n").alias("low"), F.max("n").alias("high"))
        .orderBy("p", "low", "high")
        .collect()
    )
    assert sum(f.rows for f in files) == 30_000 and max(f.rows for f in files) <= 2_000
    for a, b in zip(files, files[1:]):
        assert a.p != b.p or a.high <= b.low
    tasks = {f.file_path.rsplit("part-", 1)[1].split("-")[0] for f in files if f.low <= 7 <= f.high}
    assert (len(tasks) > 2) == hot


def test_buckets_need_a_catalog(spark, rows, tmp_path):
    with pytest.raises(ValueError, match="catalog"):
        sinks.overwrite_bucketed(rows, str(tmp_path / "b"), ["p"], 2)


def test_layout_sorts_inside_files(spark, tmp_path):
    path = str(tmp_path / "sorted")
    frame = spark.range(1000).select(
        (F.col("id") % 3).cast("string").alias("p"), F.xxhash64("id").alias("n")
    )
    sinks.append_partitions(frame, path, ["p"], sort=["n"])
    files = [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".orc")]
    # Each value sits in one file here, not in one file per writing task.
    assert len(files) == 3
    for file in files:
        values = [r.n for r in spark.read.orc(file).collect()]
        assert values == sorted(values)


def test_layout_splits_a_dominant_value(spark, tmp_path):
    path = str(tmp_path / "hot")
    hot = F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(-1)
    frame = spark.range(0, 300_000, 1, 8).select(
        hot.cast("string").alias("p"), F.xxhash64("id").alias("n")
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "256k")
    try:
        sinks.append_partitions(frame, path, ["p"], sort=["n"])
    finally:
        spark.conf.set(setting, before)
    files = [f for f in os.listdir(f"{path}/p=-1") if f.endswith(".orc")]
    assert len(files) > 2
    assert read_table(spark, path).count() == 300_000


def test_typed_nulls_can_be_stored(spark, sf_dir, tmp_path):
    path = str(tmp_path / "clearing")
    sinks.overwrite(QUERIES["chargeback"](spark, sf_dir), path)
    assert dict(read_table(spark, path).dtypes)["abi_code"] == "string"


# ------------------------------------------------------------- incremental


def dates(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "d string")


def newer(source, target):
    number = incremental.text_date_number(F.col("d"))
    mark = None if target is None else incremental.high_water_mark(target, number)
    return sorted(r.d for r in incremental.newer_than(source, number, mark).collect())


def test_only_strictly_newer_rows(spark):
    source = dates(spark, "2020-01-01", "2020-01-02", "2019-12-31", "2020-13-01", None)
    assert newer(source, dates(spark, "2020-01-01", None)) == ["2020-01-02"]


def test_empty_or_missing_target_takes_all_dated_rows(spark):
    source = dates(spark, "2020-01-01", None, "junk")
    assert newer(source, dates(spark)) == newer(source, None) == ["2020-01-01"]


def test_slices(spark):
    frame = spark.sql(
        "select timestamp_ntz'2020-01-31 23:59:59' t, date'2020-01-31' d, "
        "'2020' year, 1 month, '31' day union all "
        "select timestamp_ntz'2020-02-01 00:00:00', date'2020-02-01', '2020', 2, '01'"
    )
    for column in ("t", "d"):
        assert day_slice(frame, column, "2020-01-31").count() == 1
    assert [r.month for r in ymd_partition(frame, "2020-02-01").collect()] == [2]


SPELLINGS = [
    "2024-01-05", "2024-1-5", "2024-01", "2024-1", "2024", " 2024-01-05", "2024-01-05 ", "02024-01-05",
    "+2024-01-05", "2024-01-05T10:00", "2024-01-05 junk", "2024-1-05 ", "2024 ", "2024-1 ", "2024-10-05",
    "2024-12", "2024-12-31", "2024-13-01", "2024-02-30", "2023-12-31", "2025", "2025-1-1", "2024-9-30",
    "\t2024-1-31", "-2024-01-05", "002024-12-1", "2024\x7f", "2024-1\x7f", "2024-11\x7f", "", "junk",
    "2024-011-01", "20240105", "2024-00-01", "2024-01-", "２024-01-05", None,
]


@pytest.mark.parametrize("months", [["202401"], ["202412"], ["202409", "202410", "202501"], ["202313"],
                                    ["bad"], [], [None], ["202402", None]])
def test_months_are_those_of_the_date(spark, months):
    """Ranges of text rule out no spelling that Spark reads as a date of the month."""
    frame = spark.createDataFrame([(s,) for s in SPELLINGS], "d string")
    month = F.date_format(F.col("d").try_cast("date"), "yyyyMM")
    expected = [r.d for r in frame.withColumn("m", month).collect() if r.m in months]
    found = frame.where(filters.in_months(F.col("d"), months))
    assert [r.d for r in found.collect()] == expected
    assert months in ([], ["bad"], ["202313"], ["202402", None]) or expected


def test_days_of_a_table(spark, tmp_path):
    path = str(tmp_path / "days")
    dates = ["2024-01-31", "2024-02-01", "2024-02-02"]
    rows = spark.createDataFrame([(i, *d.split("-")) for i, d in enumerate(dates)],
                                 "n int, year string, month string, day string")
    sinks.append_partitions(rows, path, ["year", "month", "day"])
    days = spark.createDataFrame([(dates[0],), (dates[2],), (dates[2],), (None,), ("2030-01-01",)],
                                 "d string").select(F.col("d").cast("date").alias("d"))
    for limit in (0, 2**62):
        found = ymd_days(read_table(spark, path), days, "d", limit=limit)
        assert sorted(r.n for r in found.collect()) == [0, 2]


# -------------------------------------------------------------------- jobs


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    """Every input view as a stored table."""
    base = tmp_path_factory.mktemp("tables")
    names = ["presentment_feed", "chargeback_feed", "issuers", "bins", "categories",
             "merchant_groups", "report_groups", "periods", "wallets", MESSAGES]
    paths = {n: str(base / n) for n in names}
    for name, path in paths.items():
        view(spark, sf_dir, name).write.orc(path)
    return paths


def shared(tables):
    return {
        "bins": tables["bins"],
        "categories": tables["categories"],
        "groups": tables["merchant_groups"],
    }


def test_clearing_and_report_jobs(spark, sf_dir, tables, tmp_path):
    presented, back, report = (str(tmp_path / n) for n in ("p", "c", "r"))

    def run_presentments(**options):
        jobs.presentment_job(
            spark, feed=tables["presentment_feed"], issuers=tables["issuers"],
            target=presented, **shared(tables), **options,
        )

    run_presentments()
    expected = QUERIES["presentment"](spark, sf_dir)
    assert spark_rows(read_table(spark, presented)) == spark_rows(expected)

    for _ in range(2):
        jobs.chargeback_job(
            spark, feed=tables["chargeback_feed"], clearing=presented, target=back,
            replace=True, salts=3, **shared(tables),
        )
    charged = read_table(spark, back, text=["transaction_date"])
    assert spark_rows(charged) == spark_rows(QUERIES["chargeback"](spark, sf_dir))

    def run_report(**options):
        jobs.report_job(
            spark, presented=presented, charged_back=back, issuers=tables["issuers"],
            report_groups=tables["report_groups"], periods=tables["periods"],
            wallets=tables["wallets"], target=report, **options,
        )

    assert not table_exists(spark, report)
    dated = QUERIES["fraud_report"](spark, sf_dir).where("month_of_report is not null")
    months = sorted({r[0] for r in dated.select("month_of_report").collect()})
    for some in (months[:3], months[1:], months[:1]):
        run_report(months=some)
    by_month = read_table(spark, report, text=["month_of_report"])
    assert spark_rows(by_month) == spark_rows(dated)
    report = str(tmp_path / "whole")
    run_report()
    whole = QUERIES["fraud_report"](spark, sf_dir)
    assert spark_rows(read_table(spark, report)) == spark_rows(whole)


def test_daily_jobs_may_run_again(spark, tables, tmp_path):
    """Presentments, chargebacks and messages by load day, a day of each loaded twice."""
    feed, back_feed, presented, back, trace = (
        str(tmp_path / n) for n in ("feed", "back-feed", "presented", "back", "trace")
    )
    day = F.when(F.col("l00032") < "0700", "02").otherwise("01")
    parts = {"year": F.lit("2024"), "month": F.lit("01"), "day": day}
    for name, path in (("presentment_feed", feed), ("chargeback_feed", back_feed)):
        spark.read.orc(tables[name]).withColumns(parts).write.partitionBy(*parts).orc(path)
    again = ("2024-01-01", "2024-01-02", "2024-01-01")
    for run_date in again:
        jobs.presentment_job(
            spark, feed=feed, issuers=tables["issuers"], target=presented, daily=True,
            run_date=run_date, load_column="load_date", **shared(tables),
        )
    for run_date in again:
        jobs.chargeback_job(
            spark, feed=back_feed, clearing=presented, target=back, daily=True,
            run_date=run_date, load_column="load_date", **shared(tables),
        )
    whole = [str(tmp_path / n) for n in ("whole", "whole-back")]
    once = {"feed": feed, "target": whole[0], "issuers": tables["issuers"]}
    jobs.presentment_job(spark, **once, **shared(tables))
    jobs.chargeback_job(spark, feed=back_feed, clearing=whole[0], target=whole[1], **shared(tables))
    for path, reference in zip((presented, back), whole):
        found = read_table(spark, path, S.CLEARING_COLUMNS, text=["transaction_date"])
        expected = read_table(spark, reference, S.CLEARING_COLUMNS, text=["transaction_date"])
        assert found.count() and spark_rows(found) == spark_rows(expected)

    messages = read_table(spark, tables[MESSAGES]).where(F.col("time_stamp") == MESSAGE_DAY)
    for _ in range(2):
        jobs.authorization_job(
            spark, messages=tables[MESSAGES], target=trace, run_date=MESSAGE_DAY,
            load_column="load_date", gather=True,
        )
    assert read_table(spark, trace).count() == messages.count() > 0
    with pytest.raises(ValueError, match="daily"):
        jobs.chargeback_job(
            spark, feed="f", clearing="c", bins="b", categories="m", groups="g",
            target="t", load_column="load_date",
        )


def test_a_full_chargeback_run_drops_vanished_dates(spark, tables, tmp_path):
    presented, back, feed = (str(tmp_path / n) for n in ("p", "b", "feed"))
    jobs.presentment_job(
        spark, feed=tables["presentment_feed"], issuers=tables["issuers"], target=presented,
        by_range=True, **shared(tables),
    )
    rows = spark.read.orc(tables["chargeback_feed"])
    for kept in ("true", "l00032 < '0400'"):
        rows.where(kept).write.mode("overwrite").orc(feed)
        jobs.chargeback_job(
            spark, feed=feed, clearing=presented, target=back, replace=True, **shared(tables)
        )
        expected = str(tmp_path / f"new-{len(kept)}")
        jobs.chargeback_job(spark, feed=feed, clearing=presented, target=expected, **shared(tables))
        text = {"columns": S.CLEARING_COLUMNS, "text": ["transaction_date"]}
        found = read_table(spark, back, **text)
        assert found.count() and spark_rows(found) == spark_rows(read_table(spark, expected, **text))


def test_totals_add_up_in_any_order_of_loads(spark, sf_dir, tables, tmp_path):
    """Chargebacks before, with and after their presentments; each load run again."""
    names = ("issuers", "report_groups", "periods", "wallets")
    lookups = {n: tables[n] for n in names}
    presented, back, totals, report = (str(tmp_path / n) for n in ("p", "c", "t", "r"))
    days = [f"2024-01-0{d}" for d in (1, 2, 3)]
    load = F.element_at(F.array(*map(F.lit, days)), (F.abs(F.hash("arn")) % 3 + 1).cast("int"))
    later = F.element_at(F.array(*map(F.lit, days)), (F.abs(F.hash("ticket")) % 3 + 1).cast("int"))
    QUERIES["presentment"](spark, sf_dir).withColumn("load_date", load).write.partitionBy(
        "load_date").orc(presented)
    backs = QUERIES["chargeback"](spark, sf_dir).withColumn("ticket", F.col("clearing_file_name"))
    backs.withColumn("load_date", later).drop("ticket").write.partitionBy("load_date").orc(back)
    for run_date in (*days, days[1], days[2]):
        jobs.totals_job(
            spark, presented=presented, charged_back=back, target=totals,
            run_date=run_date, load_column="load_date", **lookups,
        )
    jobs.merged_report_job(spark, totals=totals, target=report)
    expected = QUERIES["fraud_report"](spark, sf_dir)
    assert spark_rows(read_table(spark, report)) == spark_rows(expected)


def test_replacing_needs_the_whole_feed(spark):
    with pytest.raises(ValueError, match="whole feed"):
        jobs.chargeback_job(
            spark, feed="f", clearing="c", bins="b", categories="m", groups="g",
            target="t", daily=True, replace=True,
        )


def test_authorization_job(spark, sf_dir, tables, tmp_path):
    target = str(tmp_path / "trace")
    jobs.authorization_job(
        spark, messages=tables[MESSAGES], target=target, run_date=MESSAGE_DAY,
        elaboration_date=ELABORATION_DAY,
    )
    kept = read_table(spark, target).select(*S.AUTH_COLUMNS)
    expected = QUERIES["auth_trace_daily"](spark, sf_dir)
    # Messages without a date land in the default partition and come back NULL.
    assert spark_rows(
        kept.withColumn("Token_Date", F.col("Token_Date").cast("string"))
    ) == spark_rows(expected)


def test_jobs_work_on_catalog_tables(spark, tables):
    names = {"feed": "presentment_feed", "issuers": "issuers", "bins": "bins",
             "categories": "categories", "groups": "merchant_groups"}
    spark.sql("create database if not exists cards")
    try:
        for name in names.values():
            spark.read.orc(tables[name]).write.format("orc").saveAsTable(f"cards.{name}")
        sources = {k: f"cards.{v}" for k, v in names.items()}
        for _ in range(2):
            jobs.presentment_job(spark, target="cards.presented", **sources)
        assert spark.table("cards.presented").columns == S.CLEARING_COLUMNS
    finally:
        spark.sql("drop database cards cascade")


def test_presentments_by_day_of_import(spark, tables, tmp_path):
    """Late rows, and a December row imported in January, are loaded with their day."""
    feed, target = str(tmp_path / "feed"), str(tmp_path / "days")
    rows = spark.read.orc(tables["presentment_feed"]).withColumnRenamed("day", "import_day")
    part = F.when(F.col("l00032") < "0700", "02").otherwise("01")
    parts = {"year": F.lit("2024"), "month": F.lit("01"), "day": part}
    rows.withColumns(parts).write.partitionBy("year", "month", "day").orc(feed)
    options = {"feed": feed, "issuers": tables["issuers"], **shared(tables)}
    for run_date in ("2024-01-01", "2024-01-02"):
        jobs.presentment_job(spark, target=target, daily=True, run_date=run_date, **options)
    whole = str(tmp_path / "at-once")
    jobs.presentment_job(spark, target=whole, **options)
    found = read_table(spark, target)
    assert found.count() and spark_rows(found) == spark_rows(read_table(spark, whole))


def test_impossible_dates_by_path(spark, tmp_path):
    path = str(tmp_path / "dated")
    rows = [(1, "2020-01-02"), (2, "2020-02-03")]
    frame = spark.createDataFrame(rows, "n int, transaction_date string")
    frame.write.partitionBy("transaction_date").orc(path)
    stored = read_table(spark, path, text=["transaction_date"])
    other = spark.createDataFrame([(3, "2020-13-32")], "n int, transaction_date string")
    assert {tuple(r) for r in stored.unionByName(other).collect()} == {*rows, (3, "2020-13-32")}


@pytest.mark.parametrize("name", ["presentment_incremental", "presentment_loads"])
def test_loads_of_few_days_are_not_gathered(spark, sf_dir, monkeypatch, name):
    expected = spark_rows(QUERIES["presentment"](spark, sf_dir))
    monkeypatch.setattr(sinks.orc, "laid_out", None)
    found = QUERIES[name](spark, sf_dir)
    assert spark_rows(found.select(*S.CLEARING_COLUMNS)) == expected


@pytest.mark.parametrize(
    "name", ["clearing_stored_by_date", "report_incremental", "report_months", "report_merged"]
)
def test_chargebacks_search_the_stored_presentments(spark, sf_dir, monkeypatch, name):
    """Presentments are derived once, also where chargebacks need them."""
    built, build = [], clearing.presentments

    def counted(*tables, **options):
        built.append(1)
        return build(*tables, **options)

    monkeypatch.setattr(clearing, "presentments", counted)
    assert QUERIES[name](spark, sf_dir).count() and len(built) == 1


def test_few_partition_values_leave_the_setting(spark, rows, tmp_path):
    """Rows that are not gathered are written in full, and the session is as before."""
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    many = spark.range(300).select(F.col("id").alias("n"), (F.col("id") % 30).alias("p"))
    path = str(tmp_path / "many")
    sinks.append_partitions(many, path, ["p"], gather=False)
    assert read_table(spark, path).select("n", "p").distinct().count() == 300
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
