"""Joins with one dominant key, on both paths, against brute force."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from cardlake import schemas as S
from cardlake.operators import joins, keyfilter, lookups, matching
from cardlake.plans import fraud_report
from fixtures.adapters import view
from fixtures.queries import QUERIES
from tests.compare import spark_rows
from tests.test_clearing import charged_back, presented


def skewed(spark, rows=3000):
    """A third of the rows under key 'hot', copies of one row among them."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
    return spark.range(0, rows, 1, 6).select(
        key.otherwise((F.col("id") % 40).cast("string")).alias("k"),
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("v"),
    )


@pytest.fixture
def lookup(spark):
    rows = [("hot", 1), ("hot", 2), ("7", 3), (None, 4), ("absent", 5)]
    return spark.createDataFrame(rows, "k2 string, w int")


def brute_force(facts, lookup, how):
    right = [tuple(r) for r in lookup.collect()]
    out = Counter()
    for k, v in facts.collect():
        hits = [w for k2, w in right if k is not None and k == k2]
        for w in hits or ([None] if how == "left" else []):
            out[(k, v, w)] += 1
    return out


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("salts", [1, 2, 7])
@pytest.mark.parametrize("spread", [(), ("v",)])
def test_salted_join(spark, lookup, how, salts, spread):
    facts = skewed(spark)
    joined = joins.salted_join(
        facts, lookup.withColumnRenamed("k2", "k"), ["k"], how, salts=salts, spread=spread
    )
    assert joined.columns == ["k", "v", "w"]
    assert spark_rows(joined)[1] == brute_force(facts, lookup, how)


def test_salt_splits_the_dominant_key(spark, lookup):
    """No salt keeps more than a fraction of the hot rows."""
    salts = 8
    facts = skewed(spark).where("k = 'hot'")
    row_salt = F.spark_partition_id() + F.xxhash64("v") % salts
    sizes = [r[1] for r in facts.groupBy(F.pmod(row_salt, F.lit(salts))).count().collect()]
    assert len(sizes) > salts // 2 and max(sizes) < sum(sizes) / 3


@pytest.mark.parametrize("limit", [0, 2**62])
def test_lookup_join_on_either_path(spark, lookup, limit):
    facts = skewed(spark)
    # A size the optimizer knows, unlike that of a Python list.
    known = lookup.join(spark.range(1), F.lit(True)).select("k2", "w")
    joined = joins.lookup_join(facts, F.col("k"), known, F.col("k2"), limit=limit)
    assert spark_rows(joined.select("k", "v", "w"))[1] == brute_force(
        facts, lookup, "inner"
    )


def test_only_small_tables_are_broadcast(spark, sf_dir):
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    size = joins.estimated_bytes(nation)
    unknown = spark.createDataFrame([("a",)], "k string")
    assert 0 < size < joins.BROADCAST_LIMIT < joins.estimated_bytes(unknown)

    def plan(limit):
        joined = joins.lookup_join(
            lines, F.col("l_suppkey"), nation, F.col("n_nationkey"), limit=limit
        )
        return joined._jdf.queryExecution().logical().toString()

    assert "strategy=broadcast" in plan(size * 10)
    assert "strategy=broadcast" not in plan(size // 10)


def test_salts_change_no_result(spark):
    token = {"l00255": "D1"}
    # Half of all presentments share one ARN and all match keys.
    changes = [token] * 12 + [{**token, "l00027": str(i)} for i in range(2, 14)]
    original = presented(spark, *changes).repartition(5)
    back = [{}, {}, {"l00027": "3"}, {"l00046": "2502"}]
    plain = charged_back(spark, original, *back)
    salted = charged_back(spark, original, *back, salts=4)
    assert spark_rows(plain) == spark_rows(salted)
    assert plain.count() == 12 * 3 + 1

    # So do presentments stored in parts, which chargebacks are copied to.
    parts = matching.with_arn_part(original, 5)
    assert parts.select("arn_part").distinct().count() > 1
    assert spark_rows(charged_back(spark, parts, *back, arn_parts=5)) == spark_rows(plain)


def test_copies_are_counted_not_paired(spark):
    """n copies of a presentment meet m copies of a chargeback in one row, not n*m."""
    keys = [("p", "a", "t", "100")]
    copies = spark.createDataFrame(keys * 50, S.strings(*S.MATCH_KEYS))
    fp = copies.withColumn("transaction_date", F.lit("x"))
    (counted,) = matching.count_fraud(fp, copies, ["transaction_date"]).collect()
    assert (counted.n_presented, counted.fraud_count) == (50, 50)
    pairs = matching.match_fraud(fp, copies)
    assert pairs.count() == 2500
    (pair,) = matching.counted_pairs(fp, copies, ["transaction_date"], ["arn"]).collect()
    assert tuple(pair) == ("x", "a", 2500)


def keyed(spark, *rows):
    return spark.createDataFrame(list(rows), S.strings(*S.MATCH_KEYS))


@pytest.mark.parametrize("words", [1, 16, keyfilter.WORDS])
def test_key_filter_lets_every_key_pass(spark, words):
    """However full it is; a filter of one word is full, the largest one is not."""
    rows = [(f"p{i}", "a", None if i % 7 == 0 else "t", "1") for i in range(500)]
    some = [r for i, r in enumerate(rows) if i % 5 == 0]
    known = keyfilter.key_filter(keyed(spark, *some), S.MATCH_KEYS, words)
    assert known.count() <= words
    marked = keyfilter.with_possible(keyed(spark, *rows), known, S.MATCH_KEYS, "may", words)
    found = {r.funding_pan: r.may for r in marked.collect()}
    assert len(found) == 500
    matching_keys = {r[0] for r in some if r[2]}
    passed = {p for p, may in found.items() if may}
    assert matching_keys <= passed and not passed & {r[0] for r in rows if not r[2]}
    assert (passed == matching_keys) == (words == keyfilter.WORDS)


def test_key_filter_of_nothing(spark):
    known = keyfilter.key_filter(keyed(spark), S.MATCH_KEYS)
    marked = keyfilter.with_possible(keyed(spark, ("p", "a", "t", "1")), known, S.MATCH_KEYS, "may")
    assert [r.may for r in marked.collect()] == [False]
    with pytest.raises(ValueError, match="power of two"):
        keyfilter.key_filter(keyed(spark), S.MATCH_KEYS, 1000)


@pytest.mark.parametrize("words", [1, 64])
def test_a_full_filter_changes_no_report(spark, sf_dir, words):
    clearing = QUERIES["clearing_union"](spark, sf_dir)
    tables = [view(spark, sf_dir, n) for n in ("issuers", "report_groups", "periods", "wallets")]
    assert spark_rows(fraud_report(clearing, clearing, *tables, words=words)) == spark_rows(
        fraud_report(clearing, clearing, *tables)
    )


PERIODS = [
    ("hot", "2020-01-15", "2020-03-10"), ("hot", "2020-03-10", "2020-03-10"),
    ("hot", "2020-02-01", "9999-12-31"), ("hot", "0001-01-01", "2020-01-20"),
    ("hot", "2020-05", "2020-13-99"), ("hot", "2020-04-01", None), ("hot", None, "2020-04-01"),
    ("hot", "2020-06-30", "2020-06-01"), ("cold", "", "~"), ("none", "2020-01-01", "2020-12-31"),
    ("hot", "2020-01-15", "2020-03-10"),
]
DATES = [
    "2020-01-15", "2020-01-14", "2020-03-10", "2020-03-11", "2020-02", "2020-2-3", "", "x",
    "2020-13-32", "2020-05-01", "2020-06-15", "9999-12-31", "0001-01-01", " 2020-03-01", None,
    "2020-03-10 ", "２０２０-01-01",
]


def test_month_bins_equal_the_plain_join(spark):
    rows = [(f"{i}-{d}", i, d) for i in ("hot", "cold", "other") for d in DATES] * 2
    fp = spark.createDataFrame(rows, "arn string, issuer_code string, transaction_date string")
    own = "issuer_code string, start_attivation string, end_attivation string"
    periods = spark.createDataFrame(PERIODS, own)
    expected = Counter(
        (arn, issuer, date)
        for arn, issuer, date in rows
        for who, start, end in PERIODS
        if issuer == who and None not in (date, start, end) and start <= date <= end
    )
    for limit in (0, 2**62):
        found = lookups.within_validity(fp, periods, limit=limit)
        assert Counter(map(tuple, found.collect())) == expected


def test_month_bins_keep_a_hot_issuer_from_all_its_periods(spark):
    """Two years of rows and 24 periods of a month each: a row meets one, not 24."""
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 720).cast("int"))
    fp = spark.range(7200).select(
        F.lit("hot").alias("issuer_code"), day.cast("string").alias("transaction_date")
    )
    month = F.add_months(F.lit("2020-01-01").cast("date"), F.col("id").cast("int"))
    own = spark.range(24).select(
        F.lit("hot").alias("_issuer"), month.cast("string").alias("_start"),
        F.last_day(month).cast("string").alias("_end"),
    )
    binned, rows = lookups.in_month_bins(fp, own)
    assert binned.join(rows, "_bin").count() == 7200
    assert binned.select("_bin").distinct().count() == 24
    periods = own.selectExpr("_issuer issuer_code", "_start start_attivation", "_end end_attivation")
    assert lookups.within_validity(fp, periods, limit=0).count() == 7200


def test_month_bins_need_no_look_at_the_presentments(spark):
    """They are read once; months that share a bin are told apart by the dates."""
    dates = [f"{y}-{m}-15" for y in ("1980", "2000", "2020", "2040") for m in ("00", "01", "12", "13")]
    rows = [(d, "hot", d) for d in dates]
    fp = spark.createDataFrame(rows, "arn string, issuer_code string, transaction_date string")
    own = [
        ("2000-01-01", "2000-12-31"), ("2000-01-01", "9999-12-31"), ("1980-12-16", "2020-01-14"),
        ("1999-13-01", "2000-00-20"), ("2000-12-20", "2000-13-20"), ("odd", "~"), ("0", "2020-01-15"),
    ]
    periods = spark.createDataFrame(
        [("hot", *p) for p in own], "issuer_code string, start_attivation string, end_attivation string"
    )
    joined = lookups.within_validity(fp, periods, limit=0)
    expected = Counter((d, "hot", d) for d in dates for s, e in own if s <= d <= e)
    assert Counter(map(tuple, joined.collect())) == expected
    assert "scalar-subquery" not in joined._jdf.queryExecution().optimizedPlan().toString()
    named = periods.selectExpr("issuer_code _issuer", "start_attivation _start", "end_attivation _end")
    _, bins = lookups.in_month_bins(fp, named)
    assert bins.count() == bins.distinct().count()


def test_stale_statistics_force_no_broadcast(spark):
    """Files another writer added count, whatever the catalog still says."""
    spark.sql("create database if not exists stale")
    try:
        spark.range(10).selectExpr("cast(id as string) k2", "id w").write.format(
            "parquet"
        ).saveAsTable("stale.lookup")
        spark.sql("analyze table stale.lookup compute statistics")
        folder = spark.table("stale.lookup").inputFiles()[0].rsplit("/", 1)[0]
        limit = 4 * joins.estimated_bytes(spark.table("stale.lookup"))
        spark.range(200_000).selectExpr(
            "cast(id as string) k2", "xxhash64(id) w"
        ).write.mode("append").parquet(folder)
        spark.catalog.refreshTable("stale.lookup")
        lookup = spark.table("stale.lookup")
        assert joins.estimated_bytes(lookup) <= limit < joins.stored_bytes(lookup)
        assert not joins.surely_within(lookup, limit)
        joined = joins.lookup_join(
            skewed(spark), F.col("k"), lookup, F.col("k2"), limit=limit
        )
        assert "strategy=broadcast" not in joined._jdf.queryExecution().logical().toString()
    finally:
        spark.sql("drop database stale cascade")
