"""Times the library against straightforward forms of the same work.

Prints one JSON line per comparison. Same session, same stored tables, same
best-of-runs rule as ``bench.py``.
"""

from __future__ import annotations

import json
import os
import sys

from pyspark.sql import functions as F

from bench import best_of, session
from cardlake import functions as fn
from cardlake import schemas as S
from cardlake.plans import authorization, report
from cardlake.sinks import overwrite
from fixtures.adapters import MESSAGES, store_views, view
from fixtures.queries import QUERIES
from fixtures.scratch import scratch_path
from tests import literal


def native_decoders(feed):
    return feed.select(
        fn.strip(F.col("l00019")).alias("funding_pan"),
        fn.arn().alias("arn"),
        fn.strip(F.col("l00328")).alias("trace_id"),
        fn.token_flag(F.col("l00255")).alias("mdes_flag"),
        fn.token_pan(F.col("l00255")).alias("dpan"),
        fn.currency_exponent(F.col("l00034")).alias("p_exp_rcnc"),
        fn.remote_flag(F.col("l00074")).alias("remote_trx_flag"),
        fn.contactless_flag(F.col("l00054")).alias("nfc_technology_flag"),
        fn.fraud_flag(F.col("l00046")).alias("fraud_flag"),
    )


def with_dominant_key(rows):
    """The clearing rows, a third of each type under the same match keys."""
    hot = F.pmod(F.xxhash64("arn", "v_rcnc"), F.lit(3)) == 0
    return rows.withColumns(
        {k: F.when(hot, F.lit("1")).otherwise(F.col(k)) for k in S.MATCH_KEYS}
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    store_views(spark, sf_dir, scratch_path(spark, "forms"))
    path = scratch_path(spark, "clearing")
    overwrite(QUERIES["clearing_union"](spark, sf_dir), path)
    skewed = scratch_path(spark, "skewed")
    overwrite(with_dominant_key(spark.read.orc(path)), skewed)

    def table(name):
        return view(spark, sf_dir, name)

    def table_of(clearing):
        return spark.read.orc(clearing)

    def report_tables(clearing=path):
        names = ("issuers", "report_groups", "periods", "wallets")
        return [table_of(clearing), *map(table, names)]

    tags = [n for _, t in S.TAGGED_ELEMENTS.values() for n in t.values()]
    simple = list(S.SIMPLE_ELEMENTS.values())
    forms = {
        "JSON pivot": (
            lambda: literal.exploded_pivot(table(MESSAGES)).select(*tags),
            lambda: authorization.message_fields(table(MESSAGES)).select(*tags),
        ),
        "JSON extraction": (
            lambda: literal.repeated_parse(table(MESSAGES)).select(*simple),
            lambda: authorization.parse_messages(table(MESSAGES)).select(*simple),
        ),
        "presentment decode": (
            lambda: literal.python_decoders(table("presentment_feed")),
            lambda: native_decoders(table("presentment_feed")),
        ),
        "fraud report": (
            lambda: literal.literal_report(*report_tables()),
            lambda: report.fraud_report(table_of(path), *report_tables()),
        ),
        "fraud report, dominant key": (
            lambda: literal.literal_report(*report_tables(skewed)),
            lambda: report.fraud_report(table_of(skewed), *report_tables(skewed)),
        ),
    }
    for name in sys.argv[1:] or forms:
        pair = forms[name]
        seconds = [
            best_of(lambda b=b: b().write.format("noop").mode("overwrite").save(), runs)
            for b in pair
        ]
        print(
            json.dumps({"query": name, "literal": seconds[0], "native": seconds[1]}),
            flush=True,
        )
    spark.stop()


if __name__ == "__main__":
    main()
