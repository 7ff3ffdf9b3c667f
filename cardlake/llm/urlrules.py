"""URL filter by association rules.

Listed rules decide the URLs they fit. Their verdicts label those URLs; Spark's
FP-growth mines token combinations that go with a verdict, and the mined rules judge the
other URLs through an inverted index. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.llm.shared import stored

#: (host and path prefix, verdict). Fixed values.
LISTED = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.8
#: Verdict where no mined rule fits.
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #``, A-Z in lower case; else empty."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(
        F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")
    )


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(host: Column, path: Column, listed: list[tuple[str, str]] = LISTED) -> Column:
    """The longest listed rule that fits host or a domain above it, and path; else null."""
    fitting = F.lit(None).cast("string")
    for rule, _ in sorted(listed, key=lambda r: len(r[0])):
        domain, slash, start = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + start)
        fitting = F.when(fits, rule).otherwise(fitting)
    return fitting


def listed_verdict(rule: Column, listed: list[tuple[str, str]] = LISTED) -> Column:
    return F.coalesce(*[F.when(rule == r, v) for r, v in listed])


def tokens_of(host: Column, path: Column) -> Column:
    """Distinct tokens: parts of host labels, path parts, runs of digits as ``#``."""

    def parts(text: Column, mark: str, cut: str) -> Column:
        plain = F.regexp_replace(F.lower(text), "[0-9]+", "#")
        found = F.filter(F.split(plain, cut), lambda t: t != "")
        return F.transform(found, lambda t: F.concat(F.lit(mark), t))

    return F.array_distinct(
        F.concat(parts(host, "h:", r"[.\-_]"), parts(path, "p:", r"[/.\-_]"))
    )


def token_classes(labelled: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """Frequent tokens and the class of each: ``token``, ``class``.

    Tokens that occur in the same rows say the same, so they are one item, named by the
    first of them; otherwise every subset of the tokens of a common template would be
    an itemset of its own. Rows are compared by their number and two sums of 64-bit
    hashes. A token in less than ``min_support`` of the rows takes no part, so the table is
    bounded by tokens a URL over ``min_support``, whatever the number of rows.
    """
    n = labelled.count()
    row = ["tokens", "verdict"]
    tokens = labelled.select(
        F.explode("tokens").alias("token"),
        F.xxhash64(*row).cast("decimal(20,0)").alias("one"),
        F.xxhash64(F.lit("other"), *row).cast("decimal(20,0)").alias("other"),
    )
    alike = (
        tokens.groupBy("token")
        .agg(F.count("*").alias("n"), F.sum("one").alias("one"), F.sum("other").alias("other"))
        .where(F.col("n") >= min_support * n)
        .groupBy("n", "one", "other")
        .agg(F.min("token").alias("class"), F.collect_set("token").alias("members"))
    )
    return stored(alike.select(F.explode("members").alias("token"), "class"), "token-classes")


def in_classes(rows: DataFrame, classes: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and ``classes``, those of the row's frequent tokens, each once.

    ``keep`` must tell rows apart.
    """
    found = rows.select(*keep, F.explode_outer("tokens").alias("token"))
    return (
        found.join(classes, "token", "left")
        .groupBy(*keep)
        .agg(F.collect_set("class").alias("classes"))
    )


def mined_rules(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """Rules ``tokens -> verdict`` from rows of (tokens, verdict).

    Columns: tokens, verdict, confidence, support, key (the rarest token). A rule is
    dropped if one with fewer of its tokens is as confident of the same verdict. Tokens
    that go together in all rows should be one; see ``token_classes``.
    """
    items = labelled.select(
        F.concat("tokens", F.array(F.concat(F.lit("y:"), "verdict"))).alias("items")
    )
    model = FPGrowth(
        itemsCol="items", minSupport=min_support, minConfidence=min_confidence
    ).fit(items)
    single = model.freqItemsets.where(F.size("items") == 1).select(
        F.col("items")[0].alias("token"), "freq"
    )
    rules = stored(
        model.associationRules.where(
            (F.size("consequent") == 1)
            & F.col("consequent")[0].startswith("y:")
            & ~F.exists("antecedent", lambda t: t.startswith("y:"))
        ).select(
            F.array_sort("antecedent").alias("tokens"),
            F.substring(F.col("consequent")[0], 3, 2**31 - 1).alias("verdict"),
            "confidence",
            "support",
        ),
        "rules",
    )
    # a rule meets only rules that have its key among their tokens: an equi-join
    token_of = rules.select("tokens", "verdict", F.explode("tokens").alias("token"))
    rarest = (
        token_of.join(single, "token")
        .groupBy("tokens", "verdict")
        .agg(F.min_by("token", F.struct("freq", "token")).alias("key"))
    )
    keyed = stored(rules.join(rarest, ["tokens", "verdict"]), "keyed-rules")
    narrow = keyed.select(
        F.col("tokens").alias("__few"), F.col("verdict").alias("__v"),
        F.col("confidence").alias("__c"), F.col("key").alias("__k"),
    )
    wide = keyed.withColumn("__t", F.explode("tokens"))
    beaten = (
        wide.join(
            narrow,
            (F.col("__t") == F.col("__k"))
            & (F.col("verdict") == F.col("__v"))
            & (F.size("__few") < F.size("tokens"))
            & (F.col("__c") >= F.col("confidence"))
            & (F.size(F.array_except("__few", "tokens")) == 0),
        )
        .select("tokens", "verdict")
        .distinct()
    )
    return stored(keyed.join(beaten, ["tokens", "verdict"], "left_anti"), "kept-rules")


def mined_verdicts(urls: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """host, path, verdict, confidence of every (host, path) that a rule fits.

    The index holds each rule under its rarest class; a URL looks up the classes of its
    tokens and keeps rules whose classes it all has. The most confident one wins, then
    the best supported, then the one with more classes, then ``block``.
    """
    rows = urls.select("host", "path", tokens_of(F.col("host"), F.col("path")).alias("tokens"))
    asked = in_classes(rows, classes, "host", "path").select(
        "host", "path", F.col("classes").alias("__have"), F.explode("classes").alias("key")
    )
    best = F.max(
        F.struct("confidence", "support", F.size("tokens").alias("n"), "verdict")
    ).alias("best")
    return (
        asked.join(rules, "key")
        .where(F.size(F.array_except("tokens", "__have")) == 0)
        .groupBy("host", "path")
        .agg(best)
        .select("host", "path", "best.verdict", "best.confidence")
    )


def filtered_urls(
    pages: DataFrame,
    listed: list[tuple[str, str]] = LISTED,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    url_col: str = "url",
) -> DataFrame:
    """All rows and columns of ``pages`` with host, path, rule, verdict, confidence.

    Columns of these names in ``pages`` are replaced. ``confidence`` is null where a
    listed rule or the default decided. Null URLs, and URLs without ``://``, have an empty
    host and path, no tokens, and the default verdict. Repeated rows are judged alike. Without
    labelled URLs every undecided URL gets the default.

    URLs are judged once per distinct host and path, so a frequent one is a single row;
    verdicts come back by a join of two plain tables that adaptive execution splits
    where a URL is hot.
    """
    new = ["host", "path", "rule", "verdict", "confidence"]
    kept = [c for c in pages.columns if c not in new]
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    parsed = pages.select(*kept, host.alias("host"), path.alias("path"))
    urls = parsed.groupBy("host", "path").agg(F.count("*").alias("n"))
    urls = stored(
        urls.withColumn("rule", listed_rule(F.col("host"), F.col("path"), listed)).withColumn(
            "verdict", listed_verdict(F.col("rule"), listed)
        ),
        "urls",
    )
    # a URL counts once in mining, whatever its number of copies
    labelled = urls.where("verdict is not null").select(
        "host", "path", tokens_of(F.col("host"), F.col("path")).alias("tokens"), "verdict"
    )
    classes = token_classes(labelled, min_support)
    items = in_classes(labelled, classes, "host", "path", "verdict")
    rules = mined_rules(
        items.select(F.col("classes").alias("tokens"), "verdict"), min_support, min_confidence
    )
    mined = mined_verdicts(urls.where("verdict is null"), rules, classes)
    judged = stored(
        urls.where("verdict is null")
        .select("host", "path")
        .join(mined, ["host", "path"], "left")
        .select(
            F.col("host").alias("__h"), F.col("path").alias("__p"),
            F.coalesce("verdict", F.lit(DEFAULT)).alias("__verdict"),
            F.col("confidence").alias("__confidence"),
        ),
        "judged",
    )
    rule = listed_rule(F.col("host"), F.col("path"), listed)
    return parsed.join(
        judged, (F.col("host") == F.col("__h")) & (F.col("path") == F.col("__p")), "left"
    ).select(
        *kept,
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(listed_verdict(rule, listed), "__verdict").alias("verdict"),
        F.col("__confidence").alias("confidence"),
    )
