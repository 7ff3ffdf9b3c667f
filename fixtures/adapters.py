"""Card-shaped views over the test tables.

The tables hold orders and lines, not card messages. Each view below derives a
card table from them with expressions both Spark SQL and DuckDB understand, so
a query and its SQL check start from the same rows: ``view`` builds the Spark
frame, ``ctes`` the text for the check. Every view covers its whole table.

Only attributes are made up here (codes, markers, missing values); they vary
with quantity, tax, line number and so on to reach every branch of the library.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake import schemas as S


def text(expression: str) -> str:
    return f"cast({expression} as string)"


def _named(columns: dict[str, str], quote: str = '"') -> list[str]:
    return [f"{e} as {quote}{c}{quote}" for c, e in columns.items()]


@dataclass(frozen=True)
class Part:
    """One SELECT: table, output columns, optional row condition."""

    table: str
    columns: dict[str, str]
    where: str | None = None
    distinct: bool = False
    # Columns computed first, for several of the output columns to use.
    shared: dict[str, str] = field(default_factory=dict)

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = spark.read.parquet(f"{sf_dir}/{self.table}.parquet")
        if self.where:
            rows = rows.where(self.where)
        if self.shared:
            rows = rows.selectExpr("*", *_named(self.shared, "`"))
        rows = rows.selectExpr(*_named(self.columns, "`"))
        return rows.distinct() if self.distinct else rows

    def sql(self) -> str:
        source = self.table + (f" where {self.where}" if self.where else "")
        if self.shared:
            source = f"(select *, {', '.join(_named(self.shared))} from {source}) s"
        columns = ", ".join(_named(self.columns))
        return f"select {'distinct ' if self.distinct else ''}{columns} from {source}"


# Never NULL, which keeps the generated code of everything built on them short.
_LINE = {
    "ship_day": "coalesce(cast(cast(l_shipdate as date) as string), '')",
    "order_text": "coalesce(cast(l_orderkey as string), '')",
    "part_text": "coalesce(cast(l_partkey as string), '')",
    "supplier_text": "coalesce(cast(l_suppkey as string), '')",
    "line_text": "coalesce(cast(l_linenumber as string), '')",
    "nation_text": "coalesce(cast(l_suppkey % 25 as string), '')",
    "line": "coalesce(l_linenumber, 0)",
    "quantity": "coalesce(l_quantity, 0)",
    "tax": "coalesce(l_tax, 0)",
    "discount": "coalesce(l_discount, 0)",
    "returned": "coalesce(l_returnflag, '')",
    "status": "coalesce(l_linestatus, '')",
}
_MONTH_DAY = "substr(ship_day, 6, 2) || substr(ship_day, 9, 2)"
_CENTS = text("cast(round(l_extendedprice * 100) as bigint)")

# ---------------------------------------------------------------- clearing

_FEED = {
    # Issuers 25 and 26 are not registered.
    "l00004": text("l_suppkey % 27"),
    # Every line is presented, but for a few with a foreign transaction code.
    "l00016": "case when status = 'O' and line = 3 then '25' "
    "when returned = 'A' then '05' when returned = 'N' then '06' "
    "else '07' end",
    # Line 7 has a short PAN, line 6 sometimes an unreadable one; the rest
    # carry trailing blanks.
    "l00019": "case when line = 7 then '40000' || nation_text "
    "when line = 6 and tax < 0.01 then '4012 88812345678' "
    "else '4' || lpad(supplier_text, 7, '0') || order_text || '  ' end",
    "l00022": "status",
    # The ARN names a line of an order; part 4 is missing at quantity 4.
    "l00026": "order_text",
    "l00027": "'-'",
    "l00028": "line_text",
    "l00029": "case when quantity = 4 then null else part_text end",
    # A trailing blank keeps line 5 from matching by its ARN as delivered.
    "l00030": "case when line = 5 then '-3 ' else '-3' end",
    # Missing at quantity 6, an impossible month at quantity 7 of line 2.
    "l00032": "case when quantity = 6 then null when quantity = 7 and "
    f"line = 2 then '1332' else {_MONTH_DAY} end",
    "l00033": _CENTS,
    "l00034": "case when discount < 0.05 then '978' else '840' end",
    "l00037": "supplier_text",
    "l00038": "nation_text",
    "l00039": "nation_text",
    # Categories 25 to 29 are unknown.
    "l00040": text("l_partkey % 30"),
    "l00042": "status",
    "l00045": "case when quantity < 45 then '1' else '0' end",
    "l00046": "case line when 1 then '4837' when 2 then '4840' "
    "when 3 then '4871' else '2502' end",
    "l00054": "case when tax < 0.03 then '07' else '05' end",
    "l00062": text("line % 3"),
    "l00071": "supplier_text",
    "l00072": "part_text",
    "l00074": "line_text",
    "l00196": "case when quantity = 2 then null when line = 2 then '50110030274' "
    "when line = 3 then 'UNKNOWN' else '50120834693' end",
    "l00255": "case when quantity = 3 then null when line = 4 then "
    "'ALL SPACE' when line = 6 then 'LOW-VALUE' when line = 7 "
    "then 'ZEROE' else 'D' || order_text end",
    "l00328": "' T' || order_text || ' '",
    "circuito": "'VI' || status",
    "ticket": "line_text",
    "import_timestamp": "ship_day",
    "day": "case when quantity = 1 then 'day' when quantity = 5 then null "
    "else status end",
}

# Returned lines are charged back, some of them a second time; the other lines
# stay in the feed with a presentment code.
_FIRST_CHARGEBACK = _FEED | {
    "l00016": "case when returned <> 'R' then '05' when status = 'F' "
    "then '15' else '16' end",
}
_SECOND_CHARGEBACK = _FEED | {"l00016": "'17'", "ticket": "'2'"}

# ---------------------------------------------------------- authorization

# Shape of the sub-field arrays: absent at quantity 4, empty at quantity 3; the
# whole message is cut short at quantity 5.
_SHAPE = (
    "case when quantity = 5 then 'broken' when quantity = 4 then 'absent' "
    "when quantity = 3 then 'empty' else 'full' end"
)

_ELEMENTS = {
    0: "'0100'",
    2: "'4' || lpad(supplier_text, 15, '0')",
    3: "'00' || returned",
    4: _CENTS,
    6: f"case when discount < 0.05 then {_CENTS} end",
    7: f"case when quantity = 2 then null else {_MONTH_DAY} || '101530' end",
    11: "line_text",
    14: "substr(ship_day, 3, 2) || substr(ship_day, 6, 2)",
    15: _MONTH_DAY,
    18: text("l_partkey % 30"),
    22: "'0' || status",
    32: "supplier_text",
    37: "order_text",
    39: "returned",
    42: "'C' || part_text",
    43: "'SHOP \"' || supplier_text || '\"'",
    49: "'978'",
    51: "case when discount < 0.05 then '978' else '840' end",
}

# (element, tag) -> value. Tag 05 occurs twice, tag 99 is not wanted.
_TAGS = {
    (123, "01"): "'4' || lpad(order_text, 15, '0')",
    (123, "03"): "'5012083469' || line_text",
    (123, "05"): "part_text",
    (123, "05b"): "supplier_text",
    (123, "06"): "substr(ship_day, 3, 2) || '12'",
    (123, "07"): "case when tax < 0.03 then '01' end",
    (123, "08"): "status",
    (123, "99"): "'unused'",
    (125, "01"): text("line % 3"),
    (125, "03"): "'dev-' || supplier_text",
    (63, "1"): "'N' || order_text",
    (63, "3"): "returned",
}


def tag_column(element: int, tag: str) -> str:
    return f"t{element}_{tag}"


_MESSAGE_FIELDS = {
    "time_stamp": "substr(ship_day, 1, 4) || '-01-01'",
    "shape": _SHAPE,
    # Quantity 1 has no date in its id.
    "id": "case when quantity = 1 then 'M no date' else 'M ' || "
    "substr(ship_day, 3, 8) || ' ' || order_text end",
    **{f"e{n}": e for n, e in _ELEMENTS.items()},
    **{tag_column(*k): e for k, e in _TAGS.items()},
}

# ------------------------------------------------------------- look-ups

VIEWS = {
    "presentment_feed": [Part("lineitem", _FEED, shared=_LINE)],
    "chargeback_feed": [
        Part("lineitem", _FIRST_CHARGEBACK, shared=_LINE),
        Part(
            "lineitem",
            _SECOND_CHARGEBACK,
            where="l_returnflag = 'R' and l_tax >= 0.06",
            shared=_LINE,
        ),
    ],
    "message_fields": [Part("lineitem", _MESSAGE_FIELDS, shared=_LINE)],
    "issuers": [
        Part(
            "nation",
            {
                "issuer_code": text("n_nationkey"),
                "issuer_name": "n_name",
                "group_code": text("n_regionkey"),
            },
        ),
    ],
    # BINs of suppliers in credit, a second card type for the best of them,
    # an unreadable BIN for the rest, and the short BINs.
    "bins": [
        Part(
            "supplier",
            {
                "c_pan_visa": "case when s_acctbal < 0 then 'N/A' else '4' || "
                f"lpad({text('s_suppkey')}, 7, '0') end",
                "c_tp_addbt": "'C'",
            },
            distinct=True,
        ),
        Part(
            "supplier",
            {
                "c_pan_visa": f"'4' || lpad({text('s_suppkey')}, 7, '0')",
                "c_tp_addbt": "'P'",
            },
            where="s_acctbal > 8000",
            distinct=True,
        ),
        Part(
            "nation",
            {
                "c_pan_visa": f"rpad('40000' || {text('n_nationkey')}, 8, '0')",
                "c_tp_addbt": "'D'",
            },
        ),
    ],
    "categories": [
        Part(
            "nation",
            {
                "mc_code": text("n_nationkey"),
                "visa_mc_group_code": f"'V' || {text('n_regionkey')}",
                "mastercard_mc_group_code": f"'M' || {text('n_regionkey')}",
                "mc_description": "n_name",
            },
        ),
    ],
    "merchant_groups": [
        Part(
            "region",
            {
                "mc_group_code": f"'V' || {text('r_regionkey')}",
                "circuit": "case when r_regionkey < 4 then 'VISA' else 'MAST' end",
            },
        ),
        Part(
            "region",
            {
                "mc_group_code": f"'M' || {text('r_regionkey')}",
                "circuit": "case when r_regionkey < 3 then 'VISA' else 'MAST' end",
            },
        ),
    ],
    "report_groups": [
        Part(
            "region",
            {
                "group_code": text("r_regionkey"),
                "id": "case when r_regionkey = 1 then 'GP002' else 'GP001' end",
            },
        ),
    ],
    "wallets": [
        Part(
            "region",
            {
                "token_requestor_id": "case when r_regionkey = 0 then "
                "50120834693 else 50110030273 + r_regionkey end",
                "token_requestor_name": "case when r_regionkey = 0 then "
                "'Google Pay' else 'Wallet ' || r_name end",
            },
        ),
    ],
    # Issuers of two regions have a second, overlapping period.
    "periods": [
        Part(
            "nation",
            {
                "issuer_code": text("n_nationkey"),
                "start_attivation": "'1996-01-01'",
                "end_attivation": "'2000-06-30'",
            },
        ),
        Part(
            "nation",
            {
                "issuer_code": text("n_nationkey"),
                "start_attivation": "'1999-01-01'",
                "end_attivation": "'2001-12-31'",
            },
            where="n_regionkey in (0, 3)",
        ),
    ],
}


# Test tables whose views were written out, and where to.
_STORED: dict[str, str] = {}
MESSAGES = "messages"


def _derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == MESSAGES:
        return _documents(spark, sf_dir)
    first, *others = [p.frame(spark, sf_dir) for p in VIEWS[name]]
    for other in others:
        first = first.unionByName(other)
    return first


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if sf_dir in _STORED:
        return spark.read.orc(f"{_STORED[sf_dir]}/{name}")
    return _derived(spark, sf_dir, name)


def store_views(spark: SparkSession, sf_dir: str, base: str) -> None:
    """Writes every view as an ORC table and reads those from now on.

    For timing: jobs then start from stored card tables, as they do in use.
    """
    files = spark.sparkContext.defaultParallelism
    for name in [*VIEWS, MESSAGES]:
        rows = _derived(spark, sf_dir, name)
        rows.repartition(files).write.orc(f"{base}/{name}")
    _STORED[sf_dir] = base


def ctes(*names: str, **extra: str) -> str:
    """``WITH`` clause defining views, then further named queries."""
    bodies = {n: " union all ".join(p.sql() for p in VIEWS[n]) for n in names}
    bodies |= extra
    return "with " + ",\n".join(f"{n} as ({body})" for n, body in bodies.items())


# ------------------------------------------------------------ JSON messages


def _element(number: int) -> Column:
    value = F.col(f"e{number}")
    filled = F.struct(
        F.lit(str(number)).alias("field_id"),
        F.lit(f"DE{number}").alias("field_name"),
        value.alias("field_value"),
    )
    return F.when(value.isNotNull(), filled)


def _subfield(element: int, tag: str) -> Column:
    key = S.TAGGED_ELEMENTS[element][0]
    return F.struct(
        F.lit(tag[:2]).alias(key),
        F.lit("sub").alias("field_name"),
        F.col(tag_column(element, tag)).alias("field_value"),
    )


def _array(element: int) -> Column:
    items = [_subfield(*k) for k in _TAGS if k[0] == element]
    missing = F.when(F.lit(False), items[0])
    full = F.array(*items, missing)
    empty = F.filter(full, lambda item: F.lit(False))
    return (
        F.when(F.col("shape") == "empty", F.struct(empty.alias("subfield")))
        .when(F.col("shape") == "absent", F.lit(None))
        .otherwise(F.struct(full.alias("subfield")))
    )


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authorization messages: ``time_stamp`` and ``json_field``."""
    fields = view(spark, sf_dir, "message_fields")
    members = [F.col("id")]
    members += [_element(n).alias(f"DE{n}_ss") for n in _ELEMENTS]
    members += [_array(n).alias(f"DE{n}_ss") for n in S.TAGGED_ELEMENTS]
    document = F.to_json(F.struct(*members))
    return fields.select(
        "time_stamp",
        F.when(
            F.col("shape") == "broken",
            F.substring(document, F.lit(1), F.length(document) - 1),
        )
        .otherwise(document)
        .alias("json_field"),
    )
