"""The SQL each query is checked against, for DuckDB over the same tables.

Written from the rules, not from the Spark code: explicit joins, CASE and
aggregates over the views of ``adapters``.
"""

from __future__ import annotations

from cardlake import schemas as S
from fixtures.adapters import ctes, tag_column
from fixtures.queries import (
    ELABORATION_DAY,
    EVENT_DAY,
    MESSAGE_DAY,
    MONTH_END,
    NEWER_THAN,
    ORDER_DAY,
    REPORT_MONTHS,
)

_BIN = "try_cast(substr(rpad(l00019, 19, '0'), 1, 8) as bigint)"
_RAW_ARN = "l00026 || l00027 || l00028 || l00029 || l00030"
_DATE = "substr(import_timestamp, 1, 5) || substr(l00032, 1, 2) || '-' || substr(l00032, 3, 2)"
_MARKERS = "('ALL SPACE', 'LOW-VALUE', 'ZEROE')"

_MDES = f"case when l00255 in {_MARKERS} then 'N' else 'Y' end"
_DPAN = f"case when l00255 in {_MARKERS} then 'ALL-SPACE' else l00255 end"
_EXPONENT = "case when l00034 = '978' then '2' end"
_REMOTE = "case when l00074 in ('5', '6', '7', '8') then 'Y' else 'N' end"
_CONTACTLESS = "case when l00054 = '07' then 'Y' else 'N' end"
_FRAUD = (
    "case when l00046 in ('4837', '4840', '4849', '4863', '4870', '4871') "
    "then 'Y' else 'N' end"
)


def _strip(column: str) -> str:
    return f"coalesce(trim({column}), '')"


_PRESENTMENT_WHERE = (
    "day <> 'day' and l00045 = '1' and l00016 in ('05', '06', '07') "
    "and l00255 is not null and l00196 is not null"
)
_CHARGEBACK_WHERE = "l00045 = '1' and l00016 in ('15', '16', '17')"

_OWN_COLUMNS = f"""
    substr(circuito, 1, 2) as source_platform,
    cast(null as varchar) as abi_code, l00004 as issuer_code,
    substr(l00019, 1, 6) as bin_code, {_strip("l00019")} as funding_pan,
    c_tp_addbt as card_type, {_strip(_RAW_ARN)} as arn, {_strip("l00328")} as trace_id,
    l00046 as reason_code, cast(50120834693 as bigint) as token_requestor_id,
    {_REMOTE} as remote_trx_flag, {_CONTACTLESS} as nfc_technology_flag,
    l00054 as pos_entry_mode, l00072 as cod_terminale, l00071 as cod_esercente,
    l00037 as merchant_name, cast(null as varchar) as merchant_address,
    l00038 as merchant_city, l00039 as merchant_country, l00042 as merchant_type,
    mastercard_mc_group_code as mc_group_code, mc_description as mc_description,
    'I' as c_activity, 'VISA' as circuit, {_DATE} as transaction_date
"""

_PRESENTMENTS = f"""
    select {_OWN_COLUMNS}, '1240' as message_type_identifier, 'N' as fraud_flag,
        {_MDES} as mdes_flag, {_DPAN} as dpan, l00062 as token_assur_lev,
        l00033 as v_rcnc, l00034 as c_dv_rcnc, {_EXPONENT} as p_exp_rcnc,
        circuito || l00032 || ticket as clearing_file_name
    from presentment_feed
    join categories on l00040 = mc_code
    join merchant_groups g on visa_mc_group_code = g.mc_group_code
        and g.circuit = 'VISA'
    join issuers on l00004 = issuers.issuer_code
    join bins on {_BIN} = try_cast(c_pan_visa as bigint)
    where {_PRESENTMENT_WHERE}
"""

_SAME_ARN = "own.raw_arn = p.arn"
_CHARGEBACKS = f"""
    select own.*, p.mdes_flag, p.dpan, p.token_assur_lev, p.v_rcnc, p.c_dv_rcnc,
        p.p_exp_rcnc
    from (
        select {_OWN_COLUMNS}, '1442' as message_type_identifier,
            {_FRAUD} as fraud_flag,
            circuito || l00022 || ticket as clearing_file_name,
            {_RAW_ARN} as raw_arn
        from chargeback_feed
        join categories on l00040 = mc_code
        join merchant_groups g on mastercard_mc_group_code = g.mc_group_code
            and g.circuit = 'VISA'
        join bins on {_BIN} = try_cast(c_pan_visa as bigint)
        where {_CHARGEBACK_WHERE}
    ) own
    join presentments p on {_SAME_ARN}
"""

_LAYOUT = ", ".join(S.CLEARING_COLUMNS)
_CLEARING = (
    f"select {_LAYOUT} from presentments union all select {_LAYOUT} from chargebacks"
)

_CLEARING_CTES = ctes(
    "presentment_feed", "chargeback_feed", "issuers", "bins", "categories",
    "merchant_groups", "report_groups", "wallets", "periods",
    presentments=_PRESENTMENTS, chargebacks=_CHARGEBACKS, clearing=_CLEARING,
)
_FEED = ctes("presentment_feed", "chargeback_feed")

def _feed(*columns: str) -> str:
    return f"{_FEED} select l00026, l00028, {', '.join(columns)} from presentment_feed"


def _clearing(body: str) -> str:
    return f"{_CLEARING_CTES} {body}"


_SAME_TRANSACTION = " and ".join(f"fp.{k} = cb.{k}" for k in S.MATCH_KEYS)
_FRAUD_ROWS = (
    "(select * from clearing where message_type_identifier = '1442' "
    "and fraud_flag = 'Y' and mdes_flag = 'Y')"
)
_FRAUD_CHARGEBACKS = "(select * from chargebacks where fraud_flag = 'Y' and mdes_flag = 'Y')"
_OWN_REPORT_COLUMNS = ", ".join(f"fp.{c}" for c in S.REPORT_PRESENTMENT_COLUMNS)
_PRESENTED_ROWS = "(select * from clearing where message_type_identifier = '1240')"

_REPORT = f"""
    select strftime(try_cast(fp.transaction_date as date), '%Y%m') as month_of_report,
        fp.issuer_code, fp.bin_code, issuer_name as bin_name, fp.token_requestor_id,
        token_requestor_name, fp.c_dv_rcnc as reconciliation_currency_code,
        fp.p_exp_rcnc as reconciliation_currency_code_exponents,
        sum(coalesce(cast(cb.v_rcnc as double), 0))
            / pow(10, cast(fp.p_exp_rcnc as double)) as reconciliation_amount,
        count(cb.v_rcnc) as total_transaction,
        max(fp.transaction_date) as last_date
    from {_PRESENTED_ROWS} fp
    left join {_FRAUD_ROWS} cb on {_SAME_TRANSACTION}
    join issuers i on fp.issuer_code = i.issuer_code
    join report_groups r on i.group_code = r.group_code and r.id = 'GP001'
    join periods v on fp.issuer_code = v.issuer_code
        and fp.transaction_date between v.start_attivation and v.end_attivation
    join wallets w on fp.token_requestor_id = w.token_requestor_id
        and w.token_requestor_name = 'Google Pay'
    group by 1, 2, 3, 4, 5, 6, 7, 8
"""


def _parts(date: str, suffix: str = "") -> str:
    return ", ".join(
        f"cast({part}({date}) as integer) as {part}{suffix}"
        for part in ("year", "month", "day")
    )


_DATED_REPORT = (
    "select * exclude (last_date), "
    f"{_parts('try_cast(last_date as date)', '_of_last_elaboration_date')} "
    f"from ({_REPORT}) r"
)

# ----------------------------------------------------------- authorization

_READABLE = "case when shape <> 'broken' then {} end"


def _simple_fields() -> dict[str, str]:
    fields = {n: _READABLE.format(f"e{k}") for k, n in S.SIMPLE_ELEMENTS.items()}
    return {"message_id": _READABLE.format("id")} | fields


def _tag_fields() -> dict[str, str]:
    fields = {}
    for element, (_, tags) in S.TAGGED_ELEMENTS.items():
        for tag, name in tags.items():
            value = tag_column(element, tag)
            if (element, tag) == (123, "05"):
                value = f"greatest({value}, {tag_column(123, '05b')})"
            fields[name] = f"case when shape = 'full' then {value} end"
    return fields


def _select(fields: dict[str, str]) -> str:
    return ", ".join(f"{e} as {n}" for n, e in fields.items())


def _trace(condition: str) -> str:
    fields = _select(_simple_fields() | _tag_fields())
    own = {
        "Circuit": "'VISA'",
        "Correlation_Id": "Token_Id || Token_Requestor_id",
        "Elaboration_Date": f"'{ELABORATION_DAY.replace('-', '')}'",
        "Token_Date": "substr(Token_Timestamp, 1, 10)",
    }
    columns = ", ".join(f"{own[c]} as {c}" if c in own else c for c in S.AUTH_COLUMNS)
    time = "Month_Day_Hour_Minute_Seconds"
    stamp = (
        r"'20' || substr(regexp_extract(message_id, '(.)(\d{2}-\d{2}-\d{2})(.)', 2), 1, 2)"
        f" || '-' || substr({time}, 1, 2) || '-' || substr({time}, 3, 2) || ' ' ||"
        f" substr({time}, 5, 2) || ':' || substr({time}, 7, 2) || ':' ||"
        f" substr({time}, 9, 2) || '.000'"
    )
    return ctes(
        "message_fields",
        flat=f"select {fields} from message_fields where {condition}",
        stamped=f"select *, {stamp} as Token_Timestamp from flat",
    ) + (f" select {columns} from stamped")


def _messages(columns: str) -> str:
    return f"{ctes('message_fields')} select {columns} from message_fields"


def _exploded() -> str:
    head = (
        f"{_READABLE.format('id')} as message_id, "
        f"{_READABLE.format('e37')} as Retrieval_Reference_Number"
    )
    tags = ("01", "03", "05", "05b", "06", "07", "08", "99")
    rows = [
        f"select {head}, '{t[:2]}' as field_tag, {tag_column(123, t)} as field_value "
        "from message_fields where shape = 'full'"
        for t in tags
    ]
    # One row for the NULL item of a full array, one for a message without items.
    rows.append(
        f"select {head}, cast(null as varchar), cast(null as varchar) "
        "from message_fields"
    )
    return ctes("message_fields") + " " + " union all ".join(rows)


_ORDER_ID = (
    "case when o_orderstatus = 'P' then 'M undated' else "
    "'M ' || strftime(o_orderdate, '%y-%m-%d') || ' ' end"
)
_ORDER_YEAR = rf"regexp_extract({_ORDER_ID}, '.(\d\d)-\d\d-\d\d.', 1)"
_ORDER_STAMP = f"'20' || {_ORDER_YEAR} || strftime(o_orderdate, '-%m-%d') || ' 10:15:30.000'"
_ORDER_DATE = "cast(cast(o_orderdate as date) as varchar)"
_ORDER_ROWS = (
    f"select o_orderkey, {{status}} as o_orderstatus, o_totalprice, "
    f"{_ORDER_DATE} as order_date, case when o_orderpriority <> '5-LOW' "
    f"then substr({_ORDER_DATE}, 1, 7) end as order_month from orders"
)
_ALL_ORDERS = _ORDER_ROWS.format(status="o_orderstatus")
_DATE_NUMBER = "cast(strftime(o_orderdate, '%Y%m%d') as integer)"

_ORDERS_BY_DAY = (
    "select o_orderkey, o_custkey, strftime(day, '%Y') as year, strftime(day, '%m') as month, "
    "strftime(day, '%d') as day from (select o_orderkey, o_custkey, last_day(o_orderdate) as day "
    "from orders) o where o.day {}"
)

ORACLES = {
    "scan_day_slice": "select event_id, user_id, event_type, value from events "
    f"where cast(ts as date) = date '{EVENT_DAY}'",
    "ymd_partition_filter": "select o_orderkey, o_custkey, "
    "strftime(o_orderdate, '%Y') as year, strftime(o_orderdate, '%m') as month, "
    "strftime(o_orderdate, '%d') as day from orders "
    f"where cast(o_orderdate as date) = date '{ORDER_DAY}'",
    "ymd_partition_stored": _ORDERS_BY_DAY.format(f"= date '{MONTH_END}'"),
    "ymd_partition_dynamic": _ORDERS_BY_DAY.format(
        f"in (select last_day(date '{MONTH_END}' + to_months(cast(7 * r_regionkey as integer))) "
        "from region where r_name <> 'ASIA')"
    ),
    "presentment_readback": _clearing(
        f"select {', '.join(S.REPORT_PRESENTMENT_COLUMNS)} from {_PRESENTED_ROWS} p"
    ),
    "fraud_chargeback_readback": _clearing(f"select * from {_FRAUD_ROWS} c"),
    "json_parse_fields": _messages(_select(_simple_fields())),
    "json_malformed": _messages(
        f"{_READABLE.format('id')} as message_id, "
        f"{_READABLE.format('e37')} as Retrieval_Reference_Number, "
        "cast(case shape when 'full' then 9 when 'empty' then 0 end as integer) "
        "as subfields"
    ),
    "json_inline_outer": _exploded(),
    "tag_pivot": _messages(
        _select(
            {
                k: v
                for k, v in _simple_fields().items()
                if k in ("message_id", "Retrieval_Reference_Number")
            }
            | _tag_fields()
        )
    ),
    "auth_trace": _trace("true"),
    "auth_trace_daily": _trace(f"time_stamp = '{MESSAGE_DAY}'"),
    "regex_year": f"select o_orderkey, {_ORDER_YEAR} as message_year from orders",
    "timestamp_assembly": f"select o_orderkey, {_ORDER_STAMP} as token_timestamp, "
    f"substr({_ORDER_STAMP}, 1, 10) as token_date from orders",
    "compact_date": "select o_orderkey, strftime(o_orderdate, '%Y%m%d') "
    "as compact_date from orders",
    "month_bucket": "select strftime(o_orderdate, '%Y%m') as month_of_report, "
    "count(*) as orders from orders group by 1",
    "date_parts": f"select o_orderkey, {_parts('o_orderdate')} from orders",
    "decode_sentinel_flag": _feed("l00255", f"{_MDES} as mdes_flag"),
    "decode_sentinel_replace": _feed("l00255", f"{_DPAN} as dpan"),
    "decode_currency_exponent": _feed("l00034", f"{_EXPONENT} as p_exp_rcnc"),
    "decode_set_flag": _feed("l00074", f"{_REMOTE} as remote_trx_flag"),
    "decode_equal_flag": _feed("l00054", f"{_CONTACTLESS} as nfc_technology_flag"),
    "decode_fraud_reason": _feed("l00046", f"{_FRAUD} as fraud_flag"),
    "strip_blanks": _feed(
        f"{_strip('l00019')} as funding_pan",
        f"{_strip('l00328')} as trace_id",
        f"{_strip('l00255')} as device_pan",
    ),
    "arn_concat": _feed(f"{_RAW_ARN} as raw_arn", f"{_strip(_RAW_ARN)} as arn"),
    "clearing_date_assembly": _feed(f"{_DATE} as transaction_date"),
    "clearing_file_name": _feed(
        "circuito || l00032 || ticket as presentment_file",
        "circuito || l00022 || ticket as chargeback_file",
    ),
    "typed_constant_columns": _clearing(
        "select arn, circuit, message_type_identifier, fraud_flag, c_activity, "
        "token_requestor_id, abi_code, merchant_address from presentments"
    ),
    "clearing_filter_presentment": f"{_FEED} select l00026, l00028, l00016, l00045, "
    f'l00196, l00255, "day" from presentment_feed where {_PRESENTMENT_WHERE}',
    "clearing_filter_chargeback": f"{_FEED} select l00026, l00028, l00016, l00045 "
    f"from chargeback_feed where {_CHARGEBACK_WHERE}",
    "bin_lookup_join": _clearing(
        "select l00026, l00028, l00019, c_tp_addbt from presentment_feed "
        f"join bins on {_BIN} = try_cast(c_pan_visa as bigint)"
    ),
    "issuer_join": _clearing(
        "select l00026, l00028, l00004 from presentment_feed "
        "join issuers on l00004 = issuer_code"
    ),
    **{
        f"mcc_group_join_{name}": _clearing(
            "select l00026, l00028, l00040, mastercard_mc_group_code, mc_description "
            "from presentment_feed join categories on l00040 = mc_code "
            f"join merchant_groups on {column} = mc_group_code and circuit = 'VISA'"
        )
        for name, column in (
            ("native", "visa_mc_group_code"),
            ("alternate", "mastercard_mc_group_code"),
        )
    },
    "issuer_group_join": _clearing(
        "select arn, p.issuer_code, issuer_name from presentments p "
        "join issuers i on p.issuer_code = i.issuer_code "
        "join report_groups r on i.group_code = r.group_code and id = 'GP001'"
    ),
    "wallet_cast_join": _clearing(
        "select l00026, l00028, l00196 as token_requestor_id, token_requestor_name "
        "from presentment_feed join wallets "
        "on try_cast(l00196 as bigint) = token_requestor_id "
        "and token_requestor_name = 'Google Pay'"
    ),
    "validity_interval_join": _clearing(
        "select arn, p.issuer_code, transaction_date from presentments p "
        "join periods v on p.issuer_code = v.issuer_code "
        "and transaction_date between start_attivation and end_attivation"
    ),
    "validity_binned_join": _clearing(
        "select arn, p.issuer_code, transaction_date from presentments p "
        "join periods v on p.issuer_code = v.issuer_code "
        "and transaction_date between start_attivation and end_attivation"
    ),
    "presentment": _clearing(f"select {_LAYOUT} from presentments"),
    "chargeback": _clearing(f"select {_LAYOUT} from chargebacks"),
    "chargeback_stripped": _clearing(f"select {_LAYOUT} from chargebacks").replace(
        _SAME_ARN, "trim(own.raw_arn) = p.arn and p.arn <> ''"
    ),
    "clearing_union": _clearing("select * from clearing"),
    "clearing_stored_by_date": _clearing("select * from clearing"),
    "presentment_incremental": _clearing(f"select {_LAYOUT} from presentments"),
    "presentment_chargeback_left": _clearing(
        f"select {_OWN_REPORT_COLUMNS}, cb.reason_code as cb_reason_code, "
        "cb.clearing_file_name as cb_clearing_file_name "
        f"from presentments fp left join {_FRAUD_CHARGEBACKS} cb on {_SAME_TRANSACTION}"
    ),
    "presentment_chargeback_counted": _clearing(
        f"select {_OWN_REPORT_COLUMNS}, cb.reason_code as cb_reason_code, "
        "cb.clearing_file_name as cb_clearing_file_name, "
        "cast(sum(fp.n * coalesce(cb.n, 1)) as bigint) as n_pairs "
        f"from (select {', '.join(S.REPORT_PRESENTMENT_COLUMNS)}, count(*) as n "
        "from presentments group by all) fp left join "
        f"(select {', '.join(S.MATCH_KEYS)}, reason_code, clearing_file_name, count(*) as n "
        f"from {_FRAUD_CHARGEBACKS} group by all) cb on {_SAME_TRANSACTION} group by all"
    ),
    "scaled_amount_sum": f"{_FEED} select l00004 as issuer_code, l00034 as currency, "
    "sum(coalesce(try_cast(l00033 as double), 0)) "
    f"/ pow(10, cast({_EXPONENT} as double)) as amount "
    "from presentment_feed group by l00004, l00034",
    "fraud_report": _clearing(_DATED_REPORT),
    "report_incremental": _clearing(_DATED_REPORT),
    "report_merged": _clearing(_DATED_REPORT),
    "report_months": _clearing(
        f"{_DATED_REPORT} where month_of_report in ("
        + ", ".join(f"'{m}'" for m in REPORT_MONTHS)
        + ")"
    ),
    "chargeback_colocated": _clearing(f"select {_LAYOUT} from chargebacks"),
    "presentment_loads": _clearing(f"select {_LAYOUT} from presentments"),
    "high_water_mark": f"select o_orderkey, {_ORDER_DATE} as transaction_date, "
    f"{_DATE_NUMBER} as date_number from orders where {_DATE_NUMBER} > "
    f"(select coalesce(max({_DATE_NUMBER}), 0) from orders "
    f"where {_ORDER_DATE} < '{NEWER_THAN}')",
    "sink_append_partitioned": f"{_ALL_ORDERS} union all "
    f"{_ALL_ORDERS} where o_orderstatus = 'F'",
    "sink_overwrite": f"{_ALL_ORDERS} where o_orderstatus = 'F'",
    "sink_partition_replace": f"{_ALL_ORDERS} where o_orderpriority = '5-LOW' or "
    f"year(o_orderdate) <> {MESSAGE_DAY[:4]} union all "
    + _ORDER_ROWS.format(status="'X'")
    + f" where o_orderpriority <> '5-LOW' and year(o_orderdate) = {MESSAGE_DAY[:4]}",
    "sink_sorted_layout": _ALL_ORDERS,
    "sink_replace_whole": f"{_ALL_ORDERS} where o_orderpriority <> '5-LOW' "
    "and month(o_orderdate) <> 2",
    "sink_range_files": "select order_month, cast(count(*) as bigint) as n_rows, "
    "cast(0 as bigint) as n_overlapping, cast(0 as bigint) as n_over "
    f"from ({_ALL_ORDERS}) o group by 1",
    "sink_sorted_files": "select order_month, count(*) as n_rows, "
    f"cast(0 as bigint) as n_unsorted from ({_ALL_ORDERS}) o group by 1",
    "json_event_fields": "select event_id, json_extract_string(props, '$.k') as k, "
    "json_extract_string(props, '$.absent') as absent from events",
}
