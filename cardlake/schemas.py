"""Fixed values of the card-message world: layouts, codes, column lists.

Nothing here computes anything. The lists are the contract with upstream
feeds and downstream readers, so they are kept in one place and in their
natural order.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Authorization messages (JSON)
# --------------------------------------------------------------------------

# Simple data elements: element number -> output column.
SIMPLE_ELEMENTS = {
    0: "Message_Type",
    2: "Primary_Account_Number",
    3: "Operation_Type",
    4: "Acquirer_Amount",
    6: "Issuer_Amount",
    7: "Month_Day_Hour_Minute_Seconds",
    11: "System_Trace_Audit_Number",
    14: "Fpan_Date_Expiration",
    15: "Date_Settlement",
    18: "Merchant_Category_Code",
    22: "PAN_Entry_Mode",
    32: "Acquiring_Institution_ID_Code",
    37: "Retrieval_Reference_Number",
    39: "Response_Code",
    42: "Card_Acceptor_ID_Code",
    43: "Card_Acceptor_Name",
    49: "Acquirer_Amount_Currency",
    51: "Issuer_Amount_Currency",
}

# Sub-field arrays: element number -> (key field, {key value: output column}).
TAGGED_ELEMENTS = {
    123: (
        "field_tag",
        {
            "01": "Token",
            "03": "Token_Requestor_id",
            "05": "Token_Id",
            "06": "Token_Expiry_Date",
            "07": "Token_Type",
            "08": "Token_State",
        },
    ),
    125: (
        "field_tag",
        {"01": "Wallet_Provider_Risk_Assessment", "03": "Device_Id"},
    ),
    63: ("field_id", {"1": "Network_Data", "3": "Message_Reason_Code"}),
}

# YY-MM-DD inside the message id, with at least one character on either side;
# group 1 is the two-digit year.
MESSAGE_YEAR_PATTERN = r".(\d{2})-\d{2}-\d{2}."

AUTH_COLUMNS = [
    "Circuit",
    "Token_Id",
    "Token_Expiry_Date",
    "Primary_Account_Number",
    "Fpan_Date_Expiration",
    "Token_Requestor_id",
    "Token_Type",
    "Token_State",
    "Token_Timestamp",
    "Response_Code",
    "Wallet_Provider_Risk_Assessment",
    "Device_Id",
    "Correlation_Id",
    "Operation_Type",
    "PAN_Entry_Mode",
    "Token",
    "Card_Acceptor_ID_Code",
    "Card_Acceptor_Name",
    "Merchant_Category_Code",
    "Acquiring_Institution_ID_Code",
    "System_Trace_Audit_Number",
    "Retrieval_Reference_Number",
    "Acquirer_Amount",
    "Acquirer_Amount_Currency",
    "Issuer_Amount",
    "Issuer_Amount_Currency",
    "Message_Reason_Code",
    "Network_Data",
    "Date_Settlement",
    "Message_Type",
    "Elaboration_Date",
    "Token_Date",
]


def strings(*names: str) -> T.StructType:
    """A struct of nullable strings."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def message_schema(elements: Collection[int] | None = None) -> T.StructType:
    """The part of a message that is read: all elements, or those named.

    Only the leaves that reach the output are declared, so the JSON parser
    skips everything else instead of materialising it.
    """
    wanted = {*SIMPLE_ELEMENTS, *TAGGED_ELEMENTS} if elements is None else elements
    schema = strings("id")
    for number in filter(wanted.__contains__, SIMPLE_ELEMENTS):
        schema = schema.add(f"DE{number}_ss", strings("field_value"))
    for number in filter(wanted.__contains__, TAGGED_ELEMENTS):
        key, _ = TAGGED_ELEMENTS[number]
        items = T.ArrayType(strings(key, "field_value"))
        schema = schema.add(f"DE{number}_ss", T.StructType().add("subfield", items))
    return schema


# --------------------------------------------------------------------------
# Clearing
# --------------------------------------------------------------------------

CIRCUIT = "VISA"
PRESENTMENT_TYPE = "1240"
CHARGEBACK_TYPE = "1442"
PRESENTMENT_CODES = ["05", "06", "07"]
CHARGEBACK_CODES = ["15", "16", "17"]
FIRST_USAGE = "1"
# A header line that was loaded as data carries the column name as its value.
HEADER_DAY = "day"
# The feed's own requestor id is not used; every row carries this one.
TOKEN_REQUESTOR_ID = 50120834693
ACTIVITY_CODE = "I"

EMPTY_MARKERS = ["ALL SPACE", "LOW-VALUE", "ZEROE"]
EMPTY_TOKEN = "ALL-SPACE"
REMOTE_INDICATORS = ["5", "6", "7", "8"]
CONTACTLESS_ENTRY = "07"
FRAUD_REASONS = ["4837", "4840", "4849", "4863", "4870", "4871"]
CURRENCY_EXPONENTS = {"978": "2"}

ARN_PARTS = ["l00026", "l00027", "l00028", "l00029", "l00030"]

CLEARING_FEED = strings(
    "l00004", "l00016", "l00019", "l00022", *ARN_PARTS, "l00032", "l00033",
    "l00034", "l00037", "l00038", "l00039", "l00040", "l00042", "l00045",
    "l00046", "l00054", "l00062", "l00071", "l00072", "l00074", "l00196",
    "l00255", "l00328", "circuito", "ticket", "import_timestamp", "day",
)

CLEARING_COLUMNS = [
    "source_platform",
    "message_type_identifier",
    "abi_code",
    "issuer_code",
    "bin_code",
    "funding_pan",
    "card_type",
    "arn",
    "trace_id",
    "reason_code",
    "fraud_flag",
    "mdes_flag",
    "dpan",
    "token_assur_lev",
    "token_requestor_id",
    "remote_trx_flag",
    "nfc_technology_flag",
    "pos_entry_mode",
    "cod_terminale",
    "cod_esercente",
    "merchant_name",
    "merchant_address",
    "merchant_city",
    "merchant_country",
    "merchant_type",
    "mc_group_code",
    "mc_description",
    "v_rcnc",
    "c_dv_rcnc",
    "p_exp_rcnc",
    "c_activity",
    "circuit",
    "clearing_file_name",
    "transaction_date",
]

# Columns a chargeback takes over from the presentment it refers to.
INHERITED_COLUMNS = [
    "mdes_flag",
    "dpan",
    "token_assur_lev",
    "v_rcnc",
    "c_dv_rcnc",
    "p_exp_rcnc",
]

# --------------------------------------------------------------------------
# Monthly fraud report
# --------------------------------------------------------------------------

REPORT_ID = "GP001"
WALLET_NAME = "Google Pay"
# A fraud chargeback belongs to a presentment when all four agree.
MATCH_KEYS = ["funding_pan", "arn", "trace_id", "v_rcnc"]

REPORT_PRESENTMENT_COLUMNS = [
    "transaction_date",
    "issuer_code",
    "bin_code",
    "token_requestor_id",
    "c_dv_rcnc",
    "p_exp_rcnc",
    *MATCH_KEYS,
]

REPORT_COLUMNS = [
    "month_of_report",
    "issuer_code",
    "bin_code",
    "bin_name",
    "token_requestor_id",
    "token_requestor_name",
    "reconciliation_currency_code",
    "reconciliation_currency_code_exponents",
    "reconciliation_amount",
    "total_transaction",
    "year_of_last_elaboration_date",
    "month_of_last_elaboration_date",
    "day_of_last_elaboration_date",
]
