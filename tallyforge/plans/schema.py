"""The canonical transaction schema and the header names that lead to it."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Field:
    kind: str
    required: bool = False
    default: str | None = None


CANONICAL = {
    "entity_id": Field("id", required=True),
    "timestamp": Field("datetime", required=True),
    "amount": Field("numeric", required=True),
    "currency": Field("categorical", default="USD"),
    "category": Field("categorical", default="UNKNOWN"),
    "channel": Field("categorical", default="UNKNOWN"),
    "counterparty": Field("id", default="UNKNOWN"),
    "status": Field("categorical", default="COMPLETED"),
    "label": Field("categorical"),
}
REQUIRED = [name for name, field in CANONICAL.items() if field.required]
IMPORTANT_OPTIONAL = ["category", "label"]
#: What a query over transactions sees.
QUERY_COLUMNS = ["entity_id", "timestamp", "amount", "currency", "category", "channel", "counterparty", "status"]
#: Identifiers that are pseudonymized, and the default salt (a fixed value: equal salts give equal pseudonyms).
HASHED = ["entity_id", "counterparty"]
SALT = "txn-pipeline-fixed-salt-v1"
EXTRA = "extra__"
DIRECTION = "_direction"
AUTO_INDEX = "__AUTO_INDEX_ENTITY_ID__"
#: Strings that a CSV reader takes for a missing value.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

#: Normalized header names of each field. The order decides ties between equally near names.
ALIASES = {
    "entity_id": ["entityid", "accountid", "customerid", "userid", "acctid", "custno", "accountnumber", "cardid", "acctno"],
    "timestamp": ["timestamp", "date", "txndate", "transactiondate", "postedat", "datetime", "time", "createdat"],
    "amount": ["amount", "amt", "transactionamount", "value", "txnamount", "total", "amtcents"],
    "currency": ["currency", "curr", "ccy"],
    "category": ["category", "merchantcategory", "mcc", "txncategory", "typecategory"],
    "channel": ["channel", "txnchannel", "paymentchannel", "method", "chnl"],
    "counterparty": ["counterparty", "merchant", "receiver", "payee", "recipient", "merchantname"],
    "status": ["status", "txnstatus", "state"],
    "label": ["label", "isfraud", "fraudflag", "fraud", "target", "class"],
    DIRECTION: ["drcr", "direction", "debitcredit", "txntypesign"],
}
