"""Extracts that feed every source column of the lead contracts, and SQL for the result.

Written apart from ``specs/lead.py``: the columns are listed here again, in load
order, and a source column is named like its target without underscores, in lower
case (one has a spelling of its own). A mark after a name tells the type: ``t``
timestamp, ``d`` date, ``n`` whole number, ``f`` double, ``b`` boolean, ``x`` boolean
words kept as text, ``j`` JSON text, ``c`` timestamp whose future is clamped.
"""

from __future__ import annotations

# --- fixed values: keep exactly as written ---------------------------------

LEAD = """
LEAD_GUID LEGACY_LEAD_ID INDIV_ID HH_ID ADDR_ID LEAD_CODE LEAD_TYPE_ID:n LEAD_TYPE LEAD_SOURCE
LEAD_CREATE_DATE:t FIRST_NAME MIDDLE_NAME LAST_NAME SUFFIX BIRTH_DATE AGE:n SEX STREET_1 STREET_2 CITY
STATE_ID:n STATE ZIP ZIP5 COUNTY COUNTRY PHONE HOME_PHONE CELL_PHONE WORK_PHONE DO_NOT_CALL CALLER_ID EMAIL
DYNAMIC_LEAD PROSPECT_ID EXT_PARTNER_ID CHANNEL_ID:n CHANNEL OPT_SOURCE_ID SOURCE_ID:n SUB_SOURCE_ID:b
SOURCE_OF_REFERRAL DIVISION LEAD_SUB_SOURCE LEAD_SUB_SOURCE_ID LENDER LOAN_AMOUNT LOAN_DATE:d DIABETES
HEALTH_PROBLEMS HEART_PROBLEMS HEIGHT HIGH_BP_CHOL IS_INSURED SMOKER OCCUPATION SPOUSE COBORROWER_AGE:f
COBORROWER_BIRTH_DATE:t COBORROWER_HEIGHT COBORROWER_ON_MORTGAGE COBORROWER_NAME COBORROWER_RELATION
COBORROWER_SEX COBORROWER_SMOKER COBORROWER_WEIGHT COBORROWER_OCCUPATION DATA_SOURCE LEAD_ORIGIN_URL
MAILING_ID SUSPECT_CAMPAIGN_ID:n CONSUMER_DEBT:f MORTGAGE_DEBT UTM_CAMPAIGN UTM_MEDIUM UTM_SOURCE
REFERRING_URL PCS_POLICIES_ID:n CREATE_DATE:t MODIFY_DATE:t SOURCE_TABLE IS_DELETED_SOURCE:x EXP_DATE:t
SOURCE_TYPE SOURCE_TYPE_ID:n PRODUCT_TYPE LEAD_ATTRIBUTES:j CUSTODY_TARGET_AUDIENCE SOURCE PRODUCT_TYPE_ID:n
LEAD_SOURCE_ID ORIGIN_SYSTEM_ID ORIGIN_SYSTEM ORIGIN_SYSTEM_ORIG LEAD_INGESTION_METHOD
"""
LEAD_XREF = """
LEAD_XREF_GUID LEGACY_LEAD_ID LEAD_CODE LEAD_LEVEL_ID LEAD_LEVEL DATA_SOURCE_ID LEVEL_DATE:t CREATE_DATE:t
MODIFY_DATE:t AVAILABLE_FOR_PURCHASE_IND IS_DELETED_SOURCE:x LEAD_LEVEL_ALIAS
"""
LEAD_ASSIGNMENT = """
LEAD_ASSIGNMENT_GUID LEAD_XREF_GUID AGENT_CODE PURCHASE_DATE:c PURCHASE_PRICE:f ASSIGN_DATE:c INACTIVE_IND
STATUS AGENT_EXTUID ALLOCATE_IND COMMENTS SFG_DIRECT_AGENT_ID BASE_SHOP_OWNER_AGENT_ID
TOTAL_UPLINE_AGENT_CODES UNPAID_IND APP_COUNT APP_APV ACTUAL_APP_COUNT ACTUAL_APV CREATE_DATE:c MODIFY_DATE:c
SOURCE_TABLE METADATA:j STATUS_DATE:c IS_DELETED_SOURCE:b ORDER_NUMBER LEAD_STATUS_ID LEAD_STATUS
HQ_PURCHASE_AMOUNT:f LEAD_ORDER_SYSTEM_ID LEAD_ORDER_SYSTEM ORDER_SYSTEM_ID ORDER_SYSTEM ORDER_SYSTEM_ORIG
EXCLUSIVITY_END_DATE:c
"""
SPELLINGS = {"ORIGIN_SYSTEM_ORIG": "originsystem_orig"}

# --- end of fixed values -----------------------------------------------------


def columns(listed: str) -> list[tuple[str, str, str]]:
    """(source, target, kind) in load order."""
    out = []
    for word in listed.split():
        name, _, kind = word.partition(":")
        out.append((SPELLINGS.get(name, name.replace("_", "").lower()), name, kind or "s"))
    return out


def _text(kind: str, i: int) -> str:
    """A source cell from the row's number ``k``, day ``d`` and later day ``f``, in both engines' SQL."""
    def turn(*cells: str) -> str:
        cases = " ".join(f"WHEN {n} THEN {c}" for n, c in enumerate(cells))
        return f"CASE (k + {i}) % {len(cells)} {cases} END"

    us = "substr(d, 6, 2) || '/' || substr(d, 9, 2) || '/' || substr(d, 1, 4)"
    if kind in "tc":
        return turn("d || ' 00:00:00'", us, "'n/a'", "replace(d, '-', '')", "f || ' 00:00:00'")
    return {
        "s": f"'s{i}-' || CAST(k AS STRING)",
        "n": turn("CAST(k AS STRING)", "' 1,' || CAST(100 + k % 900 AS STRING)", "'x'"),
        "f": turn("CAST(k AS STRING) || '.5'", "'1e3'"),
        "d": turn("d", us, "'abc'"),
        "b": turn("'Yes'", "'f'", "'maybe'"),
        "x": turn("'yes'", "'NO'", "'maybe'"),
        "j": turn("'{\"k\": ' || CAST(k AS STRING) || '}'", "'[1, 2'", "'\"s\"'"),
    }[kind]


def _value(kind: str, i: int) -> str:
    """What the contract makes of the cell, from the clean values (DuckDB)."""
    def turn(*cells: str) -> str:
        cases = " ".join(f"WHEN {n} THEN {c}" for n, c in enumerate(cells))
        return f"CASE (k + {i}) % {len(cells)} {cases} END"

    if kind in "tc":
        day = "CAST(d AS TIMESTAMP)"
        later = "CASE WHEN year(CAST(f AS DATE)) <= 2025 THEN CAST(f AS TIMESTAMP) END"
        return f"CAST({turn(day, day, 'NULL', day, later)} AS TIMESTAMP)"
    return {
        "s": _text("s", i).replace("STRING", "VARCHAR"),
        "n": f"CAST({turn('k', '1100 + k % 900', 'NULL')} AS DECIMAL(38,0))",
        "f": f"CAST({turn('k + 0.5', 'NULL')} AS DOUBLE)",
        "d": f"CAST({turn('CAST(d AS DATE)', 'CAST(d AS DATE)', 'NULL')} AS DATE)",
        "b": f"CAST({turn('true', 'false', 'NULL')} AS BOOLEAN)",
        "x": turn("'TRUE'", "'FALSE'", "'maybe'"),
        "j": turn("'{\"k\": ' || CAST(k AS VARCHAR) || '}'", "NULL", "'\"s\"'"),
    }[kind]


def extract_sql(listed: str, base: str) -> str:
    """Spark SQL of the extract over ``base``, a query of k, d and f."""
    cells = ", ".join(f"{_text(kind, i)} AS `{src}`" for i, (src, _, kind) in enumerate(columns(listed)))
    return f"SELECT {cells} FROM ({base}) base"


def oracle_sql(listed: str, key: str, base: str, as_of: str) -> str:
    """DuckDB SQL of the conformed rows over ``base``."""
    plain = [(name, kind, _value(kind, i)) for i, (_, name, kind) in enumerate(columns(listed))]
    parts = [f"CAST({v} AS VARCHAR)" for _, _, v in plain]
    sized = " || ".join(f"coalesce(length({p}) || ':' || {p}, '-')" for p in parts)
    clock = f"TIMESTAMP '{as_of}'"
    shown = ", ".join(
        f"{f'CASE WHEN {v} > {clock} THEN {clock} ELSE {v} END' if kind == 'c' else v} AS {name}" for name, kind, v in plain
    )
    return (
        f"SELECT sha256({sized}) AS {key}, {shown}, {clock} AS ETL_CREATED_DATE, {clock} AS ETL_LAST_UPDATE_DATE, "
        f"'ETL_PROCESS' AS CREATED_BY, true AS TO_PROCESS, 'SOURCE_SYSTEM' AS EDW_EXTERNAL_SOURCE_SYSTEM FROM ({base}) base"
    )
