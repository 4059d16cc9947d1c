"""Contracts over the TPC-H-shaped test tables, used by checks and benches."""

from __future__ import annotations

from sluice.spec import AuditSpec, TableSpec, make_spec

AUDIT = AuditSpec(source_system="TPCH")


def orders_spec() -> TableSpec:
    return make_spec("orders", "STG_ORDERS_KEY", [
        ("o_orderkey", "ORDER_KEY", "decimal(38,0)"),
        ("o_custkey", "CUST_KEY", "string"),
        ("o_orderstatus", "STATUS", "string"),
        ("o_totalprice", "TOTAL_PRICE", "double"),
        ("o_orderdate", "ORDER_DATE", "timestamp"),
        ("o_orderpriority", "PRIORITY", "string"),
    ], audit=AUDIT)


def lineitem_spec(strict_quantity: bool = False) -> TableSpec:
    """Text-typed lineitem extract (see ``dirty_lineitem``) to typed columns."""
    return make_spec("lineitem", "STG_LINEITEM_KEY", [
        ("l_orderkey", "ORDER_KEY", "decimal(38,0)"),
        ("l_linenumber", "LINE_NUMBER", "decimal(38,0)"),
        ("qty_text", "QUANTITY", "decimal(38,0)", not strict_quantity),
        ("price_text", "EXTENDED_PRICE", "double"),
        ("l_discount", "DISCOUNT", "double"),
        ("flag_text", "IS_RETURNED", "string"),
        ("status_text", "IS_OPEN", "boolean"),
        ("ship_text", "SHIP_DATE", "timestamp"),
        ("ship_day_text", "SHIP_DAY", "date"),
        ("meta_text", "META", "string"),
    ], json_cols=("META",), bool_string_cols=("IS_RETURNED",), audit=AUDIT)


def customer_spec() -> TableSpec:
    return make_spec("customer", "STG_CUSTOMER_KEY", [
        ("C_CustKey", "CUSTOMER_ID", "decimal(38,0)"),
        ("c_name", "NAME", "string"),
        ("c_nationkey", "NATION_ID", "decimal(38,0)"),
        ("c_acctbal", "BALANCE", "double"),
        ("c_mktsegment", "SEGMENT", "string"),
        ("c_phone", "PHONE", "string"),
    ], audit=AUDIT)


def customer_profile_spec() -> TableSpec:
    """A contract the customer table only partly meets (for the schema report)."""
    return make_spec("customer_profile", "STG_CUSTOMER_PROFILE_KEY", [
        ("c_custkey", "CUSTOMER_ID", "decimal(38,0)"),
        ("c_name", "NAME", "string"),
        ("c_acctbal", "BALANCE", "decimal(38,0)"),
        ("c_mktsegment", "IS_ACTIVE", "boolean"),
        ("c_nationkey", "SIGNUP_DATE", "date"),
        ("c_phone", "PHONE", "string"),
    ], audit=AUDIT)
