"""sluice: land, conform, key and incrementally load tables on Spark.

Everything is a DataFrame expression Catalyst can optimise; the clock is an
explicit ``as_of`` so every result can be checked against SQL.
"""

from sluice.operators.conform import (
    REASON_COL,
    UNPARSEABLE_COL,
    assert_schema,
    conform,
    conform_names,
    schema_report,
    split_rejects,
    validate_schema,
    with_audit,
)
from sluice.operators.counts import reconcile, row_count, table_counts
from sluice.operators.load import (
    Target,
    append_table,
    create_target,
    incremental_insert,
    load,
    new_rows,
    read_target,
    reload_table,
    resolve_target,
    target_exists,
)
from sluice.session import build_session, checkpoint_root, work_path
from sluice.spec import AuditSpec, TableSpec, make_spec

__all__ = [
    "REASON_COL", "UNPARSEABLE_COL", "resolve_target", "AuditSpec", "TableSpec", "Target", "append_table", "assert_schema",
    "build_session", "checkpoint_root", "conform", "conform_names", "create_target",
    "incremental_insert", "load", "make_spec", "new_rows", "read_target", "reconcile",
    "reload_table", "row_count", "schema_report", "split_rejects", "table_counts",
    "target_exists", "validate_schema", "with_audit", "work_path",
]
