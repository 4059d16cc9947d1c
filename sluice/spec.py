"""Table contracts: target schema, source-name mapping and semantic tags."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

FUTURE_POLICIES = ("keep", "clamp", "null", "clamp_parsed")


@dataclass(frozen=True)
class AuditSpec:
    """The five audit columns stamped on every loaded row."""

    created_col: str = "ETL_CREATED_DATE"
    updated_col: str = "ETL_LAST_UPDATE_DATE"
    created_by_col: str = "CREATED_BY"
    to_process_col: str = "TO_PROCESS"
    source_system_col: str = "EDW_EXTERNAL_SOURCE_SYSTEM"
    created_by: str = "ETL_PROCESS"
    source_system: str = "SOURCE_SYSTEM"
    to_process: bool = True

    @property
    def columns(self) -> tuple[str, ...]:
        return (
            self.created_col,
            self.updated_col,
            self.created_by_col,
            self.to_process_col,
            self.source_system_col,
        )

    def fields(self) -> list[StructField]:
        return [
            StructField(self.created_col, TimestampType(), False),
            StructField(self.updated_col, TimestampType(), False),
            StructField(self.created_by_col, StringType(), False),
            StructField(self.to_process_col, BooleanType(), False),
            StructField(self.source_system_col, StringType(), False),
        ]


DEFAULT_AUDIT = AuditSpec()


@dataclass(frozen=True)
class TableSpec:
    """Contract of one target table.

    ``schema`` lists the target columns in load order, including the key and
    audit columns. ``mapping`` maps source names (matched case-insensitively)
    to target names; several source spellings may map to one target.
    """

    name: str
    schema: StructType
    mapping: Mapping[str, str]
    key_col: str
    json_cols: frozenset[str] = frozenset()
    bool_string_cols: frozenset[str] = frozenset()
    future_policy: Mapping[str, str] = field(default_factory=dict)
    audit: AuditSpec | None = DEFAULT_AUDIT
    hash_cols: tuple[str, ...] | None = None
    time_zone: str | None = None
    extracted_col: str | None = None

    def __post_init__(self) -> None:
        names = [f.name for f in self.schema.fields]
        if len({n.lower() for n in names}) != len(names):
            raise ValueError(f"{self.name}: duplicate target column names")
        if self.key_col not in names:
            raise ValueError(f"{self.name}: key column {self.key_col} not in schema")
        for col_name, policy in self.future_policy.items():
            if policy not in FUTURE_POLICIES:
                raise ValueError(f"{self.name}: unknown future policy {policy!r}")
            if col_name not in names:
                raise ValueError(f"{self.name}: future policy on unknown column {col_name}")
        if self.audit is not None:
            missing = [c for c in self.audit.columns if c not in names]
            if missing:
                raise ValueError(f"{self.name}: audit columns missing from schema: {missing}")
        if self.extracted_col is not None and self.extracted_col not in names:
            raise ValueError(f"{self.name}: extracted column {self.extracted_col} not in schema")

    @property
    def target_columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def derived_columns(self) -> set[str]:
        """Columns with no mapped source: key, audit and extraction-time columns."""
        out = {self.key_col}
        if self.audit is not None:
            out.update(self.audit.columns)
        if self.extracted_col is not None:
            out.add(self.extracted_col)
        return out

    @property
    def data_fields(self) -> list[StructField]:
        """Target fields that come from the source, in schema order."""
        derived = self.derived_columns
        return [f for f in self.schema.fields if f.name not in derived]

    def key_inputs(self) -> list[str]:
        """Columns whose text forms the row hash, in a fixed order."""
        if self.hash_cols is not None:
            return list(self.hash_cols)
        return [f.name for f in self.data_fields]

    def policy_for(self, col_name: str) -> str:
        return self.future_policy.get(col_name, "keep")


_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "timestamp": TimestampType(),
    "date": DateType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
}


def parse_type(text: str) -> DataType:
    """``string``/``timestamp``/``date``/``double``/``boolean``/``decimal(p,s)``."""
    t = text.strip().lower()
    if t in _TYPES:
        return _TYPES[t]
    if t.startswith("decimal(") and t.endswith(")"):
        p, s = (int(x) for x in t[len("decimal("):-1].split(","))
        return DecimalType(p, s)
    raise ValueError(f"unsupported target type {text!r}")


def make_spec(
    name: str,
    key_col: str,
    columns: list[tuple],
    *,
    aliases: Mapping[str, str] | None = None,
    json_cols: tuple[str, ...] = (),
    bool_string_cols: tuple[str, ...] = (),
    future_policy: Mapping[str, str] | None = None,
    audit: AuditSpec | None = DEFAULT_AUDIT,
    hash_cols: tuple[str, ...] | None = None,
    time_zone: str | None = None,
    extracted_col: str | None = None,
) -> TableSpec:
    """Build a spec from ``(source_name or None, target_name, type[, nullable])`` rows.

    The key column is added first and the audit columns last, so ``columns``
    holds only the source-fed columns. ``aliases`` adds extra source spellings.
    ``extracted_col`` adds a timestamp column, before the audit columns, that
    keeps the extraction time the sync stamped on the raw rows (the ingest
    stamp would otherwise overwrite it).
    """
    fields = [StructField(key_col, StringType(), True)]
    mapping: dict[str, str] = {}
    for row in columns:
        src, dst, typ = row[:3]
        nullable = row[3] if len(row) > 3 else True
        fields.append(StructField(dst, parse_type(typ), nullable))
        if src:
            mapping[src.lower()] = dst
    for src, dst in (aliases or {}).items():
        mapping[src.lower()] = dst
    if extracted_col is not None:
        fields.append(StructField(extracted_col, TimestampType(), True))
    if audit is not None:
        fields.extend(audit.fields())
    return TableSpec(
        name=name,
        schema=StructType(fields),
        mapping=mapping,
        key_col=key_col,
        json_cols=frozenset(json_cols),
        bool_string_cols=frozenset(bool_string_cols),
        future_policy=dict(future_policy or {}),
        audit=audit,
        hash_cols=hash_cols,
        time_zone=time_zone,
        extracted_col=extracted_col,
    )
