"""Declarative contracts of the input tables, compiled to Spark expressions.

A contract names a table's columns with their types, whether they must have that type or
be castable to it, and rules on columns: values required, ranges, allowed values. From one
compilation (``row_checks``) come the violation counts of a table, in one aggregation pass
(``evaluate_contract``), and the violating rows themselves, in one scan (``violations``).
Contracts are the constants below or are read from rule files (``read_contract``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catloss.functions.exprs import strip_ws


@dataclass(frozen=True)
class Rule:
    """One rule over one column: ``not_null``, ``valid_range`` (min/max) or ``valid_values``."""

    code: str
    column: str
    kind: str
    min: float | None = None
    max: float | None = None
    values: Sequence[Any] = field(default_factory=tuple)


@dataclass(frozen=True)
class TableContract:
    """``schema_matches``: expected columns and types; strict or castable; extras allowed?"""

    table: str
    code: str
    columns: dict[str, str]
    mode: str = "strict"
    allow_extra_columns: bool = True
    rules: tuple[Rule, ...] = ()


RULE_KINDS = ("not_null", "valid_range", "valid_values")


def _broken(rule: Rule, kind: str) -> Column:
    """Whether a row breaks the rule. Of raw text, blanks count as missing and only what can be cast has a range."""
    c, text = F.col(f"`{rule.column}`"), kind == "string"
    if rule.kind == "not_null":
        return c.isNull() | (strip_ws(c) == "") if text else c.isNull()
    if rule.kind == "valid_range":
        number = c.try_cast("double") if text else c
        bounds = [number < F.lit(rule.min)] * (rule.min is not None) + [number > F.lit(rule.max)] * (rule.max is not None)
        return F.coalesce(F.greatest(*bounds, F.lit(False)) if bounds else F.lit(False), F.lit(False))
    if rule.kind == "valid_values":
        return c.isNotNull() & ~c.cast("string").isin([str(v) for v in rule.values])
    raise ValueError(f"unknown rule kind {rule.kind!r}")


def row_checks(df: DataFrame, contract: TableContract) -> list[tuple[str, str, str, Column]]:
    """(code, check, column, condition of a violating row) of every check that looks at rows."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    checks = []
    if contract.mode == "castable":
        for name, kind in contract.columns.items():
            if name in kinds:
                c = F.col(f"`{name}`")
                checks.append((contract.code, "schema_castable", name, c.isNotNull() & c.try_cast(kind).isNull()))
    checks += [(r.code, r.kind, r.column, _broken(r, kinds[r.column])) for r in contract.rules if r.column in kinds]
    return checks


def schema_checks(df: DataFrame, contract: TableContract) -> list[tuple[str, int]]:
    """(column, 1 if it is missing, of another type, or not allowed, else 0); no job."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    found = [(c, int(c not in kinds or (contract.mode == "strict" and kinds[c] != kind))) for c, kind in contract.columns.items()]
    return found + [(c, 1) for c in kinds if c not in contract.columns and not contract.allow_extra_columns]


def evaluate_contract(df: DataFrame, contract: TableContract) -> DataFrame:
    """One row per check: (table, code, check, column, violations); all rows are looked at in one pass."""
    schema = "table string, code string, check string, column string, violations long"
    out = df.sparkSession.createDataFrame([(contract.table, contract.code, "schema_matches", c, n) for c, n in schema_checks(df, contract)], schema)
    checks = row_checks(df, contract)
    if checks:
        counts = df.agg(*[F.count_if(bad).cast("long").alias(f"_{i}") for i, (*_, bad) in enumerate(checks)])
        rows = [
            F.struct(F.lit(contract.table).alias("table"), F.lit(code).alias("code"), F.lit(check).alias("check"), F.lit(c).alias("column"), F.col(f"_{i}").alias("violations"))
            for i, (code, check, c, _) in enumerate(checks)
        ]
        out = out.unionByName(counts.select(F.inline(F.array(*rows))))
    return out


def violations(df: DataFrame, contract: TableContract, key: str) -> DataFrame:
    """One row per violation: (table, code, check, column, key, value), from one scan without a shuffle."""
    found = [
        F.when(bad, F.struct(F.lit(contract.table).alias("table"), F.lit(code).alias("code"), F.lit(check).alias("check"), F.lit(c).alias("column"),
                             F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{c}`").cast("string").alias("value")))
        for code, check, c, bad in row_checks(df, contract)
    ]
    return df.select(F.inline(F.filter(F.array(*found), lambda x: x.isNotNull())))


# --- rule files
# Type names in rule files.
FILE_TYPES = {"string": "string", "int64": "bigint", "int32": "int", "float64": "double", "date": "date", "datetime": "timestamp_ntz", "boolean": "boolean"}


def parse_contract(text: str, table: str) -> TableContract:
    """The contract that a rule file (YAML) declares for ``table``."""
    import yaml

    code, columns, mode, extra, rules = f"{table.upper()}_SCHEMA", {}, "castable", True, []
    for declared in (yaml.safe_load(text) or {}).get("rules") or ():
        for check in declared.get("checks") or ():
            kind = check["type"]
            if kind == "schema_matches":
                unknown = sorted(set(check["columns"].values()).difference(FILE_TYPES))
                if unknown:
                    raise ValueError(f"{table}: {declared['code']} has unknown types {unknown}")
                code, mode, extra = declared["code"], check.get("mode", "strict"), check.get("allow_extra_columns", True)
                columns = {c: FILE_TYPES[t] for c, t in check["columns"].items()}
            elif kind in RULE_KINDS:
                on = check.get("columns") or [check.get("column") or declared.get("column")]
                if None in on:
                    raise ValueError(f"{table}: {declared['code']} names no column")
                rules += [Rule(declared["code"], c, kind, check.get("min"), check.get("max"), tuple(check.get("values") or ())) for c in on]
            else:
                raise ValueError(f"{table}: {declared['code']} has a check of unknown type {kind!r}")
    return TableContract(table, code, columns, mode, extra, tuple(rules))


def read_contract(spark: SparkSession, path: str, table: str) -> TableContract:
    """``parse_contract`` of a file in any store that Spark reads."""
    return parse_contract(spark.read.text(path, wholetext=True).first()[0], table)


# --- Fixed values: the contracts of the twelve input tables.
def _contract(table: str, code: str, columns: str, *rules: tuple, mode: str = "castable", extra: bool = False) -> TableContract:
    """``columns`` and the columns of a rule are written out with blanks between; "" means all."""
    kinds = dict(c.split(":") for c in columns.split())
    made = [Rule(f"{code}_{name}", c, kind, **kw) for name, kind, on, kw in rules for c in (on.split() or kinds)]
    return TableContract(table, f"{code}_SCHEMA", kinds, mode, extra, tuple(made))


POSITIVE = {"min": 0}
FLAG = {"values": ("0", "1")}
CONTRACTS = {c.table: c for c in (
    _contract(
        "verisk_ylt", "VERISK_YLT", "Analysis:string ExposureAttribute:string CatalogTypeCode:string EventID:bigint ModelCode:bigint YearID:bigint GroundUpLoss:double",
        ("REQUIRED_VALUES", "not_null", "", {}), ("NON_NEGATIVE_VALUES", "valid_range", "EventID ModelCode YearID GroundUpLoss", POSITIVE), mode="strict", extra=True),
    _contract(
        "risklink_ylt", "RISKLINK_YLT", "anlsid:bigint yearid:bigint eventid:bigint loss:double",
        ("REQUIRED_VALUES", "not_null", "", {}), ("NON_NEGATIVE_VALUES", "valid_range", "", POSITIVE), mode="strict", extra=True),
    _contract(
        "ep_summaries", "EP_SUMMARY", "vendor:string analysis_id:string modelled_lob:string modelled_peril:string ep_type:string return_period:bigint loss:double",
        ("REQUIRED_VALUES", "not_null", "", {}), ("VENDOR", "valid_values", "vendor", {"values": ("verisk", "risklink")}),
        ("EP_TYPE", "valid_values", "ep_type", {"values": ("AAL", "AEP", "OEP")}), ("NON_NEGATIVE_NUMBERS", "valid_range", "return_period loss", POSITIVE)),
    _contract(
        "verisk_events", "VERISK_EVENTS", "EventID:bigint ModelID:bigint Event:bigint Year:bigint Day:bigint",
        ("REQUIRED_VALUES", "not_null", "", {}), ("NON_NEGATIVE_VALUES", "valid_range", "", POSITIVE), mode="strict", extra=True),
    _contract(
        "risklink_flood22_model_events", "RISKLINK_FLOOD_EVENTS", "ModelEventID:bigint ModelOccurrenceYear:bigint RegionPerilID:bigint ModelOccurrenceDate:date",
        ("REQUIRED_VALUES", "not_null", "", {}), ("NON_NEGATIVE_IDS", "valid_range", "ModelEventID ModelOccurrenceYear RegionPerilID", POSITIVE), extra=True),
    _contract(
        "euws_rate_factors", "EUWS_RATE_FACTORS", "model_event_id:bigint occ_year:bigint factor:double",
        ("REQUIRED_VALUES", "not_null", "", {}), ("NON_NEGATIVE_VALUES", "valid_range", "", POSITIVE)),
    _contract(
        "lobs", "LOBS", "lob_id:bigint modelled_lob:string rollup_lob:string lob_type:string cds_cat_class_name:string office:string class:string currency:string",
        ("REQUIRED_VALUES", "not_null", "", {}), ("NON_NEGATIVE_ID", "valid_range", "lob_id", POSITIVE)),
    _contract(
        "perils", "PERILS", "modelled_peril:string rollup_peril:string region:string peril:string region_peril_id:bigint blend_subregion_peril_id:string "
        "base_model:string selection_priority:bigint is_dialsup:bigint is_euws:bigint",
        ("REQUIRED_VALUES", "not_null", "", {}), ("NON_NEGATIVE_NUMBERS", "valid_range", "region_peril_id selection_priority", POSITIVE),
        ("DIALSUP_FLAG", "valid_values", "is_dialsup", FLAG), ("EUWS_FLAG", "valid_values", "is_euws", FLAG)),
    _contract(
        "blending_factors", "BLENDING_FACTORS", "id:bigint BlendSetID:bigint RegionPerilID:bigint RegionPeril:string SubRegionPerilID:string SubRegionPeril:string "
        "AIRBlend:double RMSBlend:double KatRiskBlend:double DateCreated:string",
        ("REQUIRED_VALUES", "not_null", "id BlendSetID RegionPerilID RegionPeril SubRegionPerilID AIRBlend RMSBlend KatRiskBlend DateCreated", {}),
        ("RANGES", "valid_range", "id BlendSetID RegionPerilID", POSITIVE), ("RANGES", "valid_range", "AIRBlend RMSBlend KatRiskBlend", {"min": 0, "max": 1})),
    _contract(
        "fx_rates", "FX_RATES", "currency_code:string target_currency:string rate_date:string rate:double",
        ("REQUIRED_VALUES", "not_null", "", {}), ("POSITIVE_RATE", "valid_range", "rate", POSITIVE)),
    _contract(
        "forecast_factors", "FORECAST_FACTORS", "class:string office:string office_iso2:string forecast_date:string factor:double",
        ("REQUIRED_VALUES", "not_null", "", {}), ("NON_NEGATIVE_FACTOR", "valid_range", "factor", POSITIVE)),
    _contract(
        "euws_rank_overrides", "EUWS_RANK_OVERRIDES", "rollup_lob:string max_rank:bigint factor:double",
        ("REQUIRED_VALUES", "not_null", "", {}), ("NON_NEGATIVE_VALUES", "valid_range", "max_rank factor", POSITIVE)),
)}
