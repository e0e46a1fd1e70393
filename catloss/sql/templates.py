"""Analyst SQL over the published outputs (Q1-Q8), as Spark SQL.

The outputs are registered as views named like the published tables (W7):
``ep_report``, ``mts_tbl_ylt_combined_all_factors``,
``mts_tbl_ylt_combined_all_factors_wide``, ``mts_tbl_ylt_dialsup`` and the seeds
under their stems. Portfolio filters are named parameters; ``None`` means every
portfolio. Columns that depend on the forecast months are generated from the
months present in the data (the reference asks analysts to edit them by hand).
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catloss.operators.main_stream import MAIN_STAGES

MAIN_TABLE = "mts_tbl_ylt_combined_all_factors"
WIDE_TABLE = "mts_tbl_ylt_combined_all_factors_wide"
DIALSUP_TABLE = "mts_tbl_ylt_dialsup"
REPORT_TABLE = "ep_report"
CORE_TABLES = (REPORT_TABLE, MAIN_TABLE, WIDE_TABLE, DIALSUP_TABLE)


PORTFOLIO_FILTER = (
    "(:rollup_lob IS NULL OR rollup_lob = :rollup_lob) AND (:rollup_peril IS NULL OR rollup_peril = :rollup_peril)"
)
# Place of a metric in the stream; others come last.
STAGE_ORDER = f"coalesce(nullif(array_position(array({', '.join(map(repr, MAIN_STAGES))}), metric), 0), {len(MAIN_STAGES) + 1})"


def _args(rollup_lob: str | None, rollup_peril: str | None) -> dict:
    return {"rollup_lob": rollup_lob, "rollup_peril": rollup_peril}


# --- Q1 inventory ---------------------------------------------------------------
def inventory_row_counts(spark: SparkSession) -> DataFrame:
    """Row counts of the core tables (one UNION ALL job)."""
    parts = " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS rows FROM {t}" for t in CORE_TABLES)
    return spark.sql(f"SELECT * FROM ({parts}) ORDER BY table_name")


def _data_type(data_type: T.DataType) -> str:
    return {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE"}.get(
        data_type.simpleString(), data_type.simpleString().upper())


def _table_columns(spark: SparkSession, table: str) -> DataFrame:
    """One row a column of ``table``: its type and, from one pass over the rows, what it holds."""
    df = spark.table(table)

    def described(i: int, f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        number = isinstance(f.dataType, T.NumericType)
        as_number = c.cast("double") if number else F.lit(None).cast("double")
        as_text = F.lit(None).cast("string") if number else c.cast("string")
        return F.struct(
            F.lit(i).alias("ordinal_position"), F.lit(f.name).alias("column_name"), F.lit(_data_type(f.dataType)).alias("data_type"),
            F.count("*").alias("rows"), (F.count("*") - F.count(c)).alias("null_rows"),
            F.min(as_number).alias("min_number"), F.max(as_number).alias("max_number"),
            F.min(as_text).alias("min_text"), F.max(as_text).alias("max_text"))

    columns = df.agg(F.array(*[described(i, f) for i, f in enumerate(df.schema.fields, 1)]).alias("columns"))
    return columns.select(F.lit(table).alias("table_name"), F.inline("columns"))


def inventory_columns(spark: SparkSession, tables: Sequence[str] = CORE_TABLES) -> DataFrame:
    """Column dictionary with statistics: rows, nulls, least and greatest value of every column.

    Numbers have their bounds as doubles, other types as text; an empty or all-null
    column has none. Each table is read once, and a task sends one row.
    """
    parts = [_table_columns(spark, t) for t in tables]
    return functools.reduce(DataFrame.unionByName, parts).orderBy("table_name", "ordinal_position")


def wide_loss_columns(spark: SparkSession) -> list[str]:
    """Generated ``%_loss`` columns of the wide table, in order."""
    return [c for c in spark.table(WIDE_TABLE).columns if c.endswith("_loss")]


# --- Q2 / Q3 EP report ----------------------------------------------------------
def report_totals(spark: SparkSession) -> DataFrame:
    return spark.sql(f"""
SELECT forecast_date, metric, ep_type, COUNT(*) AS rows, SUM(loss) AS total_loss
FROM {REPORT_TABLE}
GROUP BY 1, 2, 3
ORDER BY forecast_date, metric, ep_type""")


def report_losses_by_portfolio(spark: SparkSession) -> DataFrame:
    return spark.sql(f"""
SELECT forecast_date, metric, base_model, rollup_lob, rollup_peril, ep_type, return_period, loss
FROM {REPORT_TABLE}
ORDER BY forecast_date, metric, rollup_lob, rollup_peril, ep_type, return_period""")


def top_losses(spark: SparkSession, n: int = 100) -> DataFrame:
    """Largest reported EP losses (ties broken by the report key so the top n is stable)."""
    return spark.sql(f"""
SELECT forecast_date, metric, base_model, rollup_lob, rollup_peril, ep_type, return_period, rank, rp, loss
FROM {REPORT_TABLE}
ORDER BY loss DESC, forecast_date, metric, base_model, rollup_lob, rollup_peril, ep_type, return_period
LIMIT {int(n)}""")


# --- Q4 wide templates -------------------------------------------------------------
def wide_events(spark: SparkSession, month: str, rollup_lob: str | None = None,
                rollup_peril: str | None = None, n: int = 500) -> DataFrame:
    main_col, dial_col = f"euws_override_{month}_loss", f"dialsup_localccy_forecast_{month}_loss"
    return spark.sql(f"""
SELECT base_model, rollup_lob, rollup_peril, modelled_lob, modelled_peril, year_id, event_id, model_event_id,
       event_day, rnk, rp, risklink_blended_contribution, verisk_blended_contribution,
       uplift_factor_on_base_model, {main_col}, {dial_col}
FROM {WIDE_TABLE}
WHERE {PORTFOLIO_FILTER}
ORDER BY {main_col} DESC NULLS LAST, {dial_col} DESC NULLS LAST, base_model, year_id, event_id,
         rollup_lob, rollup_peril, modelled_lob, modelled_peril, rnk, analysis_id, vendor, model_code
LIMIT {int(n)}""", args=_args(rollup_lob, rollup_peril))


def wide_portfolio_check(spark: SparkSession, month: str, rollup_lob: str | None = None,
                         rollup_peril: str | None = None) -> DataFrame:
    return spark.sql(f"""
SELECT base_model, rollup_lob, rollup_peril, COUNT(*) AS rows,
       AVG(uplift_factor_on_base_model) AS avg_blend_factor,
       SUM(euws_override_{month}_loss) AS final_main_loss,
       SUM(dialsup_localccy_forecast_{month}_loss) AS final_dialsup_loss
FROM {WIDE_TABLE}
WHERE {PORTFOLIO_FILTER}
GROUP BY 1, 2, 3
ORDER BY final_main_loss DESC NULLS LAST""", args=_args(rollup_lob, rollup_peril))


def wide_months(spark: SparkSession) -> list[str]:
    """Forecast months (YYYYMM) that the wide table has both loss columns of."""
    have = set(wide_loss_columns(spark))
    months = sorted(c.split("_")[-2] for c in have if c.startswith("euws_override_"))
    return [m for m in months if f"dialsup_localccy_forecast_{m}_loss" in have]


def wide_portfolio_months(spark: SparkSession, rollup_lob: str | None = None, rollup_peril: str | None = None) -> DataFrame:
    """The portfolio check of every forecast month, from one aggregation: a row per portfolio and month."""
    months = wide_months(spark)
    sums = ", ".join(f"SUM(euws_override_{m}_loss) AS main_{m}, SUM(dialsup_localccy_forecast_{m}_loss) AS dialsup_{m}" for m in months)
    rows = ", ".join(f"'{m}', main_{m}, dialsup_{m}" for m in months)
    return spark.sql(f"""
SELECT base_model, rollup_lob, rollup_peril, rows, avg_blend_factor,
       stack({len(months)}, {rows}) AS (forecast_month, final_main_loss, final_dialsup_loss)
FROM (SELECT base_model, rollup_lob, rollup_peril, COUNT(*) AS rows,
             AVG(uplift_factor_on_base_model) AS avg_blend_factor, {sums}
      FROM {WIDE_TABLE}
      WHERE {PORTFOLIO_FILTER}
      GROUP BY 1, 2, 3)
ORDER BY forecast_month, final_main_loss DESC NULLS LAST""", args=_args(rollup_lob, rollup_peril))


# --- Q5 / Q6 long waterfall ----------------------------------------------------------
def _stage_sum(metric: str, date: str | None = None) -> str:
    cond = f"metric = '{metric}'" + (f" AND forecast_date = DATE '{date}'" if date else "")
    return f"SUM(CASE WHEN {cond} THEN loss END)"


def portfolio_waterfall(spark: SparkSession, dates: list[str], rollup_lob: str | None = None,
                        rollup_peril: str | None = None) -> DataFrame:
    """Original loss through each main stage, forecast dates pivoted into columns."""
    cols = [
        f"{_stage_sum('original')} AS original_loss",
        "AVG(uplift_factor_on_base_model) FILTER (WHERE metric = 'blended') AS avg_blend_factor",
        f"{_stage_sum('blended')} AS blended_loss",
        f"{_stage_sum('localccy')} AS localccy_loss",
    ]
    for d in dates:
        m = d.replace("-", "")[:6]
        cols += [
            f"{_stage_sum('localccy_forecast', d)} AS localccy_forecast_{m}_loss",
            f"{_stage_sum('euws', d)} AS euws_{m}_loss",
            f"{_stage_sum('euws_override', d)} AS final_euws_override_{m}_loss",
        ]
    first = f"final_euws_override_{dates[0].replace('-', '')[:6]}_loss" if dates else "original_loss"
    return spark.sql(f"""
SELECT base_model, rollup_lob, rollup_peril, {', '.join(cols)}
FROM {MAIN_TABLE}
WHERE {PORTFOLIO_FILTER}
GROUP BY 1, 2, 3
ORDER BY {first} DESC NULLS LAST""", args=_args(rollup_lob, rollup_peril))


def stage_counts(spark: SparkSession, rollup_lob: str | None = None, rollup_peril: str | None = None) -> DataFrame:
    return spark.sql(f"""
SELECT forecast_date, base_model, rollup_lob, rollup_peril, metric, COUNT(*) AS rows, SUM(loss) AS loss
FROM {MAIN_TABLE}
WHERE {PORTFOLIO_FILTER}
GROUP BY 1, 2, 3, 4, 5
ORDER BY forecast_date, base_model, {STAGE_ORDER}""", args=_args(rollup_lob, rollup_peril))


def event_waterfall(spark: SparkSession, rollup_lob: str | None = None, rollup_peril: str | None = None,
                    n: int = 500) -> DataFrame:
    """Event-level rows ordered by transform stage (ties broken by the remaining identity)."""
    return spark.sql(f"""
SELECT forecast_date, base_model, rollup_lob, rollup_peril, modelled_lob, modelled_peril, year_id, event_id,
       model_event_id, event_day, rnk, rp, metric, loss, uplift_factor_on_base_model,
       risklink_blended_contribution, verisk_blended_contribution
FROM {MAIN_TABLE}
WHERE {PORTFOLIO_FILTER}
ORDER BY year_id, event_id, forecast_date, {STAGE_ORDER}, base_model, rollup_lob, rollup_peril, modelled_lob,
         modelled_peril, rnk, analysis_id, vendor, model_code, loss
LIMIT {int(n)}""", args=_args(rollup_lob, rollup_peril))


# --- Q7 seed checks ------------------------------------------------------------------
def seed_checks(spark: SparkSession) -> dict[str, DataFrame]:
    """Small tables to read the seeds by: mappings, peril candidates and flags, rates, factor ranges."""
    flags = [F.sum(f).alias(f"{f.removeprefix('is_')}_candidates") for f in ("is_dialsup", "is_euws")]
    perils = spark.table("perils").groupBy("rollup_peril", "base_model")
    factors = spark.table("forecast_factors").groupBy("forecast_date")
    return {
        "lob_mappings": spark.table("lobs").select("rollup_lob", "modelled_lob", "lob_type", "office", "class", "currency")
        .orderBy("rollup_lob", "modelled_lob"),
        "peril_flags": perils.agg(
            F.count("*").alias("candidates"), *flags, F.min("selection_priority").alias("best_selection_priority")
        ).orderBy("rollup_peril", "base_model"),
        "fx_rates": spark.table("fx_rates").orderBy("currency_code", "rate_date"),
        "forecast_factors": factors.agg(
            F.count("*").alias("rows"), F.min("factor").alias("min_factor"), F.max("factor").alias("max_factor")
        ).orderBy("forecast_date"),
    }


# --- Q8 export -------------------------------------------------------------------------
def export_example(spark: SparkSession, path: str, n: int = 100) -> str:
    """Filtered CSV extract of final main rows (header, comma)."""
    df = spark.table(MAIN_TABLE).where(F.col("metric") == "euws_override").limit(int(n))
    df.write.mode("overwrite").option("header", True).csv(path)
    return path
