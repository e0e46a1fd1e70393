"""Registered queries: name -> (spark callable, DuckDB oracle SQL).

Every query reads the driver's test tables through the bridge, so its work grows
with them. Doubles that come out of an aggregation are rounded the same way on
both sides (summation order differs between engines); per-row doubles are
compared as they are.
"""

from __future__ import annotations

import functools
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catloss import schemas as SC
from catloss.operators import contracts as CT
from catloss.operators import ep_convert as EC
from catloss.operators import quality as QL
from catloss.operators import report as RP
from catloss.operators import wide as WD
from catloss.params import RunParams
from catloss.plans import oracle as O
from catloss.plans.frames import STREAMS, RunFrames
from catloss.plans.oracle_tables import with_table_ctes
from catloss.sources import bridge as B
from catloss.sources import raw_seeds as RS
from catloss.sources.table_bridge import table_inputs
from catloss.sql import templates as TPL

def frames(spark: SparkSession, sf_dir: str, streams: tuple[str, ...] = STREAMS, **bridge_kw) -> RunFrames:
    return RunFrames(B.bridge_inputs(spark, sf_dir, **bridge_kw), RunParams(), streams)


# Registered results with averages or sums are rounded on both sides of the comparison, as
# the two engines add in different orders: averages to 6 decimals, sums to 2. floor(x * k +
# SHIFT) / k is the same IEEE operations in both (their ``round`` functions differ at ties).
AVERAGE, SUM = 1e6, 1e2
# Sums of decimal losses often lie at exact halves, where the last bit would decide; this
# shift, in place of 0.5, puts the steps where none lie.
SHIFT = 0.2718


def _rounded(df: DataFrame, cols: dict[str, float]) -> DataFrame:
    return df.select(*[
        (F.floor(F.col(c) * F.lit(cols[c]) + F.lit(SHIFT)) / F.lit(cols[c])).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ])


def _sums(df: DataFrame, *also: str) -> DataFrame:
    """Round the columns of summed losses."""
    return _rounded(df, {c: SUM for c in df.columns if c.endswith("loss") or c in also})


def _sql_rounded(x: str, k: float = AVERAGE) -> str:
    return f"floor({x} * {k!r} + {SHIFT}) / {k!r}"


def _xsum(x: str) -> str:
    return _sql_rounded(f"SUM({x})", SUM)


def _sql_sums(source: str, *cols: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'{_sql_rounded(c, SUM)} AS {c}' for c in cols)}) FROM {source}"


def _bridge_dates() -> list[str]:
    return sorted({r[3] for r in B.FORECAST_FACTORS})


def register_output_views(fr: RunFrames, wide: bool = True) -> None:
    """The published outputs and seeds as session views, named like the tables.

    The wide view needs one job to find its forecast-month columns, so templates that
    do not read it can skip it (``wide=False``).
    """
    fr.main_long.createOrReplaceTempView(TPL.MAIN_TABLE)
    fr.dialsup_long.createOrReplaceTempView(TPL.DIALSUP_TABLE)
    if wide:
        fr.wide_output(check_grain=False).createOrReplaceTempView(TPL.WIDE_TABLE)
    fr.ep_report(order=False).createOrReplaceTempView(TPL.REPORT_TABLE)
    for stem, df in fr.inputs.seeds.items():
        df.createOrReplaceTempView(stem)


# --- spark side -------------------------------------------------------------------
def _q(attr: str, *streams: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(frames(spark, sf_dir, streams or STREAMS), attr)

    run.__name__ = attr
    return run


def _ep(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A result of the EP branch over EP summaries and seeds from the tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return RunFrames(table_inputs(spark, sf_dir), RunParams()).ep[name]

    run.__name__ = name
    return run


def q_ylt_enriched(spark, sf_dir):
    return frames(spark, sf_dir).enriched("main")


def q_ylt_base_selected(spark, sf_dir):
    return frames(spark, sf_dir).base_selected("main")


def q_ylt_ranked(spark, sf_dir):
    return frames(spark, sf_dir).ranked_single("main", strategy="window")


def q_ylt_ranked_range(spark, sf_dir):
    return frames(spark, sf_dir).ranked_single("main", strategy="range")


def q_ylt_ranked_shared(spark, sf_dir):
    return frames(spark, sf_dir, ("main",)).ranked("main")


def q_ylt_ranked_dialsup(spark, sf_dir):
    return frames(spark, sf_dir, ("dialsup",)).ranked("dialsup")


def q_wide_output(spark, sf_dir):
    return frames(spark, sf_dir).wide_output()


def q_duplicate_grain(spark, sf_dir):
    return WD.duplicate_grain(frames(spark, sf_dir).wide_source)


def q_duplicate_grain_repeats(spark, sf_dir):
    """Over a catalogue that lists some events twice."""
    return WD.duplicate_grain(frames(spark, sf_dir, repeat_events=True).wide_source)


def q_aal_report(spark, sf_dir):
    return _sums(RP.aal(frames(spark, sf_dir).report_annual))


def q_annual_aep(spark, sf_dir):
    return frames(spark, sf_dir).report_annual.select(*RP.REPORT_KEYS, "year_id", F.col("aep").alias("loss")).transform(_sums)


def q_annual_oep(spark, sf_dir):
    return frames(spark, sf_dir).report_annual.select(*RP.REPORT_KEYS, "year_id", F.col("oep").alias("loss"))


def q_ep_report(spark, sf_dir):
    return _sums(frames(spark, sf_dir).ep_report())


def q_ep_wide_to_long(spark, sf_dir):
    return EC.ep_wide_to_long(B.ep_wide(spark, sf_dir), "verisk", source="customer")


def q_dimension_coverage(spark, sf_dir):
    return QL.dimension_coverage(frames(spark, sf_dir).inputs)


def q_input_aal_summary(spark, sf_dir):
    fr = frames(spark, sf_dir, lob_mod=5, include_unmapped=False)
    return _sums(QL.input_aal_summary(fr.inputs, fr.params), "loss_sum", "raw_aal")


def q_quality_rules(spark, sf_dir):
    return QL.quality_report(frames(spark, sf_dir).inputs)


def q_quality_rules_raw(spark, sf_dir):
    return CT.evaluate_contract(B.ep_raw(spark, sf_dir), CT.CONTRACTS["ep_summaries"])


def q_quality_rules_seeds(spark, sf_dir):
    parts = [CT.evaluate_contract(RS.raw_seed(spark, sf_dir, t), CT.CONTRACTS[t]) for t in RS.RAW_SEEDS]
    return functools.reduce(DataFrame.unionByName, parts)


def q_quality_violations(spark, sf_dir):
    parts = [CT.violations(RS.raw_seed(spark, sf_dir, t), CT.CONTRACTS[t], RS.KEY) for t in RS.RAW_SEEDS]
    return functools.reduce(DataFrame.unionByName, parts)


def _with_views(spark, sf_dir, wide: bool = False) -> RunFrames:
    fr = frames(spark, sf_dir)
    register_output_views(fr, wide=wide)
    return fr


def q_inventory_counts(spark, sf_dir):
    _with_views(spark, sf_dir, wide=True)
    return TPL.inventory_row_counts(spark)


def q_inventory_columns(spark, sf_dir):
    _with_views(spark, sf_dir, wide=True)
    loss_bounds = F.when(F.col("table_name") == TPL.REPORT_TABLE, F.lit(SUM)).otherwise(F.lit(AVERAGE))
    rounded = {c: (F.floor(F.col(c) * loss_bounds + F.lit(SHIFT)) / loss_bounds).alias(c) for c in ("min_number", "max_number")}
    df = TPL.inventory_columns(spark)
    return df.select(*[rounded.get(c, F.col(c)) for c in df.columns])


def q_wide_check_months(spark, sf_dir):
    _with_views(spark, sf_dir, wide=True)
    return _rounded(_sums(TPL.wide_portfolio_months(spark)), {"avg_blend_factor": AVERAGE})


def q_report_totals(spark, sf_dir):
    _with_views(spark, sf_dir)
    return _sums(TPL.report_totals(spark))


def q_top_losses(spark, sf_dir):
    _with_views(spark, sf_dir)
    return _sums(TPL.top_losses(spark))


def q_wide_events(spark, sf_dir):
    _with_views(spark, sf_dir, wide=True)
    month = TPL.wide_loss_columns(spark)[0].split("_")[-2]
    return TPL.wide_events(spark, month)


def q_wide_check(spark, sf_dir):
    _with_views(spark, sf_dir, wide=True)
    month = TPL.wide_loss_columns(spark)[0].split("_")[-2]
    return _rounded(_sums(TPL.wide_portfolio_check(spark, month)), {"avg_blend_factor": AVERAGE})


def q_portfolio_waterfall(spark, sf_dir):
    fr = _with_views(spark, sf_dir)
    dates = WD.forecast_months(fr.wide_source, fr.candidate_dates)
    return _rounded(_sums(TPL.portfolio_waterfall(spark, dates)), {"avg_blend_factor": AVERAGE})


def q_stage_counts(spark, sf_dir):
    _with_views(spark, sf_dir)
    return _sums(TPL.stage_counts(spark))


def q_event_waterfall(spark, sf_dir):
    _with_views(spark, sf_dir)
    return TPL.event_waterfall(spark)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stage_verisk_ylt": _q("stg_verisk_ylt"),
    "stage_risklink_ylt": _q("stg_risklink_ylt"),
    "stage_verisk_events": _q("verisk_events"),
    "stage_risklink_events": _q("risklink_events"),
    "normalize_ylt": _q("normalized"),
    **{name: _ep(name) for name in ("ep_enriched", "ep_selected_main", "ep_selected_dialsup", "ep_vendor_joined", "ep_target_points", "blend_weights", "ep_blending_targets")},
    "ylt_enriched": q_ylt_enriched,
    "ylt_base_selected": q_ylt_base_selected,
    "ylt_ranked": q_ylt_ranked,
    "ylt_ranked_range": q_ylt_ranked_range,
    "ylt_ranked_shared": q_ylt_ranked_shared,
    "ylt_ranked_dialsup": q_ylt_ranked_dialsup,
    "ylt_blended": _q("blended", "main"),
    "ylt_local_currency": _q("localccy", "main"),
    "ylt_forecast": _q("forecasted", "main"),
    "ylt_event_factor": _q("euws", "main"),
    "ylt_rank_override": _q("euws_override", "main"),
    "main_metric_stream": _q("main_stream", "main"),
    "dialsup_factor_base": _q("dialsup_factor_base", "dialsup"),
    "dialsup_metrics": _q("dialsup_stream", "dialsup"),
    "main_long": _q("main_long", "main"),
    "dialsup_long": _q("dialsup_long", "dialsup"),
    "main_fanout": _q("main_fanout", "main"),
    "dialsup_fanout": _q("dialsup_fanout", "dialsup"),
    "event_validation": _q("event_validation"),
    "wide_output": q_wide_output,
    "duplicate_grain": q_duplicate_grain,
    "duplicate_grain_repeats": q_duplicate_grain_repeats,
    "aal_report": q_aal_report,
    "annual_aep": q_annual_aep,
    "annual_oep": q_annual_oep,
    "ep_report": q_ep_report,
    "ep_wide_to_long": q_ep_wide_to_long,
    "dimension_coverage": q_dimension_coverage,
    "input_aal_summary": q_input_aal_summary,
    "quality_rules": q_quality_rules,
    "quality_rules_raw": q_quality_rules_raw,
    "quality_rules_seeds": q_quality_rules_seeds,
    "quality_violations": q_quality_violations,
    "q_inventory_counts": q_inventory_counts,
    "q_report_totals": q_report_totals,
    "q_top_losses": q_top_losses,
    "q_wide_events": q_wide_events,
    "q_wide_check": q_wide_check,
    "q_inventory_columns": q_inventory_columns,
    "q_wide_check_months": q_wide_check_months,
    "q_portfolio_waterfall": q_portfolio_waterfall,
    "q_stage_counts": q_stage_counts,
    "q_event_waterfall": q_event_waterfall,
}


# --- oracle side ----------------------------------------------------------------------
def _wide_source_oracle() -> str:
    dims = ", ".join(SC.WIDE_IDENTITY)
    return (
        f"SELECT {dims}, metric, forecast_date FROM main_long WHERE metric = 'euws_override' UNION ALL "
        f"SELECT {dims}, metric, forecast_date FROM dialsup_long WHERE metric = 'dialsup_localccy_forecast'"
    )


def _coverage_oracle() -> str:
    parts = []
    sources = {
        "verisk_ylt": (f"SELECT {O.strip('ExposureAttribute')} AS modelled_lob, {O.strip('Analysis')} AS modelled_peril "
                       f"FROM raw_verisk_ylt WHERE {O.strip('CatalogTypeCode')} = 'STC'"),
        "ep_summaries": "SELECT modelled_lob, modelled_peril FROM ep_long",
    }
    seeds = {"modelled_lob": "lobs", "modelled_peril": "perils"}
    for group, src in sources.items():
        for dim, seed in seeds.items():
            msg = f"{dim} value is missing from seed file"
            parts.append(f"""
SELECT 'error' AS severity, 'input_missing_from_seed' AS direction, '{group}' AS source_group,
       '{dim}' AS dimension, '{dim}' AS field, '{B.BRIDGE_DATA_ROOT}' AS path, v.value,
       CAST(1 AS BIGINT) AS count, '{msg}' AS message, '{msg}' AS error
FROM (SELECT DISTINCT CAST({dim} AS VARCHAR) AS value FROM ({src}) WHERE {dim} IS NOT NULL) v
WHERE NOT EXISTS (SELECT 1 FROM {seed} s WHERE CAST(s.{dim} AS VARCHAR) = v.value)""")
    return " UNION ALL ".join(parts)


def _input_aal_oracle() -> str:
    keys = "vendor, rollup_lob, rollup_peril, modelled_lob, modelled_peril"
    verisk = (
        "SELECT v.vendor, l.rollup_lob, p.rollup_peril, v.modelled_lob, v.modelled_peril, v.loss "
        "FROM stg_verisk_ylt v JOIN lobs l ON v.modelled_lob = l.modelled_lob "
        "JOIN perils p ON v.modelled_peril = p.modelled_peril"
    )
    risklink = f"SELECT {keys}, loss FROM main_ylt_enriched WHERE vendor = 'risklink'"

    def grp(src: str, n: int) -> str:
        return (
            f"SELECT {keys}, CAST(COUNT(*) AS BIGINT) AS row_count, {_sql_rounded("COALESCE(SUM(loss), 0.0)", SUM)} AS loss_sum, "
            f"CAST({n} AS BIGINT) AS simulation_count, {_sql_rounded(f"COALESCE(SUM(loss), 0.0) / {float(n)!r}", SUM)} AS raw_aal "
            f"FROM ({src}) GROUP BY {keys}"
        )

    p = RunParams()
    return grp(verisk, p.simulation_counts["verisk"]) + " UNION ALL " + grp(risklink, p.simulation_counts["risklink"])


def _quality_oracle() -> str:
    tables = {
        "verisk_ylt": "raw_verisk_ylt", "risklink_ylt": "raw_risklink_ylt", "ep_summaries": "ep_long",
        "verisk_events": "raw_verisk_events", "risklink_flood22_model_events": "raw_risklink_events", "forecast_factors": "forecast_factors_raw",
    }
    return _contracts_oracle([*CT.CONTRACTS.values()], {t: tables.get(t, t) for t in CT.CONTRACTS})


def _quality_seeds_oracle() -> str:
    raw = {t: f"({RS.projection(t, 'duckdb')})" for t in RS.RAW_SEEDS}
    extra = " UNION ALL ".join(
        f"SELECT '{t}', '{CT.CONTRACTS[t].code}', 'schema_matches', '{c}', 1" for t, cols in RS.RAW_SEEDS.items() for c in cols[1] if c not in CT.CONTRACTS[t].columns)
    return f"{_contracts_oracle([CT.CONTRACTS[t] for t in RS.RAW_SEEDS], raw)} UNION ALL {extra}"


def _violations_oracle() -> str:
    parts = []
    for t in RS.RAW_SEEDS:
        contract, src = CT.CONTRACTS[t], RS.projection(t, "duckdb")
        for code, kind, column, bad in _row_checks(contract):
            parts.append(f"SELECT '{t}' AS \"table\", '{code}' AS code, '{kind}' AS \"check\", '{column}' AS \"column\", "
                         f"CAST({RS.KEY} AS VARCHAR) AS \"key\", {column} AS value FROM ({src}) WHERE {bad}")
    return " UNION ALL ".join(parts)


def _row_checks(c: CT.TableContract) -> list[tuple[str, str, str, str]]:
    """(code, check, column, SQL condition) of every check of rows."""
    found = []
    if c.mode == "castable":
        for col, kind in c.columns.items():
            sql_type = {"string": "VARCHAR"}.get(kind, kind)
            found.append((c.code, "schema_castable", col, f"{col} IS NOT NULL AND TRY_CAST({col} AS {sql_type}) IS NULL"))
    for r in c.rules:
        if r.kind == "not_null":
            bad = f"{r.column} IS NULL OR {O.strip(r.column)} = ''"
        elif r.kind == "valid_range":
            number = f"TRY_CAST({r.column} AS DOUBLE)"
            bad = " OR ".join(f"{number} {op} {x}" for op, x in (("<", r.min), (">", r.max)) if x is not None)
        else:
            bad = f"{r.column} IS NOT NULL AND CAST({r.column} AS VARCHAR) NOT IN ({', '.join(map(repr, r.values))})"
        found.append((r.code, r.kind, r.column, bad))
    return found


def _quality_raw_oracle() -> str:
    t = "CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR)"
    raw = (
        "(SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'other' ELSE 'verisk' END AS vendor, "
        "CAST(c_custkey AS VARCHAR) AS analysis_id, 'LOB' || CAST(c_custkey % 5 AS VARCHAR) AS modelled_lob, "
        "CASE WHEN c_custkey % 13 = 0 THEN ' ' ELSE 'VP0' END AS modelled_peril, "
        "CASE WHEN c_mktsegment = 'BUILDING' THEN 'TVAR' ELSE 'AEP' END AS ep_type, "
        "CASE WHEN c_custkey % 5 = 0 THEN 'n/a' ELSE '200' END AS return_period, "
        f"CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN substr({t}, 1, 1) || ',' || substr({t}, 2, 100) "
        f"ELSE {t} END AS loss FROM customer)"
    )
    extra = "SELECT 'ep_summaries', 'EP_SUMMARY_SCHEMA', 'schema_matches', 'note', 1"
    return f"{_contracts_oracle([CT.CONTRACTS["ep_summaries"]], {"ep_summaries": raw})} UNION ALL {extra}"


def _contracts_oracle(contracts: list[CT.TableContract], tables: dict[str, str]) -> str:
    parts = []
    for c in contracts:
        parts += [f"SELECT '{c.table}' AS \"table\", '{c.code}' AS code, 'schema_matches' AS \"check\", '{col}' AS \"column\", CAST(0 AS BIGINT) AS violations"
                  for col in c.columns]
        parts += [f"SELECT '{c.table}', '{code}', '{kind}', '{col}', CAST(COUNT(*) FILTER (WHERE {bad}) AS BIGINT) FROM {tables[c.table]}"
                  for code, kind, col, bad in _row_checks(c)]
    return " UNION ALL ".join(parts)


def _ep_wide_long_oracle() -> str:
    t = "CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR)"
    aal = (f"CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 3 = 0 THEN ' ' || substr({t}, 1, 1) || ',' || "
           f"substr({t}, 2, 100) || ' ' ELSE {t} END")
    oep = (f"CASE WHEN c_custkey % 13 = 0 THEN ' ' WHEN c_custkey % 4 = 0 THEN substr({t}, 1, 2) || ',' || "
           f"substr({t}, 3, 100) ELSE {t} || '.5' END")
    wide = (f"SELECT ' ' || CAST(c_custkey AS VARCHAR) AS id, 'LOB' || CAST(c_custkey % 5 AS VARCHAR) AS modelled_lob, "
            f"'VP' || CAST(c_nationkey % 4 AS VARCHAR) AS modelled_peril, "
            f"CASE WHEN c_mktsegment = 'MACHINERY' THEN 'WSC' ELSE 'STC ' END AS CatalogTypeCode, "
            f"{aal} AS AAL_0, {oep} AS OEP_200 FROM customer")

    def leg(col: str, ep_type: str, rp: int) -> str:
        return (f"SELECT 'verisk' AS vendor, {O.strip('id')} AS analysis_id, {O.strip('modelled_lob')} AS modelled_lob, "
                f"{O.strip('modelled_peril')} AS modelled_peril, '{ep_type}' AS ep_type, CAST({rp} AS BIGINT) AS return_period, "
                f"TRY_CAST(regexp_replace({col}, '[,\\s]', '', 'g') AS DOUBLE) AS loss "
                f"FROM ({wide}) WHERE {O.strip('CatalogTypeCode')} = 'STC'")

    body = leg("AAL_0", "AAL", 0) + " UNION ALL " + leg("OEP_200", "OEP", 200)
    return (f"SELECT * FROM ({body}) WHERE analysis_id IS NOT NULL AND analysis_id <> '' AND modelled_lob IS NOT NULL "
            f"AND modelled_lob <> '' AND modelled_peril IS NOT NULL AND modelled_peril <> '' AND loss IS NOT NULL")


def _portfolio_waterfall_oracle() -> str:
    def stage(metric: str, date: str | None = None) -> str:
        cond = f"metric = '{metric}'" + (f" AND forecast_date = DATE '{date}'" if date else "")
        return _xsum(f"CASE WHEN {cond} THEN loss END")

    cols = [
        f"{stage('original')} AS original_loss",
        _sql_rounded("AVG(uplift_factor_on_base_model) FILTER (WHERE metric = 'blended')") + " AS avg_blend_factor",
        f"{stage('blended')} AS blended_loss",
        f"{stage('localccy')} AS localccy_loss",
    ]
    for d in _bridge_dates():
        m = d.replace("-", "")[:6]
        cols += [
            f"{stage('localccy_forecast', d)} AS localccy_forecast_{m}_loss",
            f"{stage('euws', d)} AS euws_{m}_loss",
            f"{stage('euws_override', d)} AS final_euws_override_{m}_loss",
        ]
    return f"SELECT base_model, rollup_lob, rollup_peril, {', '.join(cols)} FROM main_long GROUP BY 1, 2, 3"


def _inventory_columns_oracle() -> str:
    """Rows of the column dictionary from each table's output contract, described one column at a time."""
    fields = lambda schema: [(f.name, f.dataType.simpleString()) for f in schema.fields]
    types = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE"}
    known = dict(fields(SC.MAIN_LONG))
    wide = [(c, known.get(c, "double")) for c in WD.wide_columns(_bridge_dates())]
    tables = {
        TPL.MAIN_TABLE: ("main_long", fields(SC.MAIN_LONG), AVERAGE),
        TPL.DIALSUP_TABLE: ("dialsup_long", fields(SC.DIALSUP_LONG), AVERAGE),
        TPL.WIDE_TABLE: ("wide_output", wide, AVERAGE),
        TPL.REPORT_TABLE: ("ep_report", fields(SC.EP_REPORT), SUM),
    }

    def column(table: str, i: int, name: str, kind: str, k: float) -> str:
        number = kind in ("bigint", "int", "double")
        bounds = [_sql_rounded(f"{f}(CAST(\"{name}\" AS DOUBLE))", k) if number else "CAST(NULL AS DOUBLE)" for f in ("MIN", "MAX")]
        texts = ["CAST(NULL AS VARCHAR)" if number else f"{f}(CAST(\"{name}\" AS VARCHAR))" for f in ("MIN", "MAX")]
        return (f"{{'table_name': '{table}', 'ordinal_position': {i}, 'column_name': '{name}', 'data_type': '{types[kind]}', "
                f"'rows': COUNT(*), 'null_rows': COUNT(*) - COUNT(\"{name}\"), 'min_number': {bounds[0]}, 'max_number': {bounds[1]}, "
                f"'min_text': {texts[0]}, 'max_text': {texts[1]}}}")

    parts = []
    for table, (source, columns, k) in tables.items():
        rows = ", ".join(column(table, i, name, kind, k) for i, (name, kind) in enumerate(columns, 1))
        parts.append(f"SELECT UNNEST([{rows}], recursive := true) FROM {source}")
    return " UNION ALL ".join(f"({p})" for p in parts)


def _wide_check_months_oracle() -> str:
    months = [d.replace("-", "")[:6] for d in _bridge_dates()]
    return " UNION ALL ".join(
        f"SELECT base_model, rollup_lob, rollup_peril, COUNT(*) AS rows, {_sql_rounded('AVG(uplift_factor_on_base_model)')} AS avg_blend_factor, "
        f"'{m}' AS forecast_month, {_xsum(f'euws_override_{m}_loss')} AS final_main_loss, "
        f"{_xsum(f'dialsup_localccy_forecast_{m}_loss')} AS final_dialsup_loss FROM wide_output GROUP BY 1, 2, 3" for m in months)


def _first_month() -> str:
    return _bridge_dates()[0].replace("-", "")[:6]


ORACLE_SELECT: dict[str, str] = {
    "stage_verisk_ylt": "SELECT * FROM stg_verisk_ylt",
    "stage_risklink_ylt": "SELECT * FROM stg_risklink_ylt",
    "stage_verisk_events": "SELECT * FROM stg_verisk_events",
    "stage_risklink_events": "SELECT * FROM stg_risklink_events",
    "normalize_ylt": "SELECT * FROM ylt_normalized",
    "ylt_enriched": "SELECT * FROM main_ylt_enriched",
    "ylt_base_selected": "SELECT * FROM main_ylt_base",
    "ylt_ranked": "SELECT * FROM main_ylt_ranked",
    "ylt_ranked_range": "SELECT * FROM main_ylt_ranked",
    "ylt_ranked_shared": "SELECT * FROM main_ylt_ranked",
    "ylt_ranked_dialsup": "SELECT * FROM dialsup_ylt_ranked",
    "ylt_blended": "SELECT * FROM main_blended",
    "ylt_local_currency": "SELECT * FROM main_localccy",
    "ylt_forecast": "SELECT * FROM main_forecast",
    "ylt_event_factor": "SELECT * FROM main_euws",
    "ylt_rank_override": "SELECT * FROM main_override",
    "main_metric_stream": "SELECT * FROM main_stream",
    "dialsup_factor_base": "SELECT * FROM dialsup_factor_base",
    "dialsup_metrics": "SELECT * FROM dialsup_stream",
    "main_long": "SELECT * FROM main_long",
    "dialsup_long": "SELECT * FROM dialsup_long",
    "main_fanout": "SELECT * FROM main_fanout",
    "dialsup_fanout": "SELECT * FROM dialsup_fanout",
    "event_validation": "SELECT * FROM event_validation",
    "wide_output": "SELECT * FROM wide_output",
    "duplicate_grain": (
        "SELECT metric, CAST(COUNT(*) AS BIGINT) AS duplicate_groups FROM ("
        f"SELECT {', '.join(SC.WIDE_IDENTITY)}, metric, forecast_date, COUNT(*) AS n FROM ({_wide_source_oracle()}) "
        f"GROUP BY {', '.join(SC.WIDE_IDENTITY)}, metric, forecast_date HAVING COUNT(*) > 1) GROUP BY metric"
    ),
    "aal_report": _sql_sums("report_aal", "loss"),
    "annual_aep": _sql_sums("annual_aep", "loss"),
    "annual_oep": "SELECT * FROM annual_oep",
    "ep_report": _sql_sums("ep_report", "loss"),
    "ep_wide_to_long": _ep_wide_long_oracle(),
    "dimension_coverage": _coverage_oracle(),
    "quality_rules": _quality_oracle(),
    "quality_rules_raw": _quality_raw_oracle(),
    "quality_rules_seeds": _quality_seeds_oracle(),
    "quality_violations": _violations_oracle(),
    "q_inventory_counts": (
        "SELECT 'ep_report' AS table_name, COUNT(*) AS rows FROM ep_report UNION ALL "
        "SELECT 'mts_tbl_ylt_combined_all_factors', COUNT(*) FROM main_long UNION ALL "
        "SELECT 'mts_tbl_ylt_combined_all_factors_wide', COUNT(*) FROM wide_output UNION ALL "
        "SELECT 'mts_tbl_ylt_dialsup', COUNT(*) FROM dialsup_long"
    ),
    "q_report_totals": (
        f"SELECT forecast_date, metric, ep_type, COUNT(*) AS rows, {_xsum('loss')} AS total_loss "
        "FROM ep_report GROUP BY 1, 2, 3"
    ),
    "q_top_losses": (
        f"SELECT * REPLACE ({_sql_rounded('loss', SUM)} AS loss) FROM (SELECT"
        " forecast_date, metric, base_model, rollup_lob, "
        "rollup_peril, ep_type, return_period, rank, rp, loss FROM ep_report ORDER BY loss DESC NULLS LAST, "
        "forecast_date NULLS FIRST, metric NULLS FIRST, base_model NULLS FIRST, rollup_lob NULLS FIRST, "
        "rollup_peril NULLS FIRST, ep_type NULLS FIRST, return_period NULLS FIRST LIMIT 100)"
    ),
    "q_wide_events": (
        f"SELECT base_model, rollup_lob, rollup_peril, modelled_lob, modelled_peril, year_id, event_id, model_event_id, "
        f"event_day, rnk, rp, risklink_blended_contribution, verisk_blended_contribution, uplift_factor_on_base_model, "
        f"euws_override_{_first_month()}_loss, dialsup_localccy_forecast_{_first_month()}_loss FROM wide_output "
        f"ORDER BY euws_override_{_first_month()}_loss DESC NULLS LAST, "
        f"dialsup_localccy_forecast_{_first_month()}_loss DESC NULLS LAST, "
        + ", ".join(f"{c} NULLS FIRST" for c in ("base_model", "year_id", "event_id", "rollup_lob", "rollup_peril",
                                                 "modelled_lob", "modelled_peril", "rnk", "analysis_id", "vendor",
                                                 "model_code"))
        + " LIMIT 500"
    ),
    "q_wide_check": (
        f"SELECT base_model, rollup_lob, rollup_peril, COUNT(*) AS rows, "
        f"{_sql_rounded('AVG(uplift_factor_on_base_model)')} AS avg_blend_factor, "
        f"{_xsum(f'euws_override_{_first_month()}_loss')} AS final_main_loss, "
        f"{_xsum(f'dialsup_localccy_forecast_{_first_month()}_loss')} AS final_dialsup_loss "
        f"FROM wide_output GROUP BY 1, 2, 3"
    ),
    "q_wide_check_months": _wide_check_months_oracle(),
    "q_inventory_columns": _inventory_columns_oracle(),
    "q_portfolio_waterfall": _portfolio_waterfall_oracle(),
    "q_stage_counts": (
        "SELECT forecast_date, base_model, rollup_lob, rollup_peril, metric, COUNT(*) AS rows, "
        f"{_xsum('loss')} AS loss FROM main_long GROUP BY 1, 2, 3, 4, 5"
    ),
    "q_event_waterfall": """
SELECT forecast_date, base_model, rollup_lob, rollup_peril, modelled_lob, modelled_peril, year_id, event_id,
       model_event_id, event_day, rnk, rp, metric, loss, uplift_factor_on_base_model,
       risklink_blended_contribution, verisk_blended_contribution
FROM main_long
ORDER BY year_id NULLS FIRST, event_id NULLS FIRST, forecast_date NULLS FIRST,
  CASE metric WHEN 'original' THEN 10 WHEN 'blended' THEN 20 WHEN 'localccy' THEN 30
    WHEN 'localccy_forecast' THEN 40 WHEN 'euws' THEN 50 WHEN 'euws_override' THEN 60 ELSE 999 END,
  base_model NULLS FIRST, rollup_lob NULLS FIRST, rollup_peril NULLS FIRST, modelled_lob NULLS FIRST,
  modelled_peril NULLS FIRST, rnk NULLS FIRST, analysis_id NULLS FIRST, vendor NULLS FIRST,
  model_code NULLS FIRST, loss NULLS FIRST
LIMIT 500""",
}


# The EP branch on the tables: query -> the oracle's common table.
EP_TABLES = {
    "ep_enriched": "ep_enriched", "ep_selected_main": "ep_main", "ep_selected_dialsup": "ep_dialsup", "ep_vendor_joined": "ep_vendor_joined",
    "ep_target_points": "ep_target_points", "blend_weights": "weights", "ep_blending_targets": "ep_blending_targets",
}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, select in ORACLE_SELECT.items():
        if name == "input_aal_summary":
            continue
        out[name] = O.with_ctes(select)
    out["duplicate_grain_repeats"] = O.with_ctes(ORACLE_SELECT["duplicate_grain"], repeat_events=True)
    for name, table in EP_TABLES.items():
        out[name] = with_table_ctes(f"SELECT * FROM {table}")
    out["input_aal_summary"] = O.with_ctes(_input_aal_oracle(), lob_mod=5, include_unmapped=False)
    return out
