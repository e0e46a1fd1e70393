"""Oracle CTEs for the main and dialsup metric streams, marts and the EP report.

Written stage by stage like the reference (one join per stage, bag unions).
"""

from __future__ import annotations

from catloss import schemas as SC
from catloss.params import RunParams
from catloss.sources import bridge as B

P = RunParams()
T = P.threshold


def _blend_join(r: str, t: str) -> str:
    return (
        f"{r}.rollup_lob = {t}.rollup_lob AND {r}.rollup_peril = {t}.rollup_peril "
        f"AND {r}.region_peril_id = {t}.region_peril_id AND {r}.blend_subregion_peril_id = {t}.blend_subregion_peril_id "
        f"AND {r}.rp_bucket = {t}.return_period AND {r}.base_model = {t}.base_model"
    )


def _fanout(src: str) -> str:
    return f"""
SELECT forecast_date, base_model, metric,
       CAST(CASE WHEN base_model = 'risklink' THEN event_id ELSE model_event_id END AS BIGINT) AS ModelEventID,
       year_id AS ModelYear, target_currency AS CurrencyCode, CAST(0 AS BIGINT) AS ModelYOA,
       loss AS ModelGrossLoss, CAST(0 AS BIGINT) AS ModelInwardsReinstatement,
       CAST(CASE WHEN base_model = 'risklink' THEN risklink_event_day ELSE event_day END AS BIGINT) AS ModelEventDay,
       cds_cat_class_name AS LossClassName
FROM (
  SELECT s.*, CAST(NULL AS BIGINT) AS risklink_event_day FROM {src} s WHERE s.base_model <> 'risklink'
  UNION ALL
  SELECT s.*, e.risklink_event_day FROM {src} s JOIN stg_risklink_events e
    ON s.event_id = e.event_id AND s.year_id = e.model_occurrence_year AND s.region_peril_id = e.region_peril_id
  WHERE s.base_model = 'risklink')"""


def _event_validation(src: str) -> str:
    return f"""
SELECT base_model, metric, forecast_date, CAST(COUNT(*) AS BIGINT) AS row_count,
       CAST(SUM(CASE WHEN ModelEventID IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_model_event_id,
       CAST(SUM(CASE WHEN ModelEventDay IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_model_event_day
FROM {src} GROUP BY base_model, metric, forecast_date"""


def bridge_dates() -> list[str]:
    return sorted({r[3] for r in B.FORECAST_FACTORS})


def _wide() -> str:
    dims = ", ".join(SC.WIDE_IDENTITY)
    select = list(SC.WIDE_IDENTITY)
    select.insert(3, "'cds_wide_analysis' AS output_use")
    select += [f"MAX({c}) AS {c}" for c in SC.WIDE_DIAGNOSTICS]
    for metric in ("euws_override", "dialsup_localccy_forecast"):
        for d in bridge_dates():
            col = f"{metric}_{d.replace('-', '')[:6]}_loss"
            select.append(
                f"MAX(loss) FILTER (WHERE metric = '{metric}' AND CAST(forecast_date AS VARCHAR) = '{d}') AS {col}"
            )
    diag_null = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in SC.WIDE_DIAGNOSTICS)
    src = (
        f"SELECT {dims}, metric, forecast_date, loss, {', '.join(SC.WIDE_DIAGNOSTICS)} FROM main_long "
        f"WHERE metric = 'euws_override' UNION ALL "
        f"SELECT {dims}, metric, forecast_date, loss, {diag_null} FROM dialsup_long "
        f"WHERE metric = 'dialsup_localccy_forecast'"
    )
    return f"SELECT {', '.join(select)} FROM ({src}) GROUP BY {dims}"


def ctes() -> list[tuple[str, str]]:
    counts = " ".join(f"WHEN '{v}' THEN {int(n)}" for v, n in P.simulation_counts.items())
    target_rows = ", ".join(
        f"('{v}', {int(rp)}, {round(n / rp)})" for v, n in P.simulation_counts.items() for rp in P.return_periods
    )
    return [
        # --- main stream, one stage per CTE --------------------------------
        ("main_blended", f"""
SELECT r.* REPLACE (r.loss * t.uplift_factor_on_base_model AS loss, 'blended' AS metric),
       t.risklink_blended_contribution, t.verisk_blended_contribution, t.uplift_factor_on_base_model
FROM main_ylt_ranked r JOIN ep_blending_targets t ON {_blend_join('r', 't')}"""),
        ("main_localccy", """
SELECT b.* REPLACE (b.loss / fx.fx_rate AS loss, 'localccy' AS metric), b.currency AS target_currency
FROM main_blended b JOIN stg_fx fx ON b.currency = fx.currency"""),
        ("main_forecast", """
SELECT l.* REPLACE (l.loss * COALESCE(f._forecast_factor_raw, 1.0) AS loss, 'localccy_forecast' AS metric),
       d.forecast_date
FROM main_localccy l CROSS JOIN forecast_dates d
LEFT JOIN stg_forecast_factors f ON l.class = f.class AND l.office = f.office AND d.forecast_date = f.forecast_date"""),
        ("main_euws", """
SELECT fc.* REPLACE (fc.loss * COALESCE(ef.factor, 1.0) AS loss, 'euws' AS metric),
       ve.model_event_id, ve.event_day, COALESCE(ef.factor, 1.0) AS _euws_factor_raw,
       fc.loss AS _localccy_forecast_loss
FROM main_forecast fc
LEFT JOIN stg_verisk_events ve ON fc.event_id = ve.event_id AND fc.year_id = ve.year_id AND fc.model_code = ve.model_code
LEFT JOIN euws_rate_factors ef ON ve.model_event_id = ef.model_event_id"""),
        ("main_override", """
SELECT e.* REPLACE (
         CASE WHEN o.factor IS NOT NULL AND e.rnk <= o.max_rank AND e._euws_factor_raw = 0
              THEN e._localccy_forecast_loss * o.factor ELSE e.loss END AS loss,
         'euws_override' AS metric)
FROM main_euws e LEFT JOIN euws_rank_overrides o ON e.rollup_lob = o.rollup_lob"""),
        ("main_stream", """
SELECT * FROM main_ylt_ranked
UNION ALL BY NAME SELECT * FROM main_blended
UNION ALL BY NAME SELECT * FROM main_localccy
UNION ALL BY NAME SELECT * FROM main_forecast
UNION ALL BY NAME SELECT * FROM main_euws
UNION ALL BY NAME SELECT * FROM main_override"""),
        # --- dialsup stream ---------------------------------------------------
        ("dialsup_factor_base", """
SELECT r.*, ve.model_event_id, ve.event_day, fx.target_currency, fx.fx_rate_date, fx.fx_rate, d.forecast_date,
       f._forecast_factor_raw, COALESCE(f._forecast_factor_raw, 1.0) AS _forecast_factor
FROM dialsup_ylt_ranked r
LEFT JOIN stg_verisk_events ve ON r.event_id = ve.event_id AND r.year_id = ve.year_id AND r.model_code = ve.model_code
JOIN stg_fx fx ON r.currency = fx.currency
CROSS JOIN forecast_dates d
LEFT JOIN stg_forecast_factors f ON r.class = f.class AND r.office = f.office AND d.forecast_date = f.forecast_date"""),
        ("dialsup_original", """
SELECT * EXCLUDE (_forecast_factor_raw, _forecast_factor) REPLACE ('dialsup_original' AS metric)
FROM dialsup_factor_base"""),
        ("dialsup_localccy", """
SELECT * EXCLUDE (_forecast_factor_raw, _forecast_factor)
       REPLACE (loss / fx_rate AS loss, currency AS target_currency, 'dialsup_localccy' AS metric)
FROM dialsup_factor_base"""),
        ("dialsup_forecast", """
SELECT * EXCLUDE (_forecast_factor_raw, _forecast_factor)
       REPLACE (loss / fx_rate * _forecast_factor AS loss, currency AS target_currency,
                'dialsup_localccy_forecast' AS metric)
FROM dialsup_factor_base"""),
        ("dialsup_stream", """
SELECT * FROM dialsup_original UNION ALL SELECT * FROM dialsup_localccy UNION ALL SELECT * FROM dialsup_forecast"""),
        # --- marts --------------------------------------------------------------
        ("main_long", f"""
SELECT *, CASE WHEN metric = 'euws_override' THEN 'cds_main' ELSE 'intermediate_audit' END AS output_use
FROM main_stream WHERE metric <> 'euws_override' OR loss >= {T!r}"""),
        ("dialsup_long", f"""
SELECT *, 'cds_dialsup' AS output_use FROM dialsup_stream
WHERE metric = 'dialsup_localccy_forecast' AND loss >= {T!r}"""),
        ("main_final", "SELECT * FROM main_long WHERE metric = 'euws_override'"),
        ("main_fanout", _fanout("main_final")),
        ("dialsup_fanout", _fanout("dialsup_long")),
        ("wide_output", _wide()),
        ("event_validation", _event_validation("main_fanout") + "\nUNION ALL\n" + _event_validation("dialsup_fanout")),
        # --- EP report ------------------------------------------------------------
        ("report_losses", f"""
SELECT forecast_date, base_model, rollup_lob, rollup_peril, year_id, metric, loss,
       CAST(CASE base_model {counts} END AS BIGINT) AS n_simulations
FROM (SELECT forecast_date, base_model, rollup_lob, rollup_peril, year_id, metric, loss FROM main_long
      WHERE metric = 'euws_override'
      UNION ALL
      SELECT forecast_date, base_model, rollup_lob, rollup_peril, year_id, metric, loss FROM dialsup_long
      WHERE metric = 'dialsup_localccy_forecast')"""),
        ("report_aal", """
SELECT forecast_date, metric, 'AAL' AS ep_type, CAST(0 AS BIGINT) AS return_period, base_model, rollup_lob,
       rollup_peril, CAST(0 AS BIGINT) AS rank, 0.0 AS rp,
       COALESCE(SUM(loss), 0.0) / FIRST(n_simulations) AS loss
FROM report_losses GROUP BY forecast_date, metric, base_model, rollup_lob, rollup_peril"""),
        ("report_target_ranks(base_model, return_period, rank)", f"VALUES {target_rows}"),
        ("report_keys", """
SELECT DISTINCT forecast_date, metric, base_model, rollup_lob, rollup_peril, n_simulations FROM report_losses"""),
        ("annual_aep", """
SELECT forecast_date, metric, base_model, rollup_lob, rollup_peril, year_id,
       COALESCE(SUM(loss), 0.0) AS loss
FROM report_losses GROUP BY forecast_date, metric, base_model, rollup_lob, rollup_peril, year_id"""),
        ("annual_oep", """
SELECT forecast_date, metric, base_model, rollup_lob, rollup_peril, year_id, MAX(loss) AS loss
FROM report_losses GROUP BY forecast_date, metric, base_model, rollup_lob, rollup_peril, year_id"""),
    ] + [
        (f"ranked_{kind}", f"""
SELECT *, CAST(row_number() OVER (PARTITION BY forecast_date, metric, base_model, rollup_lob, rollup_peril
                                  ORDER BY loss DESC) AS BIGINT) AS rank
FROM annual_{kind.lower()}""")
        for kind in ("AEP", "OEP")
    ] + [
        (f"report_{kind.lower()}", f"""
SELECT k.forecast_date, k.metric, '{kind}' AS ep_type, CAST(t.return_period AS BIGINT) AS return_period,
       k.base_model, k.rollup_lob, k.rollup_peril, CAST(t.rank AS BIGINT) AS rank,
       CAST(k.n_simulations AS DOUBLE) / t.rank AS rp, COALESCE(r.loss, 0.0) AS loss
FROM report_keys k JOIN report_target_ranks t ON k.base_model = t.base_model
LEFT JOIN ranked_{kind} r
  ON k.forecast_date = r.forecast_date AND k.metric = r.metric AND k.base_model = r.base_model
 AND k.rollup_lob = r.rollup_lob AND k.rollup_peril = r.rollup_peril
 AND t.rank = r.rank""")
        for kind in ("AEP", "OEP")
    ] + [
        ("ep_report", "SELECT * FROM report_aal UNION ALL SELECT * FROM report_aep UNION ALL SELECT * FROM report_oep"),
    ]
