"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL follows the reference's own shape (unions, full outer join,
``row_number``) while the Spark side uses the rewrites (semi joins, conditional
aggregation, fused stage stream). Only the bridge projection mirrors the Spark
bridge. Every query is ``WITH <all CTEs> SELECT ...``; DuckDB skips CTEs a
query does not reference.
"""

from __future__ import annotations

from catloss.params import RunParams
from catloss.sources import bridge as B

P = RunParams()
T = P.threshold
PRE = P.prefilter_threshold


def strip(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '^\\s+|\\s+$', '', 'g')"


def _values(rows: list[tuple]) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)

    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def _seed_ctes() -> list[tuple[str, str]]:
    return [
        ("lobs(lob_id, modelled_lob, rollup_lob, lob_type, cds_cat_class_name, office, class, currency)",
         f"VALUES {_values(B.LOBS)}"),
        ("perils(modelled_peril, rollup_peril, region, peril, region_peril_id, blend_subregion_peril_id, "
         "base_model, selection_priority, is_dialsup, is_euws)", f"VALUES {_values(B.PERILS)}"),
        ("blending_factors(id, BlendSetID, RegionPerilID, RegionPeril, SubRegionPerilID, SubRegionPeril, "
         "AIRBlend, RMSBlend, KatRiskBlend, DateCreated)", f"VALUES {_values(B.BLENDING_FACTORS)}"),
        ("fx_rates(currency_code, target_currency, rate_date, rate)", f"VALUES {_values(B.FX_RATES)}"),
        ("forecast_factors_raw(class, office, office_iso2, forecast_date, factor)",
         f"VALUES {_values(B.FORECAST_FACTORS)}"),
        ("euws_rank_overrides(rollup_lob, max_rank, factor)", f"VALUES {_values(B.EUWS_RANK_OVERRIDES)}"),
        ("ep_points(ep_type, return_period, k)", f"VALUES {_values(B.EP_POINTS)}"),
    ]


def _bridge_ctes(lob_mod: int = B.VERISK_LOB_MOD, include_unmapped: bool = True, repeat_events: bool = False) -> list[tuple[str, str]]:
    unmapped = (
        "UNION ALL SELECT 'verisk', 'VP0', 'LOB9', 'VP0', 'AAL', CAST(0 AS BIGINT), 1.0"
        if include_unmapped else ""
    )
    return [
        ("raw_verisk_ylt", f"""
SELECT 'VP' || CAST(l_partkey % 4 AS VARCHAR) || '  ' AS Analysis,
       'LOB' || CAST(l_suppkey % {lob_mod} AS VARCHAR) || ' ' AS ExposureAttribute,
       CASE WHEN l_returnflag = 'R' THEN 'HIST    ' ELSE 'STC     ' END AS CatalogTypeCode,
       CAST(l_orderkey AS BIGINT) AS EventID,
       CAST(41 + l_linenumber % 2 AS BIGINT) AS ModelCode,
       CAST(1 + l_orderkey % 10000 AS BIGINT) AS YearID,
       CAST(l_extendedprice AS DOUBLE) AS GroundUpLoss
FROM lineitem"""),
        ("raw_risklink_ylt", """
SELECT CAST(900 + o_custkey % 8 AS BIGINT) AS anlsid,
       CAST(1 + o_orderkey % 100000 AS BIGINT) AS yearid,
       CAST(o_orderkey AS BIGINT) AS eventid,
       o_totalprice / 10.0 AS loss
FROM orders"""),
        ("listed_verisk_events", """
SELECT DISTINCT CAST(1000000 + l_orderkey * 2 + l_linenumber % 2 AS BIGINT) AS EventID,
       CAST(41 + l_linenumber % 2 AS BIGINT) AS ModelID,
       CAST(l_orderkey AS BIGINT) AS Event,
       CAST(1 + l_orderkey % 10000 AS BIGINT) AS Year,
       CAST(1 + l_orderkey % 365 AS BIGINT) AS Day
FROM lineitem WHERE l_orderkey % 7 <> 0"""),
        ("raw_verisk_events", "SELECT * FROM listed_verisk_events"
         + (" UNION ALL SELECT * FROM listed_verisk_events WHERE Event % 10 = 1" if repeat_events else "")),
        ("raw_risklink_events", """
SELECT CAST(o_orderkey AS BIGINT) AS ModelEventID, CAST(1 + o_orderkey % 100000 AS BIGINT) AS ModelOccurrenceYear,
       CAST(216 AS BIGINT) AS RegionPerilID, CAST(o_orderdate AS TIMESTAMP) AS ModelOccurrenceDate
FROM orders WHERE o_orderkey % 5 <> 0
UNION ALL
SELECT CAST(o_orderkey AS BIGINT), CAST(1 + o_orderkey % 100000 AS BIGINT), CAST(216 AS BIGINT),
       CAST(o_orderdate AS TIMESTAMP) + INTERVAL 10 DAY
FROM orders WHERE o_orderkey % 5 <> 0"""),
        ("euws_rate_factors", """
SELECT DISTINCT CAST(1000000 + l_orderkey * 2 + l_linenumber % 2 AS BIGINT) AS model_event_id,
       CAST(1 + l_orderkey % 10000 AS BIGINT) AS occ_year,
       CASE l_orderkey % 9 WHEN 0 THEN 0.0 WHEN 3 THEN 0.5 ELSE 1.2 END AS factor
FROM lineitem WHERE l_orderkey % 3 = 0"""),
        ("ep_long", f"""
SELECT 'verisk' AS vendor, p.modelled_peril AS analysis_id, l.modelled_lob, p.modelled_peril, t.ep_type,
       CAST(t.return_period AS BIGINT) AS return_period,
       CAST(1000 * t.k * l.lob_id * CASE WHEN p.modelled_peril = 'VP3' AND l.lob_id = 4 THEN 1000 ELSE 1 END AS DOUBLE) AS loss
FROM lobs l CROSS JOIN perils p CROSS JOIN ep_points t
WHERE p.modelled_peril LIKE 'VP%'
  AND NOT (p.modelled_peril = 'VP2' AND l.lob_id = 3 AND t.ep_type = 'OEP' AND t.return_period = 1000)
UNION ALL
SELECT 'risklink', CAST(900 + 2 * CASE WHEN l.lob_id = 2 THEN 1 ELSE l.lob_id % 4 END
                        + CASE WHEN p.modelled_peril = 'RP1' THEN 1 ELSE 0 END AS VARCHAR),
       l.modelled_lob, p.modelled_peril, t.ep_type, CAST(t.return_period AS BIGINT),
       CAST(1100 * t.k * l.lob_id AS DOUBLE)
FROM lobs l CROSS JOIN perils p CROSS JOIN ep_points t
WHERE p.modelled_peril LIKE 'RP%' AND l.lob_id < 5
{unmapped}"""),
    ]


def _staging_ctes() -> list[tuple[str, str]]:
    return [
        ("stg_verisk_ylt", f"""
SELECT 'verisk' AS vendor, {strip('Analysis')} AS analysis_id, {strip('Analysis')} AS modelled_peril,
       {strip('ExposureAttribute')} AS modelled_lob, ModelCode AS model_code, YearID AS year_id,
       EventID AS event_id, GroundUpLoss AS loss
FROM raw_verisk_ylt WHERE {strip('CatalogTypeCode')} = 'STC'"""),
        ("stg_risklink_ylt", """
SELECT 'risklink' AS vendor, CAST(anlsid AS VARCHAR) AS analysis_id, CAST(NULL AS VARCHAR) AS modelled_peril,
       CAST(NULL AS VARCHAR) AS modelled_lob, CAST(NULL AS BIGINT) AS model_code, yearid AS year_id,
       eventid AS event_id, loss
FROM raw_risklink_ylt"""),
        ("ylt_normalized", "SELECT * FROM stg_verisk_ylt UNION ALL SELECT * FROM stg_risklink_ylt"),
        ("stg_verisk_events", """
SELECT EventID AS model_event_id, ModelID AS model_code, Event AS event_id, Year AS year_id, Day AS event_day
FROM raw_verisk_events"""),
        ("stg_risklink_events", """
SELECT ModelEventID AS event_id, ModelOccurrenceYear AS model_occurrence_year, RegionPerilID AS region_peril_id,
       CAST(dayofyear(MIN(ModelOccurrenceDate)) AS BIGINT) AS risklink_event_day
FROM raw_risklink_events GROUP BY ModelEventID, ModelOccurrenceYear, RegionPerilID"""),
        ("stg_fx", """
SELECT currency_code AS currency, target_currency, rate_date AS fx_rate_date, CAST(rate AS DOUBLE) AS fx_rate
FROM fx_rates WHERE target_currency = 'GBP'"""),
        ("stg_forecast_factors", """
SELECT class, office_iso2 AS office, CAST(strptime(forecast_date, '%Y-%m-%d') AS DATE) AS forecast_date,
       CAST(factor AS DOUBLE) AS _forecast_factor_raw
FROM forecast_factors_raw"""),
        ("forecast_dates", "SELECT DISTINCT forecast_date FROM stg_forecast_factors"),
        ("weights", """
SELECT CAST(RegionPerilID AS BIGINT) AS region_peril_id, CAST(SubRegionPerilID AS VARCHAR) AS blend_subregion_peril_id,
       CAST(SubRegionPeril AS VARCHAR) AS sub_region_peril, CAST(AIRBlend AS DOUBLE) AS verisk_weight,
       CAST(RMSBlend AS DOUBLE) AS risklink_weight
FROM blending_factors"""),
    ]


ENRICH_KEYS = (
    "rollup_lob, rollup_peril, region_peril_id, blend_subregion_peril_id, base_model, selection_priority, "
    "is_dialsup, is_euws, cds_cat_class_name, class, office, currency"
)
YLT_ENRICHED_COLS = (
    "vendor, analysis_id, modelled_lob, modelled_peril, rollup_lob, rollup_peril, region_peril_id, "
    "blend_subregion_peril_id, base_model, selection_priority, is_dialsup, is_euws, cds_cat_class_name, "
    "class, office, currency, model_code, year_id, event_id, loss"
)
RANKED_COLS = YLT_ENRICHED_COLS + ", metric, rnk, rp, rp_bucket"
DIAG_COLS = "risklink_blended_contribution, verisk_blended_contribution, uplift_factor_on_base_model"


def _ep_ctes() -> list[tuple[str, str]]:
    return [
        ("ep_enriched", """
SELECT e.vendor, e.analysis_id, e.modelled_lob, e.modelled_peril, e.ep_type, e.return_period, e.loss,
       l.rollup_lob, l.cds_cat_class_name, l.class, l.office, l.currency, p.rollup_peril, p.region, p.peril,
       CAST(p.region_peril_id AS BIGINT) AS region_peril_id, p.blend_subregion_peril_id, p.base_model,
       CAST(COALESCE(p.selection_priority, 99) AS BIGINT) AS selection_priority,
       CAST(p.is_dialsup AS BIGINT) AS is_dialsup, CAST(p.is_euws AS BIGINT) AS is_euws
FROM ep_long e LEFT JOIN lobs l ON e.modelled_lob = l.modelled_lob
LEFT JOIN perils p ON e.modelled_peril = p.modelled_peril"""),
        ("ep_winner", """
SELECT vendor, rollup_lob, rollup_peril, modelled_peril FROM (
  SELECT vendor, rollup_lob, rollup_peril, modelled_peril,
         row_number() OVER (PARTITION BY vendor, rollup_lob, rollup_peril
                            ORDER BY selection_priority ASC NULLS FIRST, modelled_peril ASC NULLS FIRST) AS rn
  FROM ep_enriched) WHERE rn = 1"""),
        ("ep_main", """
SELECT e.* FROM ep_enriched e JOIN ep_winner w
  ON e.vendor = w.vendor AND e.rollup_lob = w.rollup_lob AND e.rollup_peril = w.rollup_peril
 AND e.modelled_peril = w.modelled_peril"""),
        ("ep_dialsup", """
SELECT e.* FROM ep_enriched e JOIN (
  SELECT DISTINCT vendor, rollup_lob, rollup_peril, modelled_peril FROM ep_enriched WHERE is_dialsup = 1) d
  ON e.vendor = d.vendor AND e.rollup_lob = d.rollup_lob AND e.rollup_peril = d.rollup_peril
 AND e.modelled_peril = d.modelled_peril"""),
        ("ep_rl_sum", """
SELECT rollup_lob, rollup_peril, region_peril_id, blend_subregion_peril_id, base_model, ep_type, return_period,
       COALESCE(SUM(loss), 0.0) AS risklink_loss
FROM ep_main WHERE vendor = 'risklink' GROUP BY ALL"""),
        ("ep_vk_sum", """
SELECT rollup_lob, rollup_peril, region_peril_id, blend_subregion_peril_id, base_model, ep_type, return_period,
       COALESCE(SUM(loss), 0.0) AS verisk_loss
FROM ep_main WHERE vendor = 'verisk' GROUP BY ALL"""),
        ("ep_vendor_joined", """
SELECT COALESCE(r.rollup_lob, v.rollup_lob) AS rollup_lob, COALESCE(r.rollup_peril, v.rollup_peril) AS rollup_peril,
       COALESCE(r.region_peril_id, v.region_peril_id) AS region_peril_id,
       COALESCE(r.blend_subregion_peril_id, v.blend_subregion_peril_id) AS blend_subregion_peril_id,
       COALESCE(r.base_model, v.base_model) AS base_model, COALESCE(r.ep_type, v.ep_type) AS ep_type,
       COALESCE(r.return_period, v.return_period) AS return_period, r.risklink_loss, v.verisk_loss
FROM ep_rl_sum r FULL OUTER JOIN ep_vk_sum v
  ON r.rollup_lob = v.rollup_lob AND r.rollup_peril = v.rollup_peril AND r.region_peril_id = v.region_peril_id
 AND r.blend_subregion_peril_id = v.blend_subregion_peril_id AND r.base_model = v.base_model
 AND r.ep_type = v.ep_type AND r.return_period = v.return_period"""),
        ("ep_target_points", "SELECT * FROM ep_vendor_joined WHERE " + " OR ".join(
            f"(ep_type = '{p.ep_type}' AND return_period = {p.return_period})" for p in P.target_points)),
        ("ep_targets_base", """
SELECT t.*, w.sub_region_peril, w.verisk_weight, w.risklink_weight,
       CASE WHEN t.base_model = 'risklink' THEN t.risklink_loss ELSE t.verisk_loss END AS base_model_loss,
       (t.risklink_loss IS NOT NULL AND t.verisk_loss IS NOT NULL) AS both_present
FROM ep_target_points t LEFT JOIN weights w
  ON t.region_peril_id = w.region_peril_id AND t.blend_subregion_peril_id = w.blend_subregion_peril_id"""),
        ("ep_targets_contrib", """
SELECT *,
  CASE WHEN both_present THEN risklink_loss * risklink_weight
       WHEN base_model = 'risklink' THEN base_model_loss ELSE 0.0 END AS risklink_blended_contribution,
  CASE WHEN both_present THEN verisk_loss * verisk_weight
       WHEN base_model = 'verisk' THEN base_model_loss ELSE 0.0 END AS verisk_blended_contribution
FROM ep_targets_base WHERE base_model_loss IS NOT NULL"""),
        ("ep_targets_raw", """
SELECT *, CASE WHEN both_present THEN risklink_blended_contribution + verisk_blended_contribution
               ELSE base_model_loss END AS target_loss
FROM ep_targets_contrib"""),
        ("ep_blending_targets", f"""
SELECT rollup_lob, rollup_peril, region_peril_id, blend_subregion_peril_id, base_model, ep_type, return_period,
       risklink_loss, verisk_loss, sub_region_peril, verisk_weight, risklink_weight, base_model_loss,
       risklink_blended_contribution, verisk_blended_contribution, target_loss,
       CASE WHEN u IS NULL THEN NULL WHEN isnan(u) THEN u WHEN u < {P.uplift_min} THEN {P.uplift_min}
            WHEN u > {P.uplift_max} THEN {P.uplift_max} ELSE u END AS uplift_factor_on_base_model
FROM (SELECT *, CAST(target_loss AS DOUBLE) / CAST(base_model_loss AS DOUBLE) AS u FROM ep_targets_raw)"""),
    ]


def _stream_ctes(stream: str, ep: str) -> list[tuple[str, str]]:
    """Enrich, base-select and rank the YLT against the EP selection ``ep``."""
    years = " ".join(f"WHEN '{v}' THEN {float(n)!r}" for v, n in P.vendor_years.items())
    bucket = " ".join(f"WHEN rp >= {p} THEN {p}" for p in sorted(P.oep_bucket_points, reverse=True))
    return [
        (f"{stream}_vk_keys", f"SELECT DISTINCT vendor, modelled_lob, modelled_peril, {ENRICH_KEYS} FROM {ep} WHERE vendor = 'verisk'"),
        (f"{stream}_rl_keys", f"SELECT DISTINCT vendor, analysis_id, modelled_lob, modelled_peril, {ENRICH_KEYS} FROM {ep} WHERE vendor = 'risklink'"),
        (f"{stream}_ylt_enriched", f"""
SELECT y.vendor, y.analysis_id, y.modelled_lob, y.modelled_peril, k.rollup_lob, k.rollup_peril, k.region_peril_id,
       k.blend_subregion_peril_id, k.base_model, k.selection_priority, k.is_dialsup, k.is_euws,
       k.cds_cat_class_name, k.class, k.office, k.currency, y.model_code, y.year_id, y.event_id, y.loss
FROM ylt_normalized y JOIN {stream}_vk_keys k
  ON y.vendor = k.vendor AND y.modelled_lob = k.modelled_lob AND y.modelled_peril = k.modelled_peril
UNION ALL
SELECT y.vendor, y.analysis_id, k.modelled_lob, k.modelled_peril, k.rollup_lob, k.rollup_peril, k.region_peril_id,
       k.blend_subregion_peril_id, k.base_model, k.selection_priority, k.is_dialsup, k.is_euws,
       k.cds_cat_class_name, k.class, k.office, k.currency, y.model_code, y.year_id, y.event_id, y.loss
FROM ylt_normalized y JOIN {stream}_rl_keys k ON y.vendor = k.vendor AND y.analysis_id = k.analysis_id"""),
        (f"{stream}_ylt_base", f"""
SELECT {YLT_ENRICHED_COLS}, 'original' AS metric FROM {stream}_ylt_enriched
WHERE vendor = base_model AND loss >= {PRE!r}"""),
        (f"{stream}_ylt_rnk", f"""
SELECT *, CAST(row_number() OVER (PARTITION BY vendor, modelled_lob, rollup_peril
       ORDER BY loss DESC NULLS FIRST, year_id ASC NULLS FIRST, event_id ASC NULLS FIRST,
                analysis_id ASC NULLS FIRST, model_code ASC NULLS FIRST) AS BIGINT) AS rnk
FROM {stream}_ylt_base"""),
        (f"{stream}_ylt_ranked", f"""
SELECT {YLT_ENRICHED_COLS}, metric, rnk, rp, CAST(CASE {bucket} ELSE 0 END AS INTEGER) AS rp_bucket
FROM (SELECT *, (CASE vendor {years} ELSE NULL END) / rnk AS rp FROM {stream}_ylt_rnk)"""),
    ]


def all_ctes(lob_mod: int = B.VERISK_LOB_MOD, include_unmapped: bool = True, repeat_events: bool = False) -> list[tuple[str, str]]:
    ctes = _seed_ctes() + _bridge_ctes(lob_mod, include_unmapped, repeat_events) + _staging_ctes() + _ep_ctes()
    ctes += _stream_ctes("main", "ep_main") + _stream_ctes("dialsup", "ep_dialsup")
    from catloss.plans import oracle_streams

    ctes += oracle_streams.ctes()
    return ctes


def with_ctes(select: str, **kw) -> str:
    body = ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in all_ctes(**kw))
    return f"WITH {body}\n{select.strip()}"
