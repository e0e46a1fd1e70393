"""DuckDB projections of ``sources.table_bridge``: they stand in for the literal seeds and EP rows."""

from __future__ import annotations

from catloss.plans import oracle as O
from catloss.sources import table_bridge as TB


def _pick(values: list[str], key: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {cases} END"


def _wide(vendor: str) -> str:
    base = f"(CAST(floor(c_acctbal) AS BIGINT) + {1000 if vendor == 'verisk' else 1100})"
    text = {m: f"CAST({base} * {k} AS VARCHAR)" for m, k in TB.METRICS.items()}
    text["AAL_0"] = f"CASE WHEN c_custkey % 13 = 0 THEN ' ' ELSE {text['AAL_0']} END"
    text["OEP_200"] = f"CASE WHEN c_custkey % 3 = 0 THEN substr({text['OEP_200']}, 1, 1) || ',' || substr({text['OEP_200']}, 2, 100) ELSE {text['OEP_200']} END"
    keep = "WHERE c_custkey % 4 <> 0" if vendor == "risklink" else ""
    return (f"SELECT '{vendor[0]}' || CAST(c_custkey AS VARCHAR) AS id, 'LC' || CAST(c_custkey % {TB.LOB_MOD} AS VARCHAR) AS modelled_lob, "
            f"'{TB.PREFIX[vendor]}' || CAST(c_nationkey AS VARCHAR) AS modelled_peril, {', '.join(f'{x} AS {m}' for m, x in text.items())} FROM customer {keep}")


def _long() -> str:
    legs = []
    for vendor in TB.PREFIX:
        for metric in TB.METRICS:
            kind, period = metric.split("_")
            legs.append(f"SELECT '{vendor}' AS vendor, id AS analysis_id, modelled_lob, modelled_peril, '{kind}' AS ep_type, CAST({period} AS BIGINT) AS return_period, "
                        f"TRY_CAST(regexp_replace({metric}, '[,\\s]', '', 'g') AS DOUBLE) AS loss FROM ({_wide(vendor)})")
    return f"SELECT * FROM ({' UNION ALL '.join(legs)}) WHERE loss IS NOT NULL"


def replacements() -> dict[str, str]:
    region = "CAST(n_regionkey AS BIGINT)"
    return {
        "lobs": f"""
SELECT k AS lob_id, 'LC' || k AS modelled_lob, 'CR' || (k % {TB.ROLLUP_MOD}) AS rollup_lob, {_pick(['prop', 'fa'], 'k')} AS lob_type,
       'Class ' || (k % 5) AS cds_cat_class_name, {_pick(['DE', 'FR', 'GB', 'IE'], 'k')} AS office, {_pick(['HH', 'FA', 'COMM'], 'k')} AS class,
       {_pick(['EUR', 'GBP', 'USD', 'JPY'], 'k')} AS currency
FROM (SELECT DISTINCT CAST(c_custkey % {TB.LOB_MOD} AS BIGINT) AS k FROM customer) WHERE k % 11 <> 5""",
        "perils": f"""
SELECT prefix || n_nationkey AS modelled_peril, 'Region ' || n_regionkey AS rollup_peril, 'World' AS region, 'ALL' AS peril,
       500 + {region} AS region_peril_id, CAST(500 + {region} AS VARCHAR) || CASE WHEN n_nationkey % 2 = 0 THEN 'a' ELSE 'b' END AS blend_subregion_peril_id,
       CASE WHEN n_nationkey = 7 THEN NULL WHEN n_regionkey % 2 = 0 THEN 'verisk' ELSE 'risklink' END AS base_model,
       CASE WHEN n_nationkey % 5 <> 0 THEN CAST(n_nationkey % 3 AS BIGINT) END AS selection_priority,
       CAST(n_nationkey % 4 = 0 AS BIGINT) AS is_dialsup, CAST(n_regionkey = 3 AS BIGINT) AS is_euws
FROM nation, (VALUES {', '.join(f"('{p}')" for p in TB.PREFIX.values())}) v(prefix)""",
        "blending_factors": """
SELECT r_regionkey AS id, 1 AS BlendSetID, 500 + CAST(r_regionkey AS BIGINT) AS RegionPerilID, r_name AS RegionPeril,
       CAST(500 + r_regionkey AS VARCHAR) || sub AS SubRegionPerilID, CASE WHEN sub = 'a' THEN r_name END AS SubRegionPeril,
       CAST(CASE WHEN sub = 'a' THEN r_regionkey * 0.25 ELSE 0.5 END AS DOUBLE) AS AIRBlend,
       1 - CAST(CASE WHEN sub = 'a' THEN r_regionkey * 0.25 ELSE 0.5 END AS DOUBLE) AS RMSBlend, 0.0 AS KatRiskBlend, '2026-01-01' AS DateCreated
FROM region, (VALUES ('a'), ('b')) v(sub) WHERE r_regionkey < 4 OR sub = 'a'""",
        "ep_long": _long(),
    }


def with_table_ctes(select: str) -> str:
    own = replacements()
    ctes = []
    for name, sql in O.all_ctes():
        stem = name.split("(")[0]
        ctes.append((stem, own[stem]) if stem in own else (name, sql))
    return "WITH " + ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in ctes) + "\n" + select
