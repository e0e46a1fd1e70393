"""Raw text versions of the lookup tables, from the test tables, with values against every kind of rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catloss.sources import bridge as B

#: A further column, by which a violating row is known.
KEY = "row_key"

# table: (source, column -> SQL that Spark and DuckDB both read; k is the source's key, {s} casts to text)
RAW_SEEDS: dict[str, tuple[str, dict[str, str]]] = {
    "lobs": ("customer c_custkey", {
        KEY: "k", "lob_id": "CASE WHEN k % 17 = 0 THEN 'n/a' WHEN k % 7 = 0 THEN concat('-', {s}) ELSE {s} END", "modelled_lob": "concat('LC', {s})",
        "rollup_lob": "CASE WHEN k % 5 = 0 THEN NULL ELSE 'CR' END", "lob_type": "CASE WHEN k % 6 = 0 THEN ' ' ELSE 'prop' END",
        "cds_cat_class_name": "'Class A'", "office": "CASE WHEN k % 9 = 0 THEN '' ELSE 'DE' END", "class": "'HH'", "currency": "'EUR'",
    }),
    "perils": ("nation n_nationkey", {
        KEY: "k", "modelled_peril": "concat('VN', {s})", "rollup_peril": "CASE WHEN k = 3 THEN '  ' ELSE 'WS' END", "region": "'World'", "peril": "'ALL'",
        "region_peril_id": "CASE WHEN k % 4 = 0 THEN '-500' ELSE '500' END", "blend_subregion_peril_id": "'500a'", "base_model": "CASE WHEN k = 7 THEN NULL ELSE 'verisk' END",
        "selection_priority": "CASE WHEN k % 5 = 0 THEN 'first' ELSE '1' END", "is_dialsup": "CASE WHEN k % 3 = 0 THEN '2' ELSE '1' END",
        "is_euws": "CASE WHEN k % 6 = 1 THEN 'yes' WHEN k = 8 THEN NULL ELSE '0' END", "note": "'further column'",
    }),
    "blending_factors": ("part p_partkey", {
        KEY: "k", "id": "{s}", "BlendSetID": "CASE WHEN k % 31 = 0 THEN '-1' ELSE '1' END", "RegionPerilID": "'206'", "RegionPeril": "'WS'",
        "SubRegionPerilID": "CASE WHEN k % 13 = 0 THEN NULL ELSE '206a' END", "SubRegionPeril": "NULL",
        "AIRBlend": "CASE k % 4 WHEN 0 THEN '1.25' WHEN 1 THEN '1' WHEN 2 THEN '-0.25' ELSE '0.5' END", "RMSBlend": "CASE WHEN k % 11 = 0 THEN 'half' ELSE '0.5' END",
        "KatRiskBlend": "'0'", "DateCreated": "'2026-01-01'",
    }),
    "fx_rates": ("orders o_orderkey", {
        KEY: "k", "currency_code": "CASE WHEN k % 19 = 0 THEN '' ELSE 'EUR' END", "target_currency": "'GBP'", "rate_date": "'2026-01-01'",
        "rate": "CASE k % 10 WHEN 0 THEN '0' WHEN 1 THEN '-0.88' WHEN 2 THEN NULL WHEN 3 THEN '0,88' ELSE '0.88' END",
    }),
    "forecast_factors": ("supplier s_suppkey", {
        KEY: "k", "class": "'HH'", "office": "'Germany'", "office_iso2": "CASE WHEN k % 8 = 0 THEN NULL ELSE 'DE' END", "forecast_date": "'2026-01-01'",
        "factor": "CASE k % 6 WHEN 0 THEN '-1.1' WHEN 1 THEN 'x' ELSE '1.1' END",
    }),
    "euws_rank_overrides": ("supplier s_suppkey", {
        KEY: "k", "rollup_lob": "CASE WHEN k % 4 = 0 THEN ' ' ELSE 'RL0' END", "max_rank": "CASE k % 5 WHEN 0 THEN '-100' WHEN 1 THEN 'ten' ELSE '100' END",
        "factor": "CASE WHEN k % 9 = 0 THEN NULL ELSE '1.0' END",
    }),
}


def projection(table: str, dialect: str) -> str:
    """SELECT of the raw table over its source view; texts are strings in both dialects."""
    source, columns = RAW_SEEDS[table]
    name, key = source.split()
    text = "STRING" if dialect == "spark" else "VARCHAR"
    quote = "`{}`" if dialect == "spark" else '"{}"'
    made = [f"CAST({x.replace('{s}', f'CAST(k AS {text})')} AS {'BIGINT' if c == KEY else text}) AS {quote.format(c)}" for c, x in columns.items()]
    return f"SELECT {', '.join(made)} FROM (SELECT CAST({key} AS BIGINT) AS k FROM {name if dialect != 'spark' else '{src}'})"


def raw_seed(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.sql(projection(table, "spark"), src=B._table(spark, sf_dir, RAW_SEEDS[table][0].split()[0]))
