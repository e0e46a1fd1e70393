"""Bridge from the driver's test tables to the rollup input schemas.

``lineitem`` becomes the verisk YLT and its event catalogue, ``orders`` the
risklink YLT and its flood catalogue, ``customer`` a wide EP summary. The
business seeds are small literal tables. The bridge only shapes rows into the
input schemas; all rollup work happens in the operators.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catloss.inputs import RunInputs
from catloss.schemas import EP_LONG, SEED_SCHEMAS

# ---------------------------------------------------------------------------
# The literal seed rows of the test bridge.
# ---------------------------------------------------------------------------
LOBS = [
    (1, "LOB0", "RL0", "prop", "Class A", "DE", "HH", "EUR"),
    (2, "LOB1", "RL0", "prop", "Class A", "DE", "HH", "EUR"),
    (3, "LOB2", "RL1", "fa", "Class B", "FR", "FA", "GBP"),
    (4, "LOB3", "RL2", "fa", "Class C", "GB", "COMM", "USD"),
    (5, "LOB4", "RL3", "prop", "Class D", "IE", "HH", "JPY"),
]
PERILS = [
    ("VP0", "Europe_WS", "Europe", "WS", 206, "206a", "verisk", 2, 1, 1),
    ("VP1", "Europe_WS", "Europe", "WS", 206, "206a", "verisk", 1, 0, 1),
    ("VP2", "Europe_EQ", "Europe", "EQ", 205, "205a", "verisk", 1, 1, 0),
    ("VP3", "Europe_FL", "Europe", "FL", 216, "216b", "risklink", 1, 1, 0),
    ("RP0", "Europe_FL", "Europe", "FL", 216, "216b", "risklink", 1, 1, 0),
    ("RP1", "Europe_WS", "Europe", "WS", 206, "206a", "verisk", 1, 1, 1),
]
BLENDING_FACTORS = [
    (1, 1, 206, "Europe WS", "206a", "Europe WS all", 0.6, 0.4, 0.0, "2026-01-01"),
    (2, 1, 205, "Europe EQ", "205a", "Europe EQ all", 0.5, 0.5, 0.0, "2026-01-01"),
    (3, 1, 216, "Europe FL", "216b", "Europe FL b", 0.25, 0.75, 0.0, "2026-01-01"),
    (4, 1, 216, "Europe FL", "216a", None, 1.0, 0.0, 0.0, "2026-01-01"),
]
FX_RATES = [
    ("GBP", "GBP", "2026-01-01", 1.0),
    ("EUR", "GBP", "2026-01-01", 0.88),
    ("USD", "GBP", "2026-01-01", 0.80),
    ("EUR", "USD", "2026-01-01", 1.10),
]
FORECAST_FACTORS = [
    ("HH", "Germany", "DE", "2026-01-01", 1.1),
    ("HH", "Germany", "DE", "2026-07-01", 1.2),
    ("FA", "France", "FR", "2026-01-01", 0.95),
    ("COMM", "UK", "GB", "2026-07-01", 1.05),
]
EUWS_RANK_OVERRIDES = [("RL0", 100, 1.0)]
# EP points: (ep_type, return_period, k); losses are k * 1000 * lob_id (verisk)
# and k * 1100 * lob_id (risklink).
EP_POINTS = [("AAL", 0, 1), ("AEP", 200, 9), ("OEP", 200, 7), ("OEP", 1000, 12)]
# Bridge moduli and offsets.
VERISK_LOB_MOD = 6
RISKLINK_ANALYSIS_BASE = 900
VERISK_EVENT_BASE = 1_000_000
VERISK_YEARS_MOD = 10_000
# ``path`` reported for bridged inputs (they have no data folder of their own).
BRIDGE_DATA_ROOT = "bridge"
RISKLINK_YEARS_MOD = 100_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def literal_table(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """A small literal table as an inline ``VALUES`` relation (a stable local plan)."""
    names = [f.name for f in schema.fields]
    cols = ", ".join(f"c{i}" for i in range(len(names)))
    select = ", ".join(
        f"CAST(c{i} AS {f.dataType.simpleString()}) AS `{f.name}`" for i, f in enumerate(schema.fields)
    )
    if not rows:
        return spark.createDataFrame([], schema)
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT {select} FROM VALUES {values} AS t({cols})")


def _lit_seed(spark: SparkSession, stem: str, rows: list[tuple]) -> DataFrame:
    return literal_table(spark, rows, SEED_SCHEMAS[stem])


def verisk_ylt(spark: SparkSession, sf_dir: str, lob_mod: int = VERISK_LOB_MOD) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("VP"), (F.col("l_partkey") % 4).cast("string"), F.lit("  ")).alias("Analysis"),
        F.concat(F.lit("LOB"), (F.col("l_suppkey") % lob_mod).cast("string"), F.lit(" ")).alias(
            "ExposureAttribute"
        ),
        F.when(F.col("l_returnflag") == "R", F.lit("HIST    "))
        .otherwise(F.lit("STC     "))
        .alias("CatalogTypeCode"),
        F.col("l_orderkey").cast("long").alias("EventID"),
        (F.lit(41) + F.col("l_linenumber") % 2).cast("long").alias("ModelCode"),
        (F.lit(1) + F.col("l_orderkey") % VERISK_YEARS_MOD).cast("long").alias("YearID"),
        F.col("l_extendedprice").cast("double").alias("GroundUpLoss"),
    )


def risklink_ylt(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    return o.select(
        (F.lit(RISKLINK_ANALYSIS_BASE) + F.col("o_custkey") % 8).cast("long").alias("anlsid"),
        (F.lit(1) + F.col("o_orderkey") % RISKLINK_YEARS_MOD).cast("long").alias("yearid"),
        F.col("o_orderkey").cast("long").alias("eventid"),
        (F.col("o_totalprice") / F.lit(10.0)).alias("loss"),
    )


def verisk_events(spark: SparkSession, sf_dir: str, repeat: bool = False) -> DataFrame:
    """The event catalogue; ``repeat`` lists a tenth of the events twice."""
    li = _table(spark, sf_dir, "lineitem").where(F.col("l_orderkey") % 7 != 0)
    events = li.select(
        (F.lit(VERISK_EVENT_BASE) + F.col("l_orderkey") * 2 + F.col("l_linenumber") % 2)
        .cast("long")
        .alias("EventID"),
        (F.lit(41) + F.col("l_linenumber") % 2).cast("long").alias("ModelID"),
        F.col("l_orderkey").cast("long").alias("Event"),
        (F.lit(1) + F.col("l_orderkey") % VERISK_YEARS_MOD).cast("long").alias("Year"),
        (F.lit(1) + F.col("l_orderkey") % 365).cast("long").alias("Day"),
    ).distinct()
    return events.unionByName(events.where(F.col("Event") % 10 == 1)) if repeat else events


def risklink_flood_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 5 != 0)

    def copy(shift_days: int) -> DataFrame:
        date = F.col("o_orderdate").cast("timestamp_ntz")
        if shift_days:
            date = date + F.expr(f"INTERVAL {shift_days} DAYS")
        return o.select(
            F.col("o_orderkey").cast("long").alias("ModelEventID"),
            (F.lit(1) + F.col("o_orderkey") % RISKLINK_YEARS_MOD).cast("long").alias(
                "ModelOccurrenceYear"
            ),
            F.lit(216).cast("long").alias("RegionPerilID"),
            date.alias("ModelOccurrenceDate"),
        )

    return copy(0).unionByName(copy(10))


def euws_rate_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem").where(F.col("l_orderkey") % 3 == 0)
    m9 = F.col("l_orderkey") % 9
    return li.select(
        (F.lit(VERISK_EVENT_BASE) + F.col("l_orderkey") * 2 + F.col("l_linenumber") % 2)
        .cast("long")
        .alias("model_event_id"),
        (F.lit(1) + F.col("l_orderkey") % VERISK_YEARS_MOD).cast("long").alias("occ_year"),
        F.when(m9 == 0, F.lit(0.0)).when(m9 == 3, F.lit(0.5)).otherwise(F.lit(1.2)).alias("factor"),
    ).distinct()


def ep_long_rows(include_unmapped: bool = True) -> list[tuple]:
    """Long EP summary rows from lobs x perils x points (the fixed bridge rule)."""
    out = []
    for lob_id, lob, *_ in LOBS:
        for peril, *_ in PERILS:
            for ep_type, rp, k in EP_POINTS:
                if peril.startswith("VP"):
                    if peril == "VP2" and lob_id == 3 and ep_type == "OEP" and rp == 1000:
                        continue
                    scale = 1000 if (peril == "VP3" and lob_id == 4) else 1
                    out.append(("verisk", peril, lob, peril, ep_type, rp, float(1000 * k * lob_id * scale)))
                elif peril.startswith("RP") and lob_id < 5:
                    slot = 1 if lob_id == 2 else lob_id % 4
                    analysis = RISKLINK_ANALYSIS_BASE + 2 * slot + (1 if peril == "RP1" else 0)
                    out.append(("risklink", str(analysis), lob, peril, ep_type, rp, float(1100 * k * lob_id)))
    if include_unmapped:
        out.append(("verisk", "VP0", "LOB9", "VP0", "AAL", 0, 1.0))
    return out


def ep_long(spark: SparkSession, include_unmapped: bool = True) -> DataFrame:
    """Long EP summary (small, literal): one partition."""
    return literal_table(spark, ep_long_rows(include_unmapped), EP_LONG)


def ep_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide EP summary (all strings) from ``customer``; some losses carry commas or blanks."""
    c = _table(spark, sf_dir, "customer")
    t = F.floor(F.col("c_acctbal")).cast("long").cast("string")
    key = F.col("c_custkey")
    aal = (
        F.when(key % 11 == 0, F.lit(""))
        .when(
            key % 3 == 0,
            F.concat(F.lit(" "), F.substring(t, 1, 1), F.lit(","), F.substring(t, 2, 100), F.lit(" ")),
        )
        .otherwise(t)
    )
    oep = (
        F.when(key % 13 == 0, F.lit(" "))
        .when(key % 4 == 0, F.concat(F.substring(t, 1, 2), F.lit(","), F.substring(t, 3, 100)))
        .otherwise(F.concat(t, F.lit(".5")))
    )
    return c.select(
        F.concat(F.lit(" "), key.cast("string")).alias("id"),
        F.concat(F.lit("LOB"), (key % 5).cast("string")).alias("modelled_lob"),
        F.concat(F.lit("VP"), (F.col("c_nationkey") % 4).cast("string")).alias("modelled_peril"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("WSC"))
        .otherwise(F.lit("STC "))
        .alias("CatalogTypeCode"),
        aal.alias("AAL_0"),
        oep.alias("OEP_200"),
        F.col("c_name").alias("note"),
    )


def ep_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long EP summary as raw text from ``customer``, with missing, blank, uncastable, negative and
    unknown values and a further column."""
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    t = F.floor(F.col("c_acctbal")).cast("long").cast("string")
    return _table(spark, sf_dir, "customer").select(
        F.when(segment == "MACHINERY", "other").otherwise("verisk").alias("vendor"),
        key.cast("string").alias("analysis_id"),
        F.concat(F.lit("LOB"), (key % 5).cast("string")).alias("modelled_lob"),
        F.when(key % 13 == 0, " ").otherwise("VP0").alias("modelled_peril"),
        F.when(segment == "BUILDING", "TVAR").otherwise("AEP").alias("ep_type"),
        F.when(key % 5 == 0, "n/a").otherwise("200").alias("return_period"),
        F.when(key % 11 == 0, F.lit(None)).when(key % 3 == 0, F.concat(F.substring(t, 1, 1), F.lit(","), F.substring(t, 2, 100))).otherwise(t).alias("loss"),
        F.col("c_name").alias("note"),
    )


def literal_seeds(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "lobs": _lit_seed(spark, "lobs", LOBS),
        "perils": _lit_seed(spark, "perils", PERILS),
        "blending_factors": _lit_seed(spark, "blending_factors", BLENDING_FACTORS),
        "fx_rates": _lit_seed(spark, "fx_rates", FX_RATES),
        "forecast_factors": _lit_seed(spark, "forecast_factors", FORECAST_FACTORS),
        "euws_rank_overrides": _lit_seed(spark, "euws_rank_overrides", EUWS_RANK_OVERRIDES),
    }


def bridge_inputs(
    spark: SparkSession,
    sf_dir: str,
    *,
    lob_mod: int = VERISK_LOB_MOD,
    include_unmapped: bool = True,
    repeat_events: bool = False,
) -> RunInputs:
    """All run inputs derived from the test tables under ``sf_dir``."""
    seeds = literal_seeds(spark)
    seeds["verisk_events"] = verisk_events(spark, sf_dir, repeat_events)
    seeds["risklink_flood22_model_events"] = risklink_flood_events(spark, sf_dir)
    seeds["euws_rate_factors"] = euws_rate_factors(spark, sf_dir)
    return RunInputs(
        seeds=seeds,
        ylts={"verisk": verisk_ylt(spark, sf_dir, lob_mod), "risklink": risklink_ylt(spark, sf_dir)},
        ep_summaries=ep_long(spark, include_unmapped),
        data_root=BRIDGE_DATA_ROOT,
    )
