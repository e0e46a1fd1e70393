"""Run inputs whose EP branch comes from the test tables, so that it grows with them.

``customer`` gives a wide EP summary per vendor, which goes through the wide-to-long
conversion; the distinct portfolio codes of ``customer`` give the lobs, ``nation`` the
perils (several per rollup cell, with tied, missing and differing priorities) and
``region`` the blending weights. Losses are whole numbers, so sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catloss import schemas as SC
from catloss.inputs import RunInputs
from catloss.operators.ep_convert import ep_wide_to_long
from catloss.sources import bridge as B

# How customers are dealt to portfolios.
LOB_MOD, ROLLUP_MOD = 400, 97
PREFIX = {"verisk": "VN", "risklink": "RN"}
# metric column: multiplier of the base loss
METRICS = {"AAL_0": 1, "AEP_200": 9, "OEP_200": 7, "OEP_1000": 12}


def _pick(values: list[str], key: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (key % len(values) + 1).cast("int"))


def ep_wide(spark: SparkSession, sf_dir: str, vendor: str) -> DataFrame:
    """One row per customer; some losses are blank or have commas, risklink lacks some customers."""
    c = B._table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    if vendor == "risklink":
        c = c.where(key % 4 != 0)
    base = F.floor(F.col("c_acctbal")).cast("long") + (1000 if vendor == "verisk" else 1100)
    text = {m: (base * k).cast("string") for m, k in METRICS.items()}
    text["AAL_0"] = F.when(key % 13 == 0, F.lit(" ")).otherwise(text["AAL_0"])
    text["OEP_200"] = F.when(key % 3 == 0, F.concat(F.substring(text["OEP_200"], 1, 1), F.lit(","), F.substring(text["OEP_200"], 2, 100))).otherwise(text["OEP_200"])
    return c.select(
        F.concat(F.lit(vendor[0]), key.cast("string")).alias("id"),
        F.concat(F.lit("LC"), (key % LOB_MOD).cast("string")).alias("modelled_lob"),
        F.concat(F.lit(PREFIX[vendor]), F.col("c_nationkey").cast("string")).alias("modelled_peril"),
        *[x.alias(m) for m, x in text.items()],
    )


def lobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lob per portfolio code; a few codes have none."""
    code = B._table(spark, sf_dir, "customer").select((F.col("c_custkey") % LOB_MOD).cast("long").alias("k")).distinct().where("k % 11 <> 5")
    k = F.col("k")
    return SC.conform(code.select(
        k.alias("lob_id"), F.concat(F.lit("LC"), k).alias("modelled_lob"), F.concat(F.lit("CR"), k % ROLLUP_MOD).alias("rollup_lob"),
        _pick(["prop", "fa"], k).alias("lob_type"), F.concat(F.lit("Class "), k % 5).alias("cds_cat_class_name"),
        _pick(["DE", "FR", "GB", "IE"], k).alias("office"), _pick(["HH", "FA", "COMM"], k).alias("class"), _pick(["EUR", "GBP", "USD", "JPY"], k).alias("currency"),
    ), SC.SEED_SCHEMAS["lobs"])


def perils(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two perils per nation, one of each vendor; a rollup peril per region."""
    n = B._table(spark, sf_dir, "nation")
    key, region = F.col("n_nationkey").cast("long"), F.col("n_regionkey").cast("long")
    n = n.select("*", F.explode(F.array(*map(F.lit, PREFIX.values()))).alias("prefix"))
    return SC.conform(n.select(
        F.concat("prefix", key).alias("modelled_peril"), F.concat(F.lit("Region "), region).alias("rollup_peril"), F.lit("World").alias("region"),
        F.lit("ALL").alias("peril"), (500 + region).alias("region_peril_id"),
        F.concat((500 + region).cast("string"), F.when(key % 2 == 0, "a").otherwise("b")).alias("blend_subregion_peril_id"),
        F.when(key == 7, None).when(region % 2 == 0, "verisk").otherwise("risklink").alias("base_model"),
        F.when(key % 5 != 0, key % 3).alias("selection_priority"),
        (key % 4 == 0).cast("long").alias("is_dialsup"), (region == 3).cast("long").alias("is_euws"),
    ), SC.SEED_SCHEMAS["perils"])


def blending_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of both subregions of every region but the last, which has those of one."""
    r = B._table(spark, sf_dir, "region")
    key = F.col("r_regionkey").cast("long")
    r = r.select("*", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("sub")).where((key < 4) | (F.col("sub") == "a"))
    air = F.when(F.col("sub") == "a", key * F.lit(0.25)).otherwise(F.lit(0.5))
    return SC.conform(r.select(
        key.alias("id"), F.lit(1).alias("BlendSetID"), (500 + key).alias("RegionPerilID"), F.col("r_name").alias("RegionPeril"),
        F.concat((500 + key).cast("string"), "sub").alias("SubRegionPerilID"), F.when(F.col("sub") == "a", F.col("r_name")).alias("SubRegionPeril"),
        air.alias("AIRBlend"), (1 - air).alias("RMSBlend"), F.lit(0.0).alias("KatRiskBlend"), F.lit("2026-01-01").alias("DateCreated"),
    ), SC.SEED_SCHEMAS["blending_factors"])


def ep_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [ep_wide_to_long(ep_wide(spark, sf_dir, v), v, source="customer") for v in PREFIX]
    return parts[0].unionByName(parts[1])


def table_inputs(spark: SparkSession, sf_dir: str) -> RunInputs:
    """``bridge_inputs`` with the EP summaries and their seeds from the tables."""
    plain = B.bridge_inputs(spark, sf_dir)
    seeds = plain.seeds | {"lobs": lobs(spark, sf_dir), "perils": perils(spark, sf_dir), "blending_factors": blending_factors(spark, sf_dir)}
    return RunInputs(seeds=seeds, ylts=plain.ylts, ep_summaries=ep_long(spark, sf_dir), data_root=B.BRIDGE_DATA_ROOT)
