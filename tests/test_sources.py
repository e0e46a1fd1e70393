"""File discovery rules (S1-S4) on temporary folders."""

import os
import tempfile

import pytest

from catloss.sources import files as S


def _write(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


EP_HEADER = "vendor,analysis_id,modelled_lob,modelled_peril,ep_type,return_period,loss,extra\n"


def _tree(spark) -> str:
    root = tempfile.mkdtemp(prefix="catloss-src-")
    _write(f"{root}/seeds/business/lobs.csv",
           "lob_id,modelled_lob,rollup_lob,lob_type,cds_cat_class_name,office,class,currency\n"
           "1,LOB0,RL0,prop,Class A,DE,HH,EUR\n")
    _write(f"{root}/seeds/vor/fx_rates.csv", "currency_code,target_currency,rate_date,rate\nEUR,GBP,2026-01-01,0.88\n")
    _write(f"{root}/ep_summaries/verisk/a/v.long.csv", EP_HEADER + "risklink,7,LOB0,VP0,AAL,0,1.5,x\n")
    _write(f"{root}/ep_summaries/risklink/r.long.csv", EP_HEADER + "risklink,007,LOB0,RP0,OEP,200,2.5,y\n")
    spark.range(2).selectExpr("'VP0' AS Analysis").write.parquet(f"{root}/ylt/verisk/part1.parquet")
    spark.range(2).selectExpr("CAST(id AS BIGINT) AS anlsid").write.parquet(f"{root}/ylt/risklink/p.parquet")
    return root


def test_sources_follow_discovery_rules(spark):
    root = _tree(spark)
    seeds = S.load_seeds(spark, root)
    assert set(seeds) == {"lobs", "fx_rates"}
    assert dict(seeds["lobs"].dtypes)["lob_id"] == "bigint"
    ep = S.load_ep_summaries(spark, root)
    got = sorted((r.vendor, r.analysis_id, r.return_period, r.loss) for r in ep.collect())
    # vendor comes from the folder; extra columns are dropped
    assert got == [("risklink", "7", 200, 2.5), ("verisk", "7", 0, 1.5)]
    assert ep.columns == S.EP_CANONICAL_COLUMNS
    ylts = S.load_ylts(spark, root)
    assert ylts["verisk"].count() == 2


def test_duplicate_seed_stem_rejected(spark):
    root = _tree(spark)
    _write(f"{root}/seeds/other/lobs.csv", "lob_id\n1\n")
    with pytest.raises(ValueError, match="duplicate seed stem"):
        S.load_seeds(spark, root)


def test_unknown_vendor_folder_rejected(spark):
    root = _tree(spark)
    _write(f"{root}/ep_summaries/Verisk/x.long.csv", EP_HEADER)
    with pytest.raises(ValueError, match="unknown EP summary vendor folder"):
        S.load_ep_summaries(spark, root)


def test_missing_vendor_files_rejected(spark):
    root = tempfile.mkdtemp(prefix="catloss-src-")
    _write(f"{root}/ep_summaries/verisk/v.long.csv", EP_HEADER)
    with pytest.raises(FileNotFoundError):
        S.load_ep_summaries(spark, root)


def test_missing_ylt_rejected(spark):
    with pytest.raises(FileNotFoundError):
        S.load_ylts(spark, tempfile.mkdtemp(prefix="catloss-src-"))


def test_wide_csv_conversion_and_batch_writer(spark):
    root = _tree(spark)
    _write(f"{root}/ep_summaries/verisk/Wide.csv", "id,modelled_lob,modelled_peril,AAL_0,OEP_200\n 1 ,LOB0,VP0,\" 1,000 \",5\n")
    _write(f"{root}/ep_summaries/risklink/wide.csv", "id,modelled_lob,modelled_peril,AAL_0\n2,LOB0,RP0,7\n")
    assert [os.path.basename(p) for p in S.scan_ep_summary_csvs(spark, root, "verisk")] == ["Wide.csv"]
    out = S.generate_ep_summaries(spark, root)
    written = spark.read.option("header", True).csv(out["verisk"])
    assert sorted((r.analysis_id, r.loss) for r in written.collect()) == [("1", "1000.0"), ("1", "5.0")]
    # the generated long CSV folder is discovered like a file
    ep = S.load_ep_summaries(spark, root)
    assert ep.where("vendor = 'verisk' AND analysis_id = '1'").count() == 2


def test_ep_files_with_other_column_orders_load_by_name(spark):
    root = _tree(spark)
    _write(f"{root}/ep_summaries/verisk/b.long.csv",
           "return_period,analysis_id,note,modelled_peril,modelled_lob,ep_type,loss,vendor\n200,0012,n,VP9,LOB9,OEP,3.5,verisk\n")
    got = {tuple(r) for r in S.load_ep_summaries(spark, root).where("vendor = 'verisk'")
           .select("analysis_id", "modelled_lob", "modelled_peril", "ep_type", "return_period", "loss").collect()}
    assert got == {("7", "LOB0", "VP0", "AAL", 0, 1.5), ("12", "LOB9", "VP9", "OEP", 200, 3.5)}


def test_many_ep_files_load_in_one_scan_with_constant_jobs(spark):
    """Any number of files and column orders: one CSV scan, and no more jobs than for a few files."""

    def tree(n: int) -> str:
        root = tempfile.mkdtemp(prefix="catloss src %20")
        columns = EP_HEADER.strip().split(",")
        for i in range(n):
            for v in ("verisk", "risklink"):
                values = {"vendor": "?", "analysis_id": f"0{i}", "modelled_lob": f"L{i}", "modelled_peril": "P, Q",
                          "ep_type": "OEP", "return_period": "200", "loss": f"{i}.5", "extra": "x"}
                order = columns[i % len(columns):] + columns[: i % len(columns)]
                cells = [f'"{values[c]}"' if "," in values[c] else values[c] for c in order]
                _write(f"{root}/ep_summaries/{v}/d {i % 7}/f{i}.long.csv", f"\n{','.join(order)}\n{','.join(cells)}\n")
        return root

    def load(n: int):
        sc = spark.sparkContext
        group = f"ep-{n}-{os.getpid()}"
        sc.setJobGroup(group, "load")
        try:
            df = S.load_ep_summaries(spark, tree(n))
            got = df.collect()
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        return df, got, len(sc.statusTracker().getJobIdsForGroup(group))

    _, few, few_jobs = load(20)
    df, many, many_jobs = load(150)
    assert len(few) == 40 and few_jobs >= many_jobs - 1
    assert sorted(tuple(r) for r in many) == sorted(
        (v, str(i), f"L{i}", "P, Q", "OEP", 200, i + 0.5) for i in range(150) for v in ("verisk", "risklink"))
    assert df._jdf.queryExecution().sparkPlan().toString().count("FileScan csv") == 1


def test_ep_file_without_or_with_repeated_columns_rejected(spark):
    root = _tree(spark)
    _write(f"{root}/ep_summaries/verisk/none.long.csv", "")
    with pytest.raises(ValueError, match="none.long.csv is missing EP summary columns"):
        S.load_ep_summaries(spark, root)
    root = _tree(spark)
    _write(f"{root}/ep_summaries/verisk/twice.long.csv", EP_HEADER.replace("extra", "loss"))
    with pytest.raises(ValueError, match=r"\['loss'\], or repeats them"):
        S.load_ep_summaries(spark, root)
