"""Atomic publishing, fanout partitions and the end-to-end run."""

import contextlib
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from catloss.plans import pipeline as PL
from catloss.sinks import writers as W
from catloss.sources import bridge as B
from tests.conftest import SF_SMALL


def _tmp() -> str:
    return tempfile.mkdtemp(prefix="catloss-test-")


def test_failed_write_keeps_previous_output(spark):
    path = os.path.join(_tmp(), "out.parquet")
    W.write_parquet(spark.range(3), path)
    bad = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception):
        W.write_parquet(bad, path)
    assert spark.read.parquet(path).count() == 3
    assert [n for n in os.listdir(os.path.dirname(path)) if n.startswith(".")] == []


def test_parquet_suffix_required(spark):
    with pytest.raises(ValueError):
        W.write_parquet(spark.range(1), os.path.join(_tmp(), "out.csv"))


def test_end_to_end_run_publishes_every_output(spark):
    out = _tmp()
    inputs = B.bridge_inputs(spark, SF_SMALL, lob_mod=5, include_unmapped=False)
    # a stale fanout of an earlier run must disappear
    os.makedirs(os.path.join(out, "marts", "HiscoAIR_199901_euws_override.parquet"))
    res = PL.run(spark, inputs, out)
    names = sorted(os.listdir(out))
    assert {"mts_tbl_ylt_combined_all_factors.parquet", "mts_tbl_ylt_dialsup.parquet",
            "mts_tbl_ylt_combined_all_factors_wide.parquet", "mts_event_validation.parquet",
            "analysis", "marts"} <= set(names)
    marts = sorted(os.listdir(os.path.join(out, "marts")))
    assert "HiscoAIR_199901_euws_override.parquet" not in marts
    assert "HiscoAIR_202601_euws_override.parquet" in marts and "HiscoRMS_202607_dialsup_localccy_forecast.parquet" in marts
    fan = spark.read.parquet(os.path.join(out, "marts", "HiscoAIR_202601_euws_override.parquet"))
    assert fan.columns == W.FANOUT_FILE_COLUMNS
    main = spark.read.parquet(res.mts_combined)
    final_air = main.where("metric = 'euws_override' AND base_model = 'verisk' AND forecast_date = DATE'2026-01-01'")
    assert fan.count() == final_air.count()
    report = spark.read.option("header", True).csv(res.ep_report_path)
    assert report.count() == spark.table("ep_report").count() > 0


def test_blocking_coverage_stops_the_run(spark):
    inputs = B.bridge_inputs(spark, SF_SMALL)  # LOB5 / LOB9 are unmapped on purpose
    with pytest.raises(ValueError, match="without a seed mapping"):
        PL.run(spark, inputs, _tmp())


def test_report_from_existing_outputs_and_validate_only(spark):
    out = _tmp()
    inputs = B.bridge_inputs(spark, SF_SMALL, lob_mod=5, include_unmapped=False)
    PL.run(spark, inputs, out, register_views=False, debug=True)
    dumped = set(os.listdir(os.path.join(out, "debug")))
    assert {"src_ep_summaries.parquet", "seed_lobs.parquet", "stg_verisk_ylt.parquet",
            "int_ylt_main_ranked.parquet", "int_ylt_dialsup_metric_stream.parquet",
            "mts_ylt_main_long.parquet"} <= dumped
    assert len(dumped) == 1 + 9 + 6 + 26 + 5
    again = PL.build_ep_report(spark, out)
    from catloss.plans.frames import RunFrames
    direct = RunFrames(inputs).ep_report()
    keyed = lambda df: {tuple(r)[:-1]: r.loss for r in df.collect()}
    a, b = keyed(again), keyed(direct)
    # sums of doubles: the last bit depends on the order of addition
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], rel=1e-12) for k in a)
    paths = PL.write_validation_reports(inputs, out)
    cov = spark.read.option("header", True).csv(paths[0])
    aal = spark.read.option("header", True).csv(paths[1])
    assert cov.count() == 0 and aal.count() > 0


def _fanout(spark, dates, broken=False):
    loss = F.raise_error(F.lit("boom")).cast("double") if broken else F.lit(1.5)
    rows = spark.createDataFrame([(d,) for d in dates], "d string")
    return rows.select(
        F.to_date("d").alias("forecast_date"), F.lit("verisk").alias("base_model"), F.lit("euws_override").alias("metric"),
        *[(loss if c == "ModelGrossLoss" else F.lit(1)).alias(c) for c in W.FANOUT_FILE_COLUMNS])


def test_fanout_publish_replaces_all_or_nothing(spark):
    marts = os.path.join(_tmp(), "marts")
    first = W.write_fanout_partitions({"a": _fanout(spark, ["2026-01-01", "2026-02-01"])}, marts)
    assert [os.path.basename(p) for p in first] == ["HiscoAIR_202601_euws_override.parquet", "HiscoAIR_202602_euws_override.parquet"]
    os.makedirs(os.path.join(marts, "other.parquet"))
    before = sorted(os.listdir(marts))
    with pytest.raises(Exception, match="boom"):
        W.write_fanout_partitions({"a": _fanout(spark, ["2026-03-01"], broken=True)}, marts)
    with pytest.raises(ValueError, match="share the file"):
        W.write_fanout_partitions({"a": _fanout(spark, ["2026-03-01", "2026-03-15"])}, marts)
    assert sorted(os.listdir(marts)) == before and os.listdir(os.path.dirname(marts)) == ["marts"]
    W.write_fanout_partitions({"a": _fanout(spark, ["2026-03-01"])}, marts)
    assert os.listdir(marts) == ["HiscoAIR_202603_euws_override.parquet"]
    assert spark.read.parquet(os.path.join(marts, "HiscoAIR_202603_euws_override.parquet")).columns == W.FANOUT_FILE_COLUMNS


def test_reports_are_replaced_together(spark):
    out = _tmp()
    a, b = os.path.join(out, "a.csv"), os.path.join(out, "b.csv")
    W.write_csvs({a: spark.range(2), b: spark.range(3)})
    bad = spark.range(1).select(F.raise_error(F.lit("boom")).cast("string").alias("id"))
    with pytest.raises(Exception, match="boom"):
        W.write_csvs({a: spark.range(5), b: bad})
    read = lambda p: spark.read.option("header", True).csv(p).count()
    assert (read(a), read(b)) == (2, 3) and sorted(os.listdir(out)) == ["a.csv", "b.csv"]
    W.write_csvs({a: spark.range(5), b: spark.range(6)})
    assert (read(a), read(b)) == (5, 6) and sorted(os.listdir(out)) == ["a.csv", "b.csv"]


def test_grown_source_is_judged_anew(spark):
    from catloss.functions.joins import is_bounded
    path = os.path.join(_tmp(), "lookup")
    spark.range(10).write.parquet(path)
    assert is_bounded(spark.read.parquet(path), max_rows=100, max_bytes=0)
    spark.range(1000).write.mode("append").parquet(path)
    assert not is_bounded(spark.read.parquet(path), max_rows=100, max_bytes=0)


def test_duplicate_inspection_names_rejected(spark):
    with pytest.raises(ValueError, match="duplicate inspection table names"):
        W.register_tables([("ep_report", spark.range(1)), ("ep_report", spark.range(2))])


def test_window_and_range_runs_publish_the_same_marts(spark):
    from catloss.params import RunParams
    inputs = B.bridge_inputs(spark, SF_SMALL, lob_mod=5, include_unmapped=False)
    a = PL.run(spark, inputs, _tmp(), RunParams(rank_strategy="window"), write_analysis=False, register_views=False)
    b = PL.run(spark, inputs, _tmp(), RunParams(rank_strategy="range"), write_analysis=False, register_views=False)
    for path_a, path_b in [(a.mts_combined, b.mts_combined), (a.mts_dialsup, b.mts_dialsup), (a.mts_wide, b.mts_wide)]:
        da, db = spark.read.parquet(path_a), spark.read.parquet(path_b)
        assert da.exceptAll(db).count() == 0 and db.exceptAll(da).count() == 0


class Stop(Exception):
    pass


@pytest.mark.parametrize("step", range(12))
def test_a_publication_that_stops_leaves_old_or_new_outputs(spark, monkeypatch, step):
    out = _tmp()
    a, b = os.path.join(out, "a.csv"), os.path.join(out, "b.csv")
    W.write_csvs({a: spark.range(2), b: spark.range(3)})
    calls = [0]

    def counted(name):
        real = getattr(W._FS, name)

        def call(self, *args):
            calls[0] += 1
            if calls[0] > step:
                raise Stop
            return real(self, *args)

        return call

    with monkeypatch.context() as m:
        for name in ("rename", "delete", "write"):
            m.setattr(W._FS, name, counted(name))
        with pytest.raises(Stop) if step < 9 else contextlib.nullcontext():
            W.write_csvs({a: spark.range(5), b: spark.range(6)})
    W.recover(spark, out)
    read = lambda p: spark.read.option("header", True).csv(p).count()
    assert (read(a), read(b)) == ((2, 3) if step < 2 else (5, 6))
    W.write_csvs({a: spark.range(7), b: spark.range(8)})
    assert (read(a), read(b)) == (7, 8)


def test_a_folder_moved_in_part_is_completed(spark):
    out = _tmp()
    path = os.path.join(out, "x.parquet")
    W.write_parquet(spark.range(40).repartition(4), path)
    folder = os.path.join(out, W.PUBLISHING + "1")
    os.makedirs(os.path.join(folder, "x.parquet"))
    moved = sorted(n for n in os.listdir(path) if n.startswith("part-"))[:2]
    for n in moved:
        os.rename(os.path.join(path, n), os.path.join(folder, "x.parquet", n))
    fs = W._FS(spark, out)
    fs.write(f"{folder}/cleared-0", "")
    fs.write(f"{folder}/{W.JOURNAL}", json.dumps([[f"{folder}/x.parquet", path]]))
    assert sorted(r.id for r in W.read_parquet(spark, path).collect()) == list(range(40)) and os.listdir(out) == ["x.parquet"]


def _wide_rows(spark, dates, times=1):
    from catloss import schemas as SC
    from tests.conftest import ranked_row, rows
    main = [dict(ranked_row(), metric="euws_override", forecast_date=d, loss=10.0, target_currency="EUR", output_use="cds_main") for d in dates] * times
    dial = [dict(ranked_row(), metric="dialsup_localccy_forecast", forecast_date=d, loss=5.0, target_currency="EUR", output_use="cds_dialsup") for d in dates]
    return rows(spark, SC.MAIN_LONG, main), rows(spark, SC.DIALSUP_LONG, dial)


def test_wide_sink_observes_duplicates_and_dates_in_one_shuffle(spark):
    import datetime as dt
    path = os.path.join(_tmp(), "wide.parquet")
    d1, d2 = dt.date(2026, 1, 1), dt.date(2026, 7, 1)
    W.write_wide(*_wide_rows(spark, [d1, d2]), path, ["2026-07-01", "2026-01-01"])
    first = W.read_parquet(spark, path)
    assert [c for c in first.columns if c.endswith("_loss")] == [f"{m}_{x}_loss" for m in ("euws_override", "dialsup_localccy_forecast") for x in ("202601", "202607")]
    assert first.count() == 1 and not any(c.startswith("_") for c in first.columns)
    with pytest.raises(ValueError, match="2 duplicate grain rows of euws_override"):
        W.write_wide(*_wide_rows(spark, [d1, d2], times=2), path, ["2026-01-01", "2026-07-01"])
    with pytest.raises(ValueError, match="no forecast date"):
        W.write_wide(*_wide_rows(spark, []), path, ["2026-01-01"])
    assert W.read_parquet(spark, path).count() == 1
    W.write_wide(*_wide_rows(spark, [d2]), path, ["2026-01-01", "2026-07-01"])  # a date without rows has no column
    assert [c for c in W.read_parquet(spark, path).columns if c.endswith("_loss")] == ["euws_override_202607_loss", "dialsup_localccy_forecast_202607_loss"]
    from catloss.operators import wide as WD
    plan = WD.wide_pivot(WD.wide_source(*_wide_rows(spark, [d1])), ["2026-01-01"], grain=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_fanout_input_is_checked(spark):
    marts = os.path.join(_tmp(), "marts")
    with pytest.raises(ValueError, match="no column ModelYOA"):
        W.write_fanout_partitions({"a": _fanout(spark, ["2026-01-01"]).drop("ModelYOA")}, marts)
    with pytest.raises(ValueError, match="forecast_date is string"):
        W.write_fanout_partitions({"a": _fanout(spark, ["2026-01-01"]).withColumn("forecast_date", F.lit("2026-01-01"))}, marts)
    with pytest.raises(ValueError, match="no fanout"):
        W.write_fanout_partitions({}, marts)
