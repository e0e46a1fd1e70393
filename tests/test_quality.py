"""Wide->long EP conversion (U12), coverage (U15), gate, input AAL, declarative rules."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from catloss import schemas as SC
from catloss.inputs import RunInputs, check_seeds
from catloss.operators import contracts as CT
from catloss.operators import ep_convert as EC
from catloss.operators import quality as QL
from catloss.params import RunParams
from catloss.sources import bridge as B
from tests.conftest import SF_SMALL, rows


def test_u12_wide_to_long(spark):
    wide = spark.createDataFrame(
        [(" 1 ", "LOB1", "VP1", "STC ", " 1,750,472 ", "2500"), ("2", "LOB1", "VP1", "STC", " 3,000 ", ""),
         ("3", "LOB1", "VP1", "WSC", "9", "9")],
        "id string, modelled_lob string, modelled_peril string, CatalogTypeCode string, AAL_0 string, OEP_200 string",
    )
    got = sorted((r.analysis_id, r.ep_type, r.return_period, r.loss) for r in EC.ep_wide_to_long(wide, "verisk").collect())
    assert got == [("1", "AAL", 0, 1750472.0), ("1", "OEP", 200, 2500.0), ("2", "AAL", 0, 3000.0)]


@pytest.mark.parametrize("cols", [["id", "modelled_lob", "modelled_peril", "aal_0"],
                                  ["id", "modelled_lob", "modelled_peril", "OEP_0200"],
                                  ["id", "modelled_lob", "modelled_peril", "AAL_5"],
                                  ["id", "modelled_lob", "AAL_0"],
                                  ["id", "modelled_lob", "modelled_peril", "note"]])
def test_noncanonical_metric_columns_are_rejected(spark, cols):
    df = spark.createDataFrame([tuple("1" for _ in cols)], ", ".join(f"{c} string" for c in cols))
    with pytest.raises(ValueError):
        EC.ep_wide_to_long(df, "verisk")


def test_unknown_vendor_rejected(spark):
    df = spark.createDataFrame([("1", "L", "P", "1")], "id string, modelled_lob string, modelled_peril string, AAL_0 string")
    with pytest.raises(ValueError, match="writes no EP summaries"):
        EC.ep_wide_to_long(df, "katrisk")


def _coverage_inputs(spark):
    seeds = B.literal_seeds(spark)
    raw = spark.createDataFrame([
        ("VP1", "LOB0", "STC", 1, 41, 1, 1.0),      # mapped
        ("VPX", "LOBX", "STC", 2, 41, 1, 1.0),      # both missing
        ("VPY", "LOBY", "HIST", 3, 41, 1, 1.0),     # non-STC: not checked
    ], SC.RAW_VERISK_YLT)
    ep = rows(spark, SC.EP_LONG, [
        dict(vendor="verisk", analysis_id="a", modelled_lob="LOB0", modelled_peril="VP1", ep_type="AAL",
             return_period=0, loss=1.0),
        dict(vendor="verisk", analysis_id="a", modelled_lob="LOBE", modelled_peril="VPE", ep_type="AAL",
             return_period=0, loss=1.0),
    ])
    rl = spark.createDataFrame([(999, 1, 1, 1.0)], SC.RAW_RISKLINK_YLT)
    return RunInputs(seeds=seeds, ylts={"verisk": raw, "risklink": rl}, ep_summaries=ep, data_root="data")


def test_u15_coverage_reports_only_missing_values(spark):
    inp = _coverage_inputs(spark)
    got = [(r.source_group, r.dimension, r.value, r["count"]) for r in QL.dimension_coverage(inp).collect()]
    assert got == [
        ("ep_summaries", "modelled_lob", "LOBE", 1), ("ep_summaries", "modelled_peril", "VPE", 1),
        ("verisk_ylt", "modelled_lob", "LOBX", 1), ("verisk_ylt", "modelled_peril", "VPX", 1),
    ]
    assert QL.has_blocking_errors(QL.dimension_coverage(inp))
    assert QL.input_aal_summary(inp, RunParams()).count() == 0
    with pytest.raises(ValueError):
        QL.validate_inputs(inp)


def test_required_seed_inventory_lists_all_missing(spark):
    with pytest.raises(ValueError, match="lobs, perils"):
        check_seeds({"fx_rates": None})


def test_input_aal_is_additive_and_ordered(spark):
    inp = B.bridge_inputs(spark, SF_SMALL, lob_mod=5, include_unmapped=False)
    assert not QL.has_blocking_errors(QL.dimension_coverage(inp))
    summary = QL.input_aal_summary(inp, RunParams())
    got = summary.collect()
    assert [r.raw_aal for r in got] == sorted((r.raw_aal for r in got), reverse=True)
    verisk_total = sum(r.loss_sum for r in got if r.vendor == "verisk")
    from catloss.operators.staging import stage_verisk_ylt
    expected = stage_verisk_ylt(inp.ylts["verisk"]).agg(F.sum("loss")).first()[0]
    assert verisk_total == pytest.approx(expected, rel=1e-12)


def test_rules_count_violations(spark):
    df = spark.createDataFrame([(None, 1, -1.0, "x"), ("a", 2, 5.0, "verisk")],
                               "vendor_blank string, n long, loss double, vendor string")
    contract = QL.TableContract("t", "T", {"n": "bigint", "missing": "string"}, rules=(
        QL.Rule("NN", "vendor_blank", "not_null"), QL.Rule("R", "loss", "valid_range", min=0),
        QL.Rule("V", "vendor", "valid_values", values=("verisk", "risklink")),
    ))
    got = {(r.check, r.column): r.violations for r in QL.evaluate_contract(df, contract).collect()}
    assert got[("schema_matches", "n")] == 0 and got[("schema_matches", "missing")] == 1
    assert got[("not_null", "vendor_blank")] == 1 and got[("valid_range", "loss")] == 1
    assert got[("valid_values", "vendor")] == 1


FILE = """
rules:
  - code: FACTORS_SCHEMA
    checks:
      - type: schema_matches
        mode: castable
        allow_extra_columns: false
        columns: {id: int64, share: float64, flag: int64, day: date}
  - code: FACTORS_REQUIRED
    checks:
      - type: not_null
        columns: [id, share]
  - code: FACTORS_SHARE
    checks:
      - {type: valid_range, columns: [share], min: 0, max: 1}
  - code: FACTORS_FLAG
    column: flag
    checks:
      - {type: valid_values, values: ["0", "1"]}
"""


def test_rule_files_compile_to_counts_and_rows(spark, tmp_path):
    (tmp_path / "rules.yml").write_text(FILE)
    contract = CT.read_contract(spark, str(tmp_path / "rules.yml"), "factors")
    df = spark.createDataFrame([
        ("1", "0.5", "1", "2026-01-01", "a"), ("two", "1.5", "2", "soon", "b"), (" ", None, "", None, "c"), (None, "-1", None, "2026-02-30", "d"),
    ], "id string, share string, flag string, day string, note string")
    counts = {(r.code, r.check, r.column): r.violations for r in CT.evaluate_contract(df, contract).collect()}
    assert {k: n for k, n in counts.items() if n} == {
        ("FACTORS_SCHEMA", "schema_matches", "note"): 1, ("FACTORS_SCHEMA", "schema_castable", "id"): 2, ("FACTORS_SCHEMA", "schema_castable", "flag"): 1,
        ("FACTORS_SCHEMA", "schema_castable", "day"): 2, ("FACTORS_REQUIRED", "not_null", "id"): 2, ("FACTORS_REQUIRED", "not_null", "share"): 1,
        ("FACTORS_SHARE", "valid_range", "share"): 2, ("FACTORS_FLAG", "valid_values", "flag"): 2,
    }
    rows = CT.violations(df, contract, "note").collect()
    found = Counter((r.code, r.check, r.column) for r in rows)
    assert found == {k: n for k, n in counts.items() if n and k[1] != "schema_matches"}
    assert {(r.key, r.value) for r in rows if r.check == "valid_range"} == {("b", "1.5"), ("d", "-1")}
    plan = CT.violations(df, contract, "note")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_typed_columns_keep_their_rules(spark):
    df = spark.createDataFrame([(1, 0.5, 0, None), (2, 2.0, 3, None)], "id long, share double, flag long, day date")
    counts = {(r.check, r.column): r.violations for r in CT.evaluate_contract(df, CT.parse_contract(FILE, "factors")).collect()}
    assert counts["valid_range", "share"] == 1 and counts["valid_values", "flag"] == 1 and sum(counts.values()) == 2


@pytest.mark.parametrize("text", ["rules: [{code: X, checks: [{type: unique, columns: [a]}]}]", "rules: [{code: X, checks: [{type: not_null}]}]",
                                  "rules: [{code: X, checks: [{type: schema_matches, columns: {a: money}}]}]"])
def test_rule_files_with_unknown_rules_are_rejected(text):
    with pytest.raises(ValueError, match="X"):
        CT.parse_contract(text, "t")


def test_twelve_contracts():
    assert len(CT.CONTRACTS) == 12 and CT.parse_contract("", "t").rules == ()
