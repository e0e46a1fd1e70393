"""End-to-end run: validate inputs, build both streams, publish every output.

Order of work (one Spark application):

1. required seeds + coverage gate (tiny actions);
2. both streams ranked in one pass (``RunFrames.scored``:
   writes narrow ranked rows once, which both long marts read);
3. the two long marts are written; everything else reads them back, as the
   published files are column-pruned and filter-pushed scans;
4. event validation, wide output, fanout partitions, EP report, inspection views.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from catloss import schemas as SC
from catloss.inputs import RunInputs, check_seeds
from catloss.operators import marts as MT
from catloss.operators import quality as QL
from catloss.operators import report as RP
from catloss.params import RunParams
from catloss.plans.frames import RunFrames
from catloss.session import ensure_checkpoint_dir
from catloss.sinks import writers as W
from catloss.sources.files import load_inputs
from catloss.sql import templates as TPL

# Published file and folder names.
COMBINED_YLT_FILE = "mts_tbl_ylt_combined_all_factors.parquet"
WIDE_YLT_FILE = "mts_tbl_ylt_combined_all_factors_wide.parquet"
DIALSUP_YLT_FILE = "mts_tbl_ylt_dialsup.parquet"
EVENT_VALIDATION_FILE = "mts_event_validation.parquet"
EP_REPORT_FILE = "ep_report.csv"
COVERAGE_FILE = "modelled_lob_peril_anti_join_report.csv"
INPUT_AAL_FILE = "input_ylt_aal_by_lob_peril_summary.csv"
MARTS_DIR = "marts"
ANALYSIS_DIR = "analysis"
DEBUG_DIR = "debug"


@dataclass(frozen=True)
class RunResult:
    output_root: str
    mts_combined: str
    mts_wide: str
    mts_dialsup: str
    event_validation: str
    marts_dir: str
    mart_files: tuple[str, ...]
    ep_report_path: str | None
    debug_dir: str | None


def _join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def run(
    spark: SparkSession,
    inputs: RunInputs,
    output_root: str,
    params: RunParams | None = None,
    *,
    write_analysis: bool = True,
    debug: bool = False,
    register_views: bool = True,
) -> RunResult:
    params = params or RunParams()
    QL.validate_inputs(inputs)
    fr = RunFrames(inputs, params)

    combined = W.write_parquet(fr.main_long, _join(output_root, COMBINED_YLT_FILE))
    dialsup = W.write_parquet(fr.dialsup_long, _join(output_root, DIALSUP_YLT_FILE))
    main_long = W.read_parquet(spark, combined, SC.MAIN_LONG)
    dialsup_long = W.read_parquet(spark, dialsup, SC.DIALSUP_LONG)

    main_fan = MT.main_fanout(main_long, fr.risklink_events, fr.risklink_catalogue_small)
    dialsup_fan = MT.dialsup_fanout(dialsup_long, fr.risklink_events, fr.risklink_catalogue_small)
    event_path = W.write_parquet(
        MT.event_validation(main_fan, dialsup_fan), _join(output_root, EVENT_VALIDATION_FILE)
    )
    wide_path = W.write_wide(main_long, dialsup_long, _join(output_root, WIDE_YLT_FILE), fr.candidate_dates)
    marts_dir = _join(output_root, MARTS_DIR)
    mart_files = W.write_fanout_partitions({"main_fanout": main_fan, "dialsup_fanout": dialsup_fan}, marts_dir)

    report_path = None
    report: DataFrame | None = None
    if write_analysis:
        report = RP.ep_report(main_long, dialsup_long, params)
        report_path = W.write_csv(report, _join(output_root, ANALYSIS_DIR, EP_REPORT_FILE))

    debug_dir = None
    if debug:
        debug_dir = _join(output_root, DEBUG_DIR)
        W.write_debug(fr.debug_layers(), debug_dir)

    if register_views:
        tables = [
            (TPL.MAIN_TABLE, main_long),
            (TPL.DIALSUP_TABLE, dialsup_long),
            (TPL.WIDE_TABLE, W.read_parquet(spark, wide_path)),
            ("mts_event_validation", W.read_parquet(spark, event_path)),
            *((f.rsplit("/", 1)[-1].removesuffix(".parquet"), W.read_parquet(spark, f)) for f in mart_files),
            *inputs.seeds.items(),
        ]
        if report is not None:
            written = spark.read.schema(report.schema).option("header", True).csv(report_path)
            tables.append((TPL.REPORT_TABLE, written))
        W.register_tables(tables)

    fr.close()  # views read outputs and seeds, no intermediate table
    return RunResult(
        output_root=output_root,
        mts_combined=combined,
        mts_wide=wide_path,
        mts_dialsup=dialsup,
        event_validation=event_path,
        marts_dir=marts_dir,
        mart_files=tuple(sorted(mart_files)),
        ep_report_path=report_path,
        debug_dir=debug_dir,
    )


def build_ep_report(spark: SparkSession, output_root: str, params: RunParams | None = None) -> DataFrame:
    """EP report from existing outputs (S5: column-pruned, filter-pushed scans)."""
    params = params or RunParams()
    main_long = W.read_parquet(spark, _join(output_root, COMBINED_YLT_FILE), SC.MAIN_LONG)
    dialsup_long = W.read_parquet(spark, _join(output_root, DIALSUP_YLT_FILE), SC.DIALSUP_LONG)
    return RP.ep_report(main_long, dialsup_long, params)


def run_paths(
    spark: SparkSession, data_root: str, output_root: str, params: RunParams | None = None, **options
) -> RunResult:
    """One call from a data folder to the published outputs (``options``: those of ``run``)."""
    return run(spark, load_inputs(spark, data_root), output_root, params, **options)


@dataclass(frozen=True)
class Validation:
    """Validate-only result: whether a run would start, and the two reports."""

    is_valid: bool
    coverage: DataFrame
    input_aal: DataFrame
    paths: tuple[str, ...] = ()


def validate(inputs: RunInputs, params: RunParams | None = None) -> Validation:
    """Validate-only mode: required seeds (a missing one is an error), coverage, input AAL (empty when blocked).

    The coverage report is computed once and read for the verdict, the gate and the output.
    """
    check_seeds(inputs.seeds)
    coverage = QL.dimension_coverage(inputs)
    ensure_checkpoint_dir(coverage.sparkSession)
    coverage = coverage.checkpoint()
    aal = QL.input_aal_summary(inputs, params or RunParams(), coverage=coverage)
    return Validation(not QL.has_blocking_errors(coverage), coverage, aal)


def validation_reports(inputs: RunInputs, params: RunParams | None = None) -> dict[str, DataFrame]:
    """The reports of validate-only mode, by file name."""
    found = validate(inputs, params)
    return {COVERAGE_FILE: found.coverage, INPUT_AAL_FILE: found.input_aal}


def write_validation(inputs: RunInputs, output_root: str, params: RunParams | None = None) -> Validation:
    """Both reports are staged before either replaces its predecessor; an invalid input still gets its reports."""
    found = validate(inputs, params)
    reports = {COVERAGE_FILE: found.coverage, INPUT_AAL_FILE: found.input_aal}
    paths = W.write_csvs({_join(output_root, ANALYSIS_DIR, name): df for name, df in reports.items()})
    return replace(found, paths=tuple(paths))


def write_validation_reports(inputs: RunInputs, output_root: str, params: RunParams | None = None) -> list[str]:
    """The paths that ``write_validation`` writes."""
    return list(write_validation(inputs, output_root, params).paths)


def validate_paths(spark: SparkSession, data_root: str, output_root: str, params: RunParams | None = None) -> Validation:
    """Validate-only mode from a data folder."""
    return write_validation(load_inputs(spark, data_root), output_root, params)


__all__ = [
    "run", "run_paths", "RunResult", "build_ep_report", "Validation", "validate", "validate_paths", "validation_reports", "write_validation",
    "write_validation_reports",
]
