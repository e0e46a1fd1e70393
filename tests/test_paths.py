"""Runs and validation from a data folder."""

import os
import shutil
import tempfile

import pytest

from catloss import schemas as SC
from catloss.plans import pipeline as PL
from catloss.sources.bridge import bridge_inputs
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def folder(spark) -> str:
    """The bridge's inputs as files, by the rules of discovery."""
    root = tempfile.mkdtemp(prefix="catloss-data-")
    inputs = bridge_inputs(spark, SF_SMALL, lob_mod=5, include_unmapped=False)
    for vendor, df in inputs.ylts.items():
        df.write.parquet(f"{root}/ylt/{vendor}/part.parquet")
        inputs.ep_summaries.where(f"vendor = '{vendor}'").write.option("header", True).csv(f"{root}/ep_summaries/{vendor}/all.long.csv")
    for stem, df in inputs.seeds.items():
        df.write.parquet(f"{root}/seeds/{stem}.parquet")
    return root


def test_validate_paths_gives_a_verdict_and_both_reports(spark, folder):
    out = tempfile.mkdtemp(prefix="catloss-out-")
    found = PL.validate_paths(spark, folder, out)
    assert found.is_valid
    assert [os.path.basename(p) for p in found.paths] == [PL.COVERAGE_FILE, PL.INPUT_AAL_FILE]
    assert all(os.path.exists(p) for p in found.paths)
    assert spark.read.option("header", True).csv(found.paths[1]).count() == found.input_aal.count() > 0


def test_unmapped_inputs_are_invalid_but_reported(spark, folder):
    out = tempfile.mkdtemp(prefix="catloss-out-")
    inputs = bridge_inputs(spark, SF_SMALL)
    inputs.seeds["lobs"] = inputs.seeds["lobs"].limit(1)
    found = PL.write_validation(inputs, out)
    assert not found.is_valid
    assert found.coverage.where("severity = 'error'").count() > 0 and found.input_aal.count() == 0
    assert found.input_aal.columns == SC.names(SC.INPUT_AAL)
    assert all(os.path.exists(p) for p in found.paths)


def test_validation_needs_the_required_seeds(spark, folder):
    root = tempfile.mkdtemp(prefix="catloss-data-") + "/data"
    shutil.copytree(folder, root, ignore=shutil.ignore_patterns("perils.parquet"))
    out = tempfile.mkdtemp(prefix="catloss-out-")
    with pytest.raises(ValueError, match="seeds without a file: perils"):
        PL.validate_paths(spark, root, out)
    assert os.listdir(out) == []


def test_run_from_a_folder_publishes_what_a_run_of_frames_does(spark, folder):
    out = tempfile.mkdtemp(prefix="catloss-out-")
    res = PL.run_paths(spark, folder, out, write_analysis=False, register_views=False)
    assert os.path.exists(res.mts_combined) and os.path.exists(res.mts_wide) and res.mart_files
    assert spark.read.parquet(res.mts_combined).columns == SC.names(SC.MAIN_LONG)
