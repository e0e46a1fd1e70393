"""The bundle of input frames a run works on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from catloss.schemas import REQUIRED_SEED_STEMS


@dataclass(frozen=True)
class RunInputs:
    """Seeds by file stem, raw YLT per vendor, EP summaries in long form."""

    seeds: dict[str, DataFrame]
    ylts: dict[str, DataFrame]
    ep_summaries: DataFrame
    data_root: str = "data"

    def seed(self, stem: str) -> DataFrame:
        try:
            return self.seeds[stem]
        except KeyError:
            raise ValueError(f"the run has no seed {stem!r}; its seeds are {sorted(self.seeds)}") from None


def check_seeds(seeds: dict[str, DataFrame]) -> None:
    """Raise one error that names all required stems without a seed."""
    absent = set(REQUIRED_SEED_STEMS).difference(seeds)
    if absent:
        raise ValueError(f"seeds without a file: {', '.join(sorted(absent))}")
