"""The job file: YAML (or JSON, which is YAML) with one section per dataset and one for the result."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

import yaml

from shelfgap.sources.tables import DEFAULT_FORMAT
from shelfgap.specs import DATASETS

# Key names of the job file.
RESULT_SECTION = "recommendation"
INPUT_KEY = "input_path"
TABLE_KEY = "hudi_output_path"
RESULT_TABLE_KEYS = {name: f"{name}_hudi" for name in DATASETS}
RESULT_KEY = "output_csv"


@dataclass(frozen=True)
class DatasetPaths:
    """Optional per dataset: ``quarantine_path``, ``bronze_path`` (a copy of the raw text,
    of an incremental ingest by load day) and ``ledger_path`` (the files that an incremental ingest has read)."""

    input: str
    table: str
    quarantine: str
    bronze: str | None = None
    ledger: str | None = None


@dataclass(frozen=True)
class ResultPaths:
    tables: Mapping[str, str]
    output: str


@dataclass(frozen=True)
class Options:
    """The optional section ``options``; the defaults are the plain batch run."""

    table_format: str = DEFAULT_FORMAT
    write: str = "overwrite"  # or upsert
    evolve: bool = False
    dates: str = "lenient"  # or strict
    null_policy: str = "reject"  # or ignore
    keep_raw: bool = False
    price_basis: str = "revenue"  # or unit
    top_n: int = 10
    as_of: str | None = None
    line_breaks: bool = False  # quoted line breaks in the input; its files are then not split
    quarantine_format: str = "csv"  # or parquet, which keeps line breaks and raw values nested
    malformed: str = "quarantine"  # or pad: fill up short rows and cut long ones
    incremental: bool = False  # read files that no earlier run has read; needs upsert

    def __post_init__(self) -> None:
        if self.malformed not in ("quarantine", "pad"):
            raise ValueError(f"malformed must be 'quarantine' or 'pad', not {self.malformed!r}")
        if self.incremental and self.write != "upsert":
            raise ValueError("an incremental ingest needs write: upsert, or it would lose earlier rows")


@dataclass(frozen=True)
class JobConfig:
    datasets: Mapping[str, DatasetPaths]
    result: ResultPaths | None
    options: Options = Options()


def _beside(table: str, folder: str, name: str) -> str:
    return f"{os.path.dirname(os.path.dirname(table.rstrip('/')))}/{folder}/{name}"


def parse_config(content: Mapping[str, Any]) -> JobConfig:
    datasets = {}
    for name in DATASETS:
        if name in content:
            section = content[name]
            table = section.get("table_path") or section[TABLE_KEY]
            datasets[name] = DatasetPaths(
                input=section[INPUT_KEY],
                table=table,
                quarantine=section.get("quarantine_path")
                or _beside(table, "quarantine", f"{name}_quarantine"),
                bronze=section.get("bronze_path"),
                ledger=section.get("ledger_path") or _beside(table, "ledger", name),
            )
    result = None
    if RESULT_SECTION in content:
        section = content[RESULT_SECTION]
        tables = {n: section.get(n) or section[key] for n, key in RESULT_TABLE_KEYS.items()}
        # The file name is not used: Spark writes a folder of parts.
        result = ResultPaths(tables, os.path.dirname(section[RESULT_KEY]))
    return JobConfig(datasets, result, Options(**content.get("options", {})))


def load_config(path: str) -> JobConfig:
    with open(path, encoding="utf-8") as file:
        return parse_config(yaml.safe_load(file))
