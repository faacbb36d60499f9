"""The mart over the bound source tables: every layer is written once per session and read back by the next one."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from checks import binding
from martloom import MartSettings, schemas
from martloom.plans import dims, pipeline
from martloom.session import scratch_path
from martloom.sinks.writers import write_full, write_period
from martloom.sources.readers import read_mart

# Measures cover 1996-1999; the two agreement periods cover January 2024, where the journal entries lie.
SETTINGS = MartSettings(
    from_date=date(1996, 1, 1), to_date=date(1999, 12, 31),
    period_start=date(2024, 1, 1), period_end=date(2024, 1, 16),
    calendar_start=date(1995, 1, 1), calendar_end=date(2024, 12, 31), as_of=date(2001, 8, 1),
    # The queries return rows; how a written fact is laid out does not concern them.
    cluster_facts=False,
)
PERIODS = ((date(2024, 1, 1), date(2024, 1, 16)), (date(2024, 1, 16), date(2024, 1, 31)))
# The report looks at part of the measured invoices and at both periods.
REPORT = SETTINGS.with_(from_date=date(1997, 1, 1), to_date=date(2024, 12, 31))


class Mart(Mapping):
    """Mart tables by name, written on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, settings: MartSettings = SETTINGS) -> None:
        self.spark = spark
        self.settings = settings
        self.src = dims.LoadSources(binding.Sources(spark, sf_dir))
        self.root = scratch_path(spark, "mart")
        self._tables: dict[str, DataFrame] = {}

    def build(self, table: str) -> DataFrame:
        return pipeline.build(table, self.spark, self.src, self, self.settings)

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._tables:
            path = f"{self.root}/{table}"
            if table in schemas.PERIOD_TABLES:
                for start, end in PERIODS:
                    settings = self.settings.with_(period_start=start, period_end=end)
                    rows = pipeline.build(table, self.spark, self.src, self, settings)
                    write_period(rows, path, start, end, settings.tenant_ids)
            else:
                write_full(self.build(table), path)
            self._tables[table] = read_mart(self.spark, self.root, table)
        return self._tables[table]

    def written(self, table: str) -> None:
        """A load into another folder has no effect on these tables."""

    def __iter__(self) -> Iterator[str]:
        return iter(pipeline.TABLES)

    def __len__(self) -> int:
        return len(pipeline.TABLES)


_OPEN: dict[tuple[str, str], Mart] = {}


def open_mart(spark: SparkSession, sf_dir: str) -> Mart:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        _OPEN[key] = Mart(spark, sf_dir)
    return _OPEN[key]
