"""Scans (S1, S2, S5) with declared schemas: nothing is inferred."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from martloom import schemas
from martloom.sinks.versions import VersionedTable

_TABLE_PREFIX = "table:"
_MISSING = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def _scan(spark: SparkSession, root: str, name: str, columns: dict[str, str]) -> DataFrame:
    """``root`` is a folder, or ``table:<catalog.schema>`` for tables of a catalog."""
    if root.startswith(_TABLE_PREFIX):
        return schemas.conform(spark.table(f"{root[len(_TABLE_PREFIX):]}.{name.replace('.', '_')}"), columns)
    return spark.read.schema(schemas.ddl(columns)).parquet(f"{root}/{name.replace('.', '/')}")


def read_raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    return _scan(spark, root, name, schemas.RAW[name])


def read_external(spark: SparkSession, root: str, name: str) -> DataFrame:
    return _scan(spark, root, name, schemas.EXTERNAL[name])


def read_mart(spark: SparkSession, root: str, name: str, where: Mapping[str, object] | None = None) -> DataFrame:
    """The current version of a mart table; of tables stored in parts only those that ``where`` names."""
    if root.startswith(_TABLE_PREFIX):
        return _scan(spark, root, name, schemas.MART[name])
    return VersionedTable(spark, f"{root}/{name}").read(schemas.ddl(schemas.MART[name]), where)


def read_keys(spark: SparkSession, root: str, table: str, columns: Iterable[str]) -> DataFrame | None:
    """The surrogate keys handed out so far for a dimension; None before the first."""
    known = VersionedTable(spark, f"{root}/_keys/{table}")
    return known.read(schemas.ddl({c: schemas.MART[table][c] for c in columns})) if known.current() else None


class _Tables(Mapping):
    """Tables by name, opened when first asked for. A table that does not exist is a missing key."""

    def __init__(self, names: Iterable[str], scan: Callable[[str], DataFrame]) -> None:
        self._names = tuple(names)
        self._scan = scan
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._open:
            try:
                self._open[name] = self._scan(name)
            except FileNotFoundError as error:
                raise KeyError(f"no table {name}") from error
            except AnalysisException as error:
                if error.getCondition() in _MISSING:
                    raise KeyError(f"no table {name}") from error
                raise
        return self._open[name]

    def written(self, name: str) -> None:
        """Forget an opened table whose files have been replaced."""
        self._open.pop(name, None)

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def read_sources(spark: SparkSession, raw_root: str, external_root: str) -> _Tables:
    """All source tables."""

    def scan(name: str) -> DataFrame:
        return read_raw(spark, raw_root, name) if name in schemas.RAW else read_external(spark, external_root, name)

    return _Tables((*schemas.RAW, *schemas.EXTERNAL), scan)


def mart_tables(spark: SparkSession, root: str) -> _Tables:
    """All tables of a mart."""
    return _Tables(schemas.MART, lambda name: read_mart(spark, root, name))
