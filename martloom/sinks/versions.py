"""Stored tables that change by one small file (K1-K3).

A table is a folder. Loads only ever add data folders to it, under names used once; which of them make up the table is
said by the newest complete file in ``_versions``, numbered from 1. That file is written last and never overwritten:

    <table>/data-<id>/...                rows of one load, or of one part of it
    <table>/_versions/00000007.json      {"number": 7, "parts": [{"folder": "data-<id>", "key": {...}}], ...}

So a reader sees the table before a load or after it, whenever the load ends, fails or is killed, and nothing is
renamed, which object stores would do by copying. Parts carry the values that name them, so a load can replace some parts
and keep the others, and a reader can leave parts out before it lists any data. Older versions stay readable until
``sweep`` removes what only they use. One load at a time may write a table; a second one fails on the version file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from martloom.session import releasing

FOLDER = "_versions"
# Versions whose data a sweep leaves: the current one and, for readers that opened it, the one before.
KEPT = 2
# How often rows are added anew when another load was faster.
ATTEMPTS = 20


@dataclass(frozen=True)
class Part:
    """One data folder. ``key`` holds the texts of the values that name the part; empty for a whole table or added rows."""

    folder: str
    key: tuple[tuple[str, str], ...] = ()

    def matches(self, wanted: Mapping[str, set[str]]) -> bool:
        own = dict(self.key)
        return all(column not in own or own[column] in texts for column, texts in wanted.items())


@dataclass(frozen=True)
class Version:
    number: int
    parts: tuple[Part, ...]
    note: Mapping[str, str]


def _text(value) -> str:
    return value.isoformat() if isinstance(value, date) else str(value)


# What was observed while rows were written, and the rows as stored.
Accept = Callable[[Mapping[str, object], DataFrame], None]


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._at = jvm.org.apache.hadoop.fs.Path
        self._store = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._read_text = lambda stream: jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")

    # ---- the versions -------------------------------------------------------------------------------------------
    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return sorted(s.getPath().getName() for s in self._store.listStatus(at)) if self._store.exists(at) else []

    def _numbers(self) -> list[int]:
        return [int(name[:-5]) for name in self._names(f"{self.path}/{FOLDER}") if name.endswith(".json") and name[:-5].isdigit()]

    def _file(self, number: int):
        return self._at(f"{self.path}/{FOLDER}/{number:08d}.json")

    def version(self, number: int) -> Version | None:
        """One version, or None if its file is missing or was not written to its end."""
        if not self._store.exists(self._file(number)):
            return None
        stream = self._store.open(self._file(number))
        try:
            found = json.loads(self._read_text(stream))
        except ValueError:
            return None
        finally:
            stream.close()
        parts = tuple(Part(p["folder"], tuple(sorted(p["key"].items()))) for p in found["parts"])
        return Version(found["number"], parts, found["note"])

    def versions(self) -> list[Version]:
        """All complete versions, the newest first."""
        return [v for n in sorted(self._numbers(), reverse=True) if (v := self.version(n)) is not None]

    def current(self) -> Version | None:
        """The newest complete version; None for a table that was never written."""
        return next((v for n in sorted(self._numbers(), reverse=True) if (v := self.version(n)) is not None), None)

    # ---- reading ------------------------------------------------------------------------------------------------
    def read(self, schema: str | T.StructType, where: Mapping[str, object] | None = None, version: int | None = None) -> DataFrame:
        """The rows of the current (or the given) version. ``where`` gives a value, or several, for key columns: other parts are
        left out; parts without a key are always read."""
        found = self.current() if version is None else self.version(version)
        if found is None:
            raise FileNotFoundError(f"{self.path} has no version {version or ''}")
        wanted = {
            column: {_text(v) for v in (value if isinstance(value, (list, tuple, set)) else [value])} for column, value in (where or {}).items()
        }
        folders = [f"{self.path}/{p.folder}" for p in found.parts if p.matches(wanted)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def exists(self) -> bool:
        return bool(self._numbers())

    # ---- writing ------------------------------------------------------------------------------------------------
    def stage(self, df: DataFrame, *observed, by: Sequence[str] = (), parts: Sequence[Sequence] = ()) -> tuple[tuple[Part, ...], dict]:
        """Write rows into a new data folder; the parts written, and the number of rows and what else was ``observed`` on the way.

        Nothing refers to the folder until ``publish``. With ``by`` and ``parts``, only rows whose columns ``by`` have one of the
        given values are written, each combination into a folder of its own; combinations without rows give no part.
        """
        folder, seen = f"data-{uuid.uuid4().hex}", Observation()
        rows = F.count(F.lit(1)).alias("rows")
        if not by:
            with releasing(self.spark):
                df.observe(seen, rows, *observed).write.parquet(f"{self.path}/{folder}")
            return ((Part(folder),) if seen.get["rows"] else ()), seen.get
        named = [tuple(p) for p in parts]
        shape = T.StructType([df.schema[c] for c in by]).add("part", T.IntegerType())
        # One row per part that the caller has named.
        numbered = self.spark.createDataFrame([(*p, i) for i, p in enumerate(named)], shape)
        chosen = df.join(F.broadcast(numbered), list(by)).select(*df.columns, "part")
        with releasing(self.spark):
            chosen.observe(seen, rows, F.collect_set("part").alias("_parts"), *observed).write.partitionBy("part").parquet(f"{self.path}/{folder}")
        return tuple(Part(f"{folder}/part={i}", tuple(sorted(zip(by, map(_text, named[i]), strict=True)))) for i in sorted(seen.get["_parts"])), seen.get

    def publish(self, parts: Sequence[Part], note: Mapping[str, str] | None = None) -> Version:
        """Make these parts the table. The one step that readers can see."""
        taken = self._numbers()
        number = max(taken, default=0) + 1
        text = json.dumps({"number": number, "note": dict(note or {}), "parts": [{"folder": p.folder, "key": dict(p.key)} for p in parts]})
        self._put(number, text)
        return Version(number, tuple(parts), dict(note or {}))

    def _put(self, number: int, text: str) -> None:
        out = self._store.create(self._file(number), False)  # fails if another load has taken the number
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def replace(self, df: DataFrame, *observed, accept: Accept | None = None, note: Mapping[str, str] | None = None) -> int:
        """K1: these rows become the table. ``accept`` may look at what was written and raise: the table stays as it is then."""
        parts, seen = self.stage(df, *observed)
        if accept:
            accept(seen, self.rows_of(parts, df))
        self.publish(parts, note)
        return seen["rows"]

    def replace_parts(
        self, df: DataFrame, by: Sequence[str], parts: Sequence[Sequence], *observed, accept: Accept | None = None, note: Mapping[str, str] | None = None
    ) -> int:
        """K2, K3: these rows replace the named parts, also by nothing; all other parts and earlier notes stay. Returns rows written."""
        staged, seen = self.stage(df, *observed, by=by, parts=parts)
        if accept:
            accept(seen, self.rows_of(staged, df))
        before = self.current()
        named = {tuple(sorted(zip(by, map(_text, p), strict=True))) for p in parts}
        kept = [p for p in (before.parts if before else ()) if p.key not in named]
        self.publish([*kept, *staged], {**(before.note if before else {}), **(note or {})})
        return seen["rows"]

    def add(self, df: DataFrame) -> int:
        """K4: add rows. Loads that add at the same time are put one after the other."""
        staged, seen = self.stage(df)
        for left in reversed(range(ATTEMPTS)):
            before = self.current()
            try:
                self.publish([*(before.parts if before else ()), *staged], before.note if before else {})
                break
            except Exception:
                now = self.current()
                if not left or (now.number if now else 0) == (before.number if before else 0):
                    raise
        return seen["rows"]

    def rows_of(self, parts: Sequence[Part], like: DataFrame) -> DataFrame:
        """The rows of parts, published or not."""
        if not parts:
            return self.spark.createDataFrame([], like.schema)
        return self.spark.read.schema(like.schema).parquet(*[f"{self.path}/{p.folder}" for p in parts])

    # ---- retention ----------------------------------------------------------------------------------------------
    def sweep(self, kept: int = KEPT) -> list[str]:
        """Remove the files of older versions, and data that no remaining version uses: replaced, or left by a load that ended early.

        Call it before a load, never beside one. Returns the folders removed.
        """
        versions = self.versions()
        stay = {v.number for v in versions[:kept]}
        newest = max(stay, default=0)
        for number in self._numbers():
            # A version file that was not written to its end keeps its number taken.
            if number not in stay and number < newest:
                self._store.delete(self._file(number), False)
        used = {p.folder.split("/")[0] for v in versions[:kept] for p in v.parts}
        gone = [name for name in self._names(self.path) if name.startswith("data-") and name not in used]
        for name in gone:
            self._store.delete(self._at(f"{self.path}/{name}"), True)
        return gone
