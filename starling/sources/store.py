"""Versioned table store on plain Parquet folders.

Layout: ``<root>/<table>/_load=<id>-<part>-<random>/`` holds rows, ``<root>/<table>/_commits/<version>`` names
the loads that make up a version, with their row counts and highest keys. A commit file is
created only if there is none of that number, as a whole: of two runs that start from the
same version one wins, and the other raises :class:`Conflict` and removes what it wrote. A run
that dies halfway leaves folders that no commit names.

A store object reads one state of each table: the one it saw first, and then its own
commits. Loads belong to parts (``main``, or ``open`` and ``closed`` versions of a history): a commit
may replace one part and add to another, so closed versions are written once.

A full refresh goes into a generation of its own, ``<root>/gen-<id>/<table>/...``, which readers see,
all tables at once, from the moment a file ``<root>/_pointer/<number>`` names it; the same rule of
one winner holds for this file. Without pointers the tables stand in the root itself.

Tables listed in ``bands`` are written in folders by bands of a number that identifies their rows;
``near`` reads only the bands that some other rows touch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.sources import files
from starling.sources.files import CODEC

BAND = "_band"
MOST_BANDS = 10_000  # beyond so many a history is read whole


class Conflict(RuntimeError):
    """Another run has committed since this one read the table."""


class Store:
    def __init__(
        self, spark: SparkSession, root: str, schemas: dict[str, T.StructType], bands: Mapping[str, tuple[str, int]] | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = schemas
        self.bands = dict(bands or {})
        self._seen: dict[str, dict] = {}
        self._at: tuple[int, str] | None = None

    # generations

    def _generations(self) -> list[int]:
        return [int(n) for n in files.list_names(self.spark, f"{self.root}/_pointer") if n.isdigit()]

    def _generation(self) -> tuple[int, str]:
        """Number and folder of the current generation, as first seen."""
        if self._at is None:
            newest = max(self._generations(), default=0)
            name = files.read_text(self.spark, f"{self.root}/_pointer/{newest:08d}").strip() if newest else ""
            self._at = (newest, f"{self.root}/{name}" if name else self.root)
        return self._at

    def branch(self, load_id: str) -> Store:
        """An empty store for a generation that no reader sees before :meth:`switch`; remembers the one it follows."""
        self._generation()
        return Store(self.spark, f"{self.root}/gen-{load_id}-{uuid.uuid4().hex[:8]}", self.schemas, self.bands)

    def switch(self, branch: Store, keep: int = 2) -> None:
        """Make a branch current for all tables at once; remove generations older than the newest ``keep``."""
        number = self._generation()[0] + 1
        name = branch.root.removeprefix(f"{self.root}/")
        if not files.create_new(self.spark, f"{self.root}/_pointer/{number:08d}", name + "\n"):
            files.delete(self.spark, branch.root)
            raise Conflict(f"generation {number} was published by another run")
        self._at, self._seen = None, {}
        for old in sorted(self._generations())[:-keep]:
            path = f"{self.root}/_pointer/{old:08d}"
            files.delete(self.spark, f"{self.root}/{files.read_text(self.spark, path).strip()}")
            files.delete(self.spark, path)

    # states

    def _folder(self, table: str) -> str:
        return f"{self._generation()[1]}/{table}"

    def _versions(self, table: str) -> list[int]:
        return sorted(int(n) for n in files.list_names(self.spark, f"{self._folder(table)}/_commits") if n.isdigit())

    def _read_commit(self, table: str, version: int) -> dict | None:
        """A commit; none if its writer died before the end, where the file system shows such files."""
        text = files.read_text(self.spark, f"{self._folder(table)}/_commits/{version:08d}")
        return json.loads(text) if text.endswith("\n") else None

    def _state(self, table: str) -> dict:
        if table not in self._seen:
            found = None
            for version in reversed(self._versions(table)):
                found = self._read_commit(table, version)
                if found:
                    break
            self._seen[table] = found or {"version": 0, "loads": []}
        return self._seen[table]

    def exists(self, table: str) -> bool:
        return bool(self._state(table)["version"])

    def tables(self) -> list[str]:
        return [t for t in files.list_names(self.spark, self._generation()[1]) if t in self.schemas and self.exists(t)]

    def count(self, table: str) -> int:
        """Rows, as counted in the files when they were written."""
        return sum(load["rows"] for load in self._state(table)["loads"])

    def highest(self, table: str) -> int:
        """The highest value of the table's first column, its surrogate key; 0 without rows."""
        return max((load["highest"] or 0 for load in self._state(table)["loads"]), default=0)

    # reading

    def _stored(self, table: str) -> T.StructType:
        schema = self.schemas[table]
        return T.StructType([*schema.fields, T.StructField(BAND, T.LongType())]) if table in self.bands else schema

    def _frame(self, table: str, part: str | None = None) -> DataFrame:
        loads = [x["path"] for x in self._state(table)["loads"] if x["rows"] and part in (None, x["part"])]
        if not loads:
            return self.spark.createDataFrame([], self._stored(table))
        folder = self._folder(table)
        return self.spark.read.schema(self._stored(table)).option("basePath", folder).parquet(*(f"{folder}/{p}" for p in loads))

    def read(self, table: str, part: str | None = None) -> DataFrame:
        """Content, or one part of it; an empty table of the declared schema when nothing was published."""
        return self._frame(table, part).select(*self.schemas[table].names)

    def near(self, table: str, rows: DataFrame) -> DataFrame:
        """The content that may hold the numbers of ``rows``: only their bands are read."""
        if table not in self.bands:
            return self.read(table)
        found = rows.select(self._band(table).alias(BAND)).filter(F.col(BAND).isNotNull()).distinct().limit(MOST_BANDS + 1).collect()
        if len(found) > MOST_BANDS:
            return self.read(table)
        return self._frame(table).filter(F.col(BAND).isin([r[0] for r in found])).select(*self.schemas[table].names)

    def _band(self, table: str) -> Column:
        column, width = self.bands[table]
        return F.floor(F.col(column) / width).cast("long")

    # writing

    def _check(self, table: str, df: DataFrame) -> DataFrame:
        schema = self.schemas[table]
        found = {f.name: f.dataType for f in df.schema.fields}
        wanted = {f.name: f.dataType for f in schema.fields}
        if found != wanted:
            raise ValueError(f"{table}: columns {found} do not fit {wanted}")
        return df.select(*wanted)

    def _load(self, table: str, df: DataFrame, load_id: str, part: str) -> dict:
        """Write one load and take its row count and highest key from the files."""
        name = f"_load={load_id}-{part}-{uuid.uuid4().hex[:8]}"
        path, key = f"{self._folder(table)}/{name}", self.schemas[table].fields[0]
        if table in self.bands:
            # the rows stay in the tasks that numbered them: a file per task and band, and no shuffle
            banded = df.withColumn(BAND, self._band(table)).sortWithinPartitions(BAND, self.bands[table][0])
            banded.write.option("compression", CODEC).partitionBy(BAND).parquet(path)
        else:
            df.write.option("compression", CODEC).parquet(path)
        whole = isinstance(key.dataType, T.IntegralType)
        written = self.spark.read.schema(self._stored(table)).option("basePath", self._folder(table)).parquet(path)
        rows, highest = written.agg(F.count("*"), F.max(key.name) if whole else F.lit(None)).first()
        return {"path": name, "load": load_id, "part": part, "rows": rows, "highest": highest}

    def commit(self, table: str, parts: Mapping[str, DataFrame], load_id: str, kept: tuple[str, ...] = ()) -> None:
        """Make a version of the given parts and, as they are, all loads of the parts ``kept``."""
        state = self._state(table)
        frames = {part: self._check(table, df) for part, df in parts.items()}
        loads = [self._load(table, df, load_id, part) for part, df in frames.items()]
        fresh = {"version": state["version"] + 1, "load": load_id, "loads": [x for x in state["loads"] if x["part"] in kept] + loads}
        path = f"{self._folder(table)}/_commits/{fresh['version']:08d}"
        if not files.create_new(self.spark, path, json.dumps(fresh) + "\n"):
            for load in loads:
                files.delete(self.spark, f"{self._folder(table)}/{load['path']}")
            raise Conflict(f"{table}: version {fresh['version']} was published by another run")
        self._seen[table] = fresh

    def publish(self, table: str, df: DataFrame, load_id: str) -> None:
        """Replace the content."""
        self.commit(table, {"main": df}, load_id)

    def append(self, table: str, df: DataFrame, load_id: str) -> None:
        """Add rows."""
        if any(x["load"] == load_id for x in self._state(table)["loads"]):
            raise ValueError(f"{table}: load {load_id} is already finished")
        self.commit(table, {"main": df}, load_id, kept=("main",))

    def vacuum(self, table: str, keep: int = 2) -> None:
        """Remove commits older than the newest ``keep``, and loads that only they name."""
        versions = self._versions(table)
        commits = {v: self._read_commit(table, v) for v in versions}
        done = [v for v in versions if commits[v]]
        named = lambda vs: {x["path"] for v in vs for x in commits[v]["loads"]}
        for path in named(done[:-keep]) - named(done[-keep:]):
            files.delete(self.spark, f"{self._folder(table)}/{path}")
        for version in done[:-keep]:
            files.delete(self.spark, f"{self._folder(table)}/_commits/{version:08d}")
