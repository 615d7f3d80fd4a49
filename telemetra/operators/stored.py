"""Stored tables that take updates, deletes and upserts: plain files, versions and a pointer.

Rows lie in folders named by a function of their key. A change writes the folders it touches anew,
under the number of the new version, and then one small log entry that says which version holds
each folder. Readers follow the newest entry, so they see the old table or the new one and nothing
between; a job that dies before its entry leaves files that the next attempt overwrites.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from telemetra.operators.changes import delete_where
from telemetra.operators.latest import latest_per_key
from telemetra.operators.ordering import global_row_number
from telemetra.session import materialize
from telemetra.sources.files import list_files

PLACE = "stored_place"
LOG = """
    operation string, committed_at timestamp, token string, keys array<string>, place string,
    row_schema string, marks map<string,bigint>, parts array<struct<place:string,held:int>>"""


def hashed(keys: Sequence[str], folders: int) -> str:
    """Place of a row by a hash of its key."""
    return f"lpad(CAST(pmod(xxhash64({', '.join(keys)}), {folders}) AS STRING), 5, '0')"


def daily(column: str) -> str:
    """Place of a row by the day of a timestamp."""
    return f"coalesce(date_format({column}, 'yyyy-MM-dd'), 'none')"


class StoredTable:
    """A table below ``path``. One writer at a time; any number of readers.

    Keys are unique and not null; a row with a null key is never matched by a change.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # --- log --------------------------------------------------------------------------

    def log(self) -> DataFrame:
        """Every version with its operation, number of folders and those written by it."""
        return self._entries().select(
            "version", "operation", "committed_at", F.size("parts").alias("folders"),
            F.size(F.filter("parts", lambda p: p["held"] == F.col("version"))).alias("folders_written"))

    def _entries(self) -> DataFrame:
        schema = T._parse_datatype_string(LOG).add("version", T.IntegerType())
        return self.spark.read.schema(schema).parquet(f"{self.path}/log")

    def _newest(self) -> Row | None:
        try:
            return self._entries().orderBy(F.desc("version")).first()
        except AnalysisException:
            return None  # no folder yet

    def exists(self) -> bool:
        return self._newest() is not None

    def entry(self, version: int | None = None) -> Row:
        """Log entry of a version, by default the newest."""
        found = self._newest() if version is None else self._entries().where(
            F.col("version") == version).first()
        if found is None:
            raise ValueError(f"{self.path} has no version {version or ''}")
        return found

    def marks(self) -> dict[str, int]:
        """How far each source had been taken in by the newest version."""
        newest = self._newest()
        return dict(newest["marks"] or {}) if newest else {}

    # --- reading ----------------------------------------------------------------------

    def read(
        self, version: int | None = None, places: Iterable[str] | None = None, entry: Row | None = None
    ) -> DataFrame:
        """Rows of a version (or of its log entry), of the given folders only if any are given."""
        entry = entry or self.entry(version)
        schema = T.StructType.fromJson(json.loads(entry["row_schema"]))
        wanted = None if places is None else set(places)
        paths = [
            f"{self.path}/data/held={p['held']}/{PLACE}={p['place']}"
            for p in entry["parts"] if wanted is None or p["place"] in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def places_of(self, rows: DataFrame, entry: Row | None = None) -> set[str]:
        """Folders that rows with the key's columns belong to; at most one name per folder."""
        place = F.expr((entry or self.entry())["place"])
        return {r[0] for r in rows.select(place.alias("p")).distinct().collect()}

    def changed_places(self, old: int, new: int) -> set[str]:
        """Folders that differ between two versions, from the log alone."""
        before, after = ({(p["place"], p["held"]) for p in self.entry(v)["parts"]} for v in (old, new))
        return {place for place, _ in before ^ after}

    # --- writing ----------------------------------------------------------------------

    def create(self, rows: DataFrame, keys: Sequence[str], place: str, marks: Mapping[str, int] | None = None) -> int:
        """The first version. ``place`` is SQL over the key's columns; see :func:`hashed`."""
        if self.exists():
            raise ValueError(f"{self.path} exists")
        held = self._write(rows, place, 1)
        return self._commit(1, "create", keys, place, rows.schema, held, marks or {})

    def replace(self, rows: DataFrame, operation: str = "replace", marks: Mapping[str, int] | None = None) -> int:
        """A new version of all rows; the old one stays readable."""
        entry = self.entry()
        version = entry["version"] + 1
        held = self._write(rows, entry["place"], version)
        return self._commit(
            version, operation, entry["keys"], entry["place"], rows.schema, held,
            {**(entry["marks"] or {}), **(marks or {})})

    def update(self, updates: DataFrame, columns: Sequence[str], newest_by: str) -> int:
        """Set ``columns`` of rows whose key is in ``updates``; other updates are ignored.

        Of several updates of a key the newest counts. Only folders that hold an updated key
        are written.
        """
        entry = self.entry()
        keys = entry["keys"]
        newest = latest_per_key(updates, keys, newest_by, [c for c in columns if c != newest_by])
        near = self.read(places=self.places_of(newest, entry), entry=entry)
        matched = near.join(newest.select(*keys), keys, "left_semi")
        touched = self.places_of(matched, entry)
        rows = self.read(places=touched, entry=entry)
        return self._rewrite(entry, "update", touched, _updated(rows, newest, keys, columns))

    def delete(self, condition: Column) -> int:
        """Remove rows for which the condition is true; other folders stay as they are."""
        entry = self.entry()
        touched = self.places_of(self.read(entry=entry).where(condition), entry)
        rows = self.read(places=touched, entry=entry)
        return self._rewrite(entry, "delete", touched, delete_where(rows, condition))

    def append(self, rows: DataFrame, marks: Mapping[str, int] | None = None) -> int:
        """Add rows as new files; nothing that is stored is read or written."""
        entry = self.entry()
        version = entry["version"] + 1
        held = self._write(rows, entry["place"], version)
        kept = [(p["place"], p["held"]) for p in entry["parts"]]
        schema = T.StructType.fromJson(json.loads(entry["row_schema"]))
        return self._commit(
            version, "append", entry["keys"], entry["place"], schema, kept + held,
            {**(entry["marks"] or {}), **(marks or {})})

    def append_numbered(self, rows: DataFrame, order: Sequence[Column], name: str) -> int:
        """Append rows with dense numbers that go on where the last load ended.

        The highest number is kept in the log entry that makes the rows visible, so a load that
        died gives its numbers back and none is used twice.
        """
        start = self.marks().get(name, 0)
        numbered = materialize(
            global_row_number(rows, order, name).withColumn(name, F.col(name) + start), "numbered")
        return self.append(numbered, {name: start + numbered.count()})

    def upsert(self, rows: DataFrame, marks: Mapping[str, int] | None = None) -> int:
        """Rows replace those of the same key and are added where the key is new."""
        return self.replace_keys(rows.select(*self.entry()["keys"]).distinct(), rows, "upsert", marks)

    def replace_keys(
        self, keys: DataFrame, rows: DataFrame, operation: str = "replace_keys",
        marks: Mapping[str, int] | None = None,
    ) -> int:
        """All rows of the given keys become ``rows``, whose keys must be among them."""
        entry = self.entry()
        touched = self.places_of(keys, entry)
        stay = self.read(places=touched, entry=entry).join(keys.select(*entry["keys"]), entry["keys"], "left_anti")
        names = stay.columns
        return self._rewrite(
            entry, operation, touched, stay.unionByName(rows.select(*names)), marks)

    def _rewrite(self, entry, operation, touched: set[str], rows: DataFrame, marks=None) -> int:
        version = entry["version"] + 1
        schema = T.StructType.fromJson(json.loads(entry["row_schema"]))
        held = self._write(rows, entry["place"], version) if touched else []
        kept = [(p["place"], p["held"]) for p in entry["parts"] if p["place"] not in touched]
        return self._commit(
            version, operation, entry["keys"], entry["place"], schema, kept + held,
            {**(entry["marks"] or {}), **(marks or {})})

    def _write(self, rows: DataFrame, place: str, version: int) -> list[tuple[str, int]]:
        """Store rows by folder and return the folders that got any.

        Rebalancing lets Spark join small folders and split large ones over several files.
        """
        target = f"{self.path}/data/held={version}"
        placed = rows.withColumn(PLACE, F.expr(place))
        placed.hint("rebalance", PLACE).write.mode("overwrite").partitionBy(PLACE).parquet(target)
        names = list_files(self.spark, target, "*.parquet").select(
            F.regexp_extract("path", f"/{PLACE}=([^/]+)/", 1).alias("p")).distinct().collect()
        return sorted((r["p"], version) for r in names if r["p"])

    def _commit(self, version, operation, keys, place, schema, parts, marks) -> int:
        token = uuid.uuid4().hex
        row = (operation, dt.datetime.now(dt.timezone.utc), token, list(keys), place,
               json.dumps(schema.jsonValue()), dict(marks), sorted(parts))
        newest = self._newest()
        if newest and newest["version"] >= version:
            raise RuntimeError(f"another writer has committed version {version} of {self.path}")
        self.spark.createDataFrame([row], LOG).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/log/version={version}")
        if self.entry(version)["token"] != token:
            raise RuntimeError(f"another writer has committed version {version} of {self.path}")
        return version


def _updated(rows: DataFrame, newest: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    change = newest.select(*keys, F.struct(*columns).alias("_change"))
    hit = F.col("_change").isNotNull()
    renewed = {c: F.when(hit, F.col(f"_change.{c}")).otherwise(F.col(c)) for c in columns}
    return rows.join(change, list(keys), "left").withColumns(renewed).select(*rows.columns)
