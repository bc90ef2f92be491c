"""A table kept by key whose upsert rewrites only the parts that a batch changes.

Rows are dealt by a hash of their key into a fixed number of buckets. A version of the table is a
manifest that names, for each bucket, the folder with its files. An upsert reads the buckets its
keys fall in, writes those with a changed row anew in a folder of its own, and then a manifest that
points to the new folder for them and to the old ones for all others. So a batch costs what it
touches, a batch that changes nothing writes nothing, readers of older versions are not disturbed,
and a job that dies before its manifest is there leaves the table as it was. Two writers of one
version cannot both succeed: the later one fails when it writes the manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitescout.joins import cut_lineage, delete_path, size_checked
from sitescout.sources.tables import latest_per_key

_BUCKET, _BATCH, _NEW = "key_bucket", "batch", "__new_"
_MANIFEST = "bucket int, batch string, columns string, note string, version int"


@dataclass(frozen=True)
class Version:
    """What one manifest says: the folder of each bucket that has rows, the columns, a remark."""

    number: int
    batches: dict[int, str]
    schema: T.StructType
    note: str


@dataclass(frozen=True)
class KeyedTable:
    """The table below ``directory``. Columns must be comparable (no maps); keys may not be NULL."""

    spark: SparkSession
    directory: str
    keys: tuple[str, ...]
    buckets: int = 64

    @classmethod
    def create(
        cls, rows: DataFrame, directory: str, keys: Sequence[str], buckets: int = 64,
        order_by: str | None = None, note: str = "",
    ) -> KeyedTable:
        """Version 1, of the latest row of each key."""
        table = cls(rows.sparkSession, directory, tuple(keys), buckets)
        first = table._placed(latest_per_key(rows, keys, order_by))
        table._commit(Version(0, {}, rows.schema, ""), first, None, note)
        return table

    # ---- reading

    def versions(self) -> DataFrame:
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.directory}/manifest")

    def version(self, number: int | None = None) -> Version:
        """The version of this number, or the latest. A manifest has a row per bucket at most, and one more."""
        listed = self.versions()
        wanted = F.lit(number) if number is not None else listed.agg(F.max("version")).first()[0]
        rows = listed.where(F.col("version") == wanted).collect()
        if not rows:
            raise ValueError(f"{self.directory} has no version {number or ''}")
        schema = T.StructType.fromJson(json.loads(rows[0]["columns"]))
        batches = {r["bucket"]: r["batch"] for r in rows if r["batch"] is not None}
        return Version(rows[0]["version"], batches, schema, rows[0]["note"])

    def read(self, number: int | None = None) -> DataFrame:
        at = self.version(number)
        return self._read(at, at.batches).select(at.schema.names)

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """The rows with these keys; only the buckets they fall in are read."""
        at = self.version()
        wanted = cut_lineage(self._placed(keys.select(*self.keys).distinct()))
        found = self._read(at, self._buckets_of(wanted))
        return found.join(size_checked(wanted.drop(_BUCKET)), list(self.keys), "left_semi").select(at.schema.names)

    def changes(self, since: int, until: int | None = None) -> DataFrame:
        """(keys, old, new) of the keys whose rows differ between two versions.

        ``old`` and ``new`` are structs of the other columns, NULL where there was or is no row. Only
        buckets that were written in between are read.
        """
        before, after = self.version(since), self.version(until)
        written = {b for b in before.batches.keys() | after.batches.keys() if before.batches.get(b) != after.batches.get(b)}
        others = [c for c in after.schema.names if c not in self.keys]

        def side(at: Version, name: str) -> DataFrame:
            rows = self._read(at, written)
            return rows.select(*self.keys, F.struct(F.lit(1).alias("_is"), *[c for c in others if c in rows.columns]).alias(name))

        both = side(before, "old").join(side(after, "new"), list(self.keys), "full")
        return both.where(~F.col("old").eqNullSafe(F.col("new")))

    def _read(self, at: Version, buckets) -> DataFrame:
        data = f"{self.directory}/data"
        paths = [f"{data}/{_BATCH}={at.batches[b]}/{_BUCKET}={b}" for b in sorted(buckets) if b in at.batches]
        schema = T.StructType([*at.schema.fields, T.StructField(_BATCH, T.StringType()), T.StructField(_BUCKET, T.IntegerType())])
        if not paths:
            return self.spark.createDataFrame([], schema).drop(_BATCH)
        return self.spark.read.schema(schema).option("basePath", data).parquet(*paths).drop(_BATCH)

    # ---- writing

    def upsert(self, source: DataFrame, order_by: str | None = None, note: str | None = None) -> int:
        """Writes the rows of ``source`` over the table by key; gives the version that now holds.

        Repeats of a key in the source collapse to one row, columns the source lacks keep their values
        (NULL for a new key). Without a changed row, and with no new ``note``, the version stays.
        """
        at, keys = self.version(), list(self.keys)
        latest = cut_lineage(self._placed(latest_per_key(source, keys, order_by)))
        names = [c for c in at.schema.names if c not in keys]
        given = [c for c in names if c in latest.columns]
        current = self._read(at, self._buckets_of(latest))
        arriving = latest.select(*keys, _BUCKET, *[F.col(c).cast(at.schema[c].dataType).alias(_NEW + c) for c in given])
        met = current.drop(_BUCKET).join(size_checked(arriving), keys)

        def differs(c: str):
            return ~F.col(c).eqNullSafe(F.col(_NEW + c))

        changed = F.lit(False)
        for c in given:
            changed = changed | differs(c)
        met = cut_lineage(met.withColumn("is_changed", changed))
        value = [F.col(_NEW + c).alias(c) if c in given else F.col(c) for c in names]
        replaced = met.where("is_changed").select(*keys, *value, _BUCKET)
        added = arriving.join(met.select(*keys), keys, "left_anti")
        fresh = [F.col(_NEW + c) if c in given else F.lit(None).cast(at.schema[c].dataType) for c in names]
        written = cut_lineage(replaced.unionByName(added.select(*keys, *[f.alias(c) for f, c in zip(fresh, names)], _BUCKET)))
        touched = self._buckets_of(written)
        if not touched and note in (None, at.note):
            return at.number
        kept = self._read(at, touched).join(size_checked(written.select(*keys)), keys, "left_anti")
        return self._commit(at, kept.unionByName(written), touched, at.note if note is None else note)

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(_BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _buckets_of(self, rows: DataFrame) -> set[int]:
        return {r[0] for r in rows.select(_BUCKET).distinct().collect()}

    def _commit(self, at: Version, rows: DataFrame, touched: set[int] | None, note: str) -> int:
        """Writes ``rows`` as the whole of the ``touched`` buckets (None: of all), then the manifest."""
        batch, batches = uuid.uuid4().hex, dict(at.batches)
        if touched is None or touched:
            n = self.buckets if touched is None else len(touched)
            names = [*at.schema.names, _BUCKET]
            folder = f"{self.directory}/data/{_BATCH}={batch}"
            rows.select(names).repartition(n, _BUCKET).write.partitionBy(_BUCKET).parquet(folder)
            if touched is None:
                there = self.spark.read.schema(f"{_BUCKET} int").option("basePath", folder).parquet(folder)
                touched = self._buckets_of(there)
            batches |= dict.fromkeys(touched, batch)
        columns = at.schema.json()
        listed = [(b, f, columns, note) for b, f in batches.items()] + [(None, None, columns, note)]
        manifest = self.spark.createDataFrame(listed, "bucket int, batch string, columns string, note string")
        manifest.coalesce(1).write.parquet(f"{self.directory}/manifest/version={at.number + 1}")
        return at.number + 1

    def release(self, keep: int = 1) -> None:
        """Deletes all but the last ``keep`` versions and the files that only they name."""
        numbers = sorted(r[0] for r in self.versions().select("version").distinct().collect())
        kept = {b for n in numbers[-keep:] for b in self.version(n).batches.values()}
        known = {b for n in numbers for b in self.version(n).batches.values()}
        for n in numbers[:-keep]:
            delete_path(self.spark, f"{self.directory}/manifest/version={n}")
        for batch in known - kept:
            delete_path(self.spark, f"{self.directory}/data/{_BATCH}={batch}")
