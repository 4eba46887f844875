"""A table kept as Parquet folders, written whole and never changed.

    <root>/<table>/snapshots/<version>[-<buckets>-<id>]     all rows and delete markers
    <root>/<table>/horizons/<id>                            records that an overwrite took the place of
    <root>/<table>/changes/after=<snapshot>/batch=<version>-<tag>
        _rejected=false/                                    the last change per key
        _rejected=true/                                     records that cannot be applied

A folder counts once Spark's committer has put ``_SUCCESS`` in it, so every
write is one atomic step and a broken one is simply written again. A batch
writes only its own outcome; the table is the newest snapshot merged with the
changes that follow it, and ``compact`` turns that into the next snapshot. Since
the feed position decides which change wins, changes may arrive in any order and
more than once. One writer at a time changes a table; readers need no lock.
"""

from __future__ import annotations

from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import named
from tidemark.functions.conditions import Conditions, predicate
from tidemark.operators.decode import MOVED_KEY, SUPERSEDED
from tidemark.operators.fold import batch_outcome, last_per_key, moved_changes, null_key
from tidemark.operators.merge import merge, merge_unique, updated
from tidemark.table import DELETED, GONE, POS, REJECTED, TableSpec

RECORD_TYPE = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("action", "raw_key", "raw_value")]
)
PLACE = ["topic", "partition", "offset"]


def version_of(folder: str) -> int:
    """The version in a folder's name."""
    return int(folder.rsplit("/", 1)[-1].removeprefix("batch=").split("-", 1)[0])


def buckets_of(folder: str) -> int | None:
    """The number of buckets in a snapshot folder's name, if it has any."""
    parts = folder.rsplit("/", 1)[-1].split("-")
    return int(parts[1]) or None if len(parts) > 1 else None


class TableStore:
    """One stored table; see above.

    With ``buckets``, snapshots are stored in that many buckets of the key, and
    merging changes into them shuffles the changes only. That suits large
    tables; their keys are taken as unique. Spark makes use of it where there
    are no fewer buckets than shuffle partitions.
    """

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec, buckets: int | None = None):
        self.spark = spark
        self.spec = spec
        self.path = f"{root.rstrip('/')}/{spec.name}"
        self.buckets = buckets
        self._sizes: dict[str, int] = {}

    # -- folders ---------------------------------------------------------

    def _folder(self, path: str):
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm_path

    def _names(self, kind: str) -> list[str]:
        """Folder names, finished or not, oldest first."""
        files, path = self._folder(f"{self.path}/{kind}")
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path)]
        return sorted(n for n in names if not n.startswith(("_", ".")))

    def _finished(self, kind: str, name: str) -> bool:
        files, path = self._folder(f"{self.path}/{kind}/{name}/_SUCCESS")
        return files.exists(path)

    def _bytes(self, paths: list[str]) -> int:
        """Size of finished folders, which do not change."""
        for path in paths:
            if path not in self._sizes:
                files, jvm_path = self._folder(path)
                self._sizes[path] = files.getContentSummary(jvm_path).getLength()
        return sum(self._sizes[path] for path in paths)

    def _snapshot(self, paths: list[str]) -> DataFrame:
        schema = self.spec.state_schema
        if not paths:
            return self.spark.createDataFrame([], schema)
        (path,) = paths
        buckets = buckets_of(path)
        if not buckets:
            return self.spark.read.schema(schema).parquet(path)
        # buckets are known to Spark only through a table in the catalog, which
        # is needed no longer than it takes to resolve the read
        name, keys = f"tidemark_{uuid4().hex}", self._quoted_keys()
        location = path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet"
            f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS"
            f" LOCATION '{location}'"
        )
        try:
            return self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def _write_snapshot(self, state: DataFrame, version: int, horizon: DataFrame | None) -> None:
        folder, attempt = f"{self.path}/snapshots/{version:010d}", uuid4().hex[:8]
        if horizon is not None:
            horizon.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/horizons/{attempt}")
        if not self.buckets:
            named_apart = "" if horizon is None else f"-0-{attempt}"
            state.write.mode("overwrite").parquet(folder + named_apart)
            return
        # a table is only created in a folder that is not there yet
        name, keys = f"tidemark_{uuid4().hex}", list(self.spec.keys)
        bucketed = state.write.format("parquet").bucketBy(self.buckets, keys).sortBy(keys)
        bucketed.option("path", f"{folder}-{self.buckets}-{attempt}").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")

    def _horizon(self, base: list[str]) -> DataFrame | None:
        """What the snapshot stands in place of, None if nothing: all records up to
        a point in the declared order (one row), else up to an offset of each partition."""
        for path in base:
            parts = path.rsplit("/", 1)[-1].split("-")
            if len(parts) > 2 and self._finished("horizons", parts[2]):
                return self.spark.read.parquet(f"{self.path}/horizons/{parts[2]}")
        return None

    def _quoted_keys(self) -> str:
        return ", ".join("`" + k.replace("`", "``") + "`" for k in self.spec.keys)

    def _outcomes(self, paths: list[str], schema: T.StructType, rejected: bool) -> DataFrame:
        """The applied or the rejected part of batches."""
        if not paths:
            return self.spark.createDataFrame([], schema)
        parted = T.StructType([*schema.fields, T.StructField(REJECTED, T.BooleanType())])
        read = self.spark.read.schema(parted).option("basePath", f"{self.path}/changes")
        return read.parquet(*paths).where(F.col(REJECTED) == rejected).select(*schema.names)

    def _changes(self, paths: list[str], horizon: DataFrame | None, old: bool = False) -> DataFrame:
        """The applied part of batches, from the horizon on, or what is before it."""
        changes = self._outcomes(paths, self.spec.state_schema, rejected=False)
        last = horizon.first()["time"] if horizon is not None and self.spec.order_column else None
        if horizon is None or (self.spec.order_column and last is None):
            return changes.limit(0) if old else changes
        if self.spec.order_column:
            return changes.where((F.col(f"{POS}.time") <= F.lit(last)) == old)
        past = horizon.select(*[F.col(c).alias(f"_past_{c}") for c in PLACE])
        here = [F.col(f"{POS}.{c}") == F.col(f"_past_{c}") for c in PLACE[:2]]
        passed = here[0] & here[1] & (F.col(f"{POS}.offset") <= F.col("_past_offset"))
        return changes.join(past, passed, "left_semi" if old else "left_anti")

    def _layers(self, version: int | None = None) -> tuple[int, list[str], list[str]]:
        """The version read, its snapshot (if any) and the changes on top. Only
        the folder of changes after that snapshot is looked into."""
        snapshots = (
            n
            for n in reversed(self._names("snapshots"))
            if (version is None or version_of(n) <= version) and self._finished("snapshots", n)
        )
        base = next(snapshots, None)
        kind = f"changes/after={base}"
        pending = [
            n
            for n in self._names(kind)
            if (version is None or version_of(n) <= version) and self._finished(kind, n)
        ]
        return (
            max([version_of(base) if base else 0, *map(version_of, pending)]),
            [f"{self.path}/snapshots/{base}"] if base else [],
            [f"{self.path}/{kind}/{n}" for n in pending],
        )

    # -- reading ---------------------------------------------------------

    @property
    def version(self) -> int:
        return self._layers()[0]

    def read(self, version: int | None = None) -> DataFrame:
        """The table at a version, by default the newest."""
        _, base, pending = self._layers(version)
        rows = self._live(base, pending) if pending else self._snapshot(base).where(~F.col(DELETED))
        return rows.select(*[named(c) for c in self.spec.columns])

    def _unique(self, base: list[str]) -> bool:
        return self.spec.unique or bool(self.buckets) or any(buckets_of(path) for path in base)

    def _live(self, base: list[str], pending: list[str]) -> DataFrame:
        if self._unique(base):
            return self._state(base, pending).where(~F.col(DELETED))
        return self._merged(base, pending)[0]

    def _state(self, base: list[str], pending: list[str]) -> DataFrame:
        """Rows and delete markers with their positions: what a snapshot holds."""
        spec = self.spec
        state = self._snapshot(base)
        if not pending:
            return state
        if not self._unique(base):
            rows, markers = self._merged(base, pending)
            live = rows.withColumns({DELETED: F.lit(False), GONE: F.lit(None).cast(spec.position)})
            return live.unionByName(markers)
        changes = self._changes(pending, self._horizon(base))
        loose = null_key(spec) & F.col(POS).isNotNull()
        keyed = state.where(~loose) if spec.null_keys else state
        merged = merge_unique(keyed, last_per_key(changes, spec), spec)
        return merged.unionByName(self._loose(state, changes)) if spec.null_keys else merged

    def _loose(self, state: DataFrame, changes: DataFrame) -> DataFrame:
        """Rows of the feed with a null in the key, each once by its position;
        one that has been deleted here stays so."""
        rows = state.unionByName(changes).where(null_key(self.spec) & F.col(POS).isNotNull())
        rest = [c for c in rows.columns if c not in (*self.spec.keys, POS)]
        gone_first = F.struct(DELETED)
        once = rows.groupBy(*[named(k) for k in self.spec.keys], POS).agg(
            F.max_by(F.struct(*[named(c) for c in rest]), gone_first).alias("_last")
        )
        return once.select(*[named(c, "_last" if c in rest else None).alias(c) for c in rows.columns])

    def _merged(self, base: list[str], pending: list[str]) -> tuple[DataFrame, DataFrame]:
        """Rows with their positions, and delete markers, where keys may repeat."""
        spec = self.spec
        changes = self._changes(pending, self._horizon(base))
        state = self._snapshot(base)
        # the snapshot's delete markers meet the changes, not the rows
        net = last_per_key(changes.unionByName(state.where(F.col(DELETED))), spec)
        live, markers = state.where(~F.col(DELETED)), net.where(F.col(DELETED))
        if not spec.null_keys:
            return merge(live, net, spec), markers
        # and so do its rows with null keys that came from the feed
        from_feed = null_key(spec) & F.col(POS).isNotNull()
        rows = merge(live.where(~from_feed), net, spec)
        loose = self._loose(state, changes)
        added = loose.where(~F.col(DELETED)).select(*rows.columns)
        return rows.unionByName(added), markers.unionByName(loose.where(F.col(DELETED)))

    def rejects(self, times: bool = False) -> DataFrame:
        """All records that could not be applied, with the reason, each once; and
        their ``time`` in the declared order, if asked for.

        Without a source order these are also the last changes of a key in
        partitions that it does not belong to (``moved_key``). Changes
        that an overwrite or a low-water mark has taken the place of are ``superseded``.
        """
        schema = T.StructType([T.StructField(POS, self.spec.position), T.StructField("_record", RECORD_TYPE)])
        batches = {
            after: [f"{self.path}/changes/{after}/{n}" for n in self._names(f"changes/{after}") if self._finished(f"changes/{after}", n)]
            for after in self._names("changes")
        }
        paths = [path for each in batches.values() for path in each]
        records = self._outcomes(paths, schema, rejected=True)
        place = [F.col(f"{POS}.{c}") for c in (*PLACE, *(["time"] if times else []))]

        def listed(changes: DataFrame, reason: str) -> DataFrame:
            return changes.select(
                *place,
                F.lit(reason).alias("action"),
                F.to_json(F.struct(*[named(k) for k in self.spec.keys])).alias("raw_key"),
                F.lit(None).cast("string").alias("raw_value"),
            )

        found = records.select(*place, "_record.*")
        for after, each in batches.items():  # what each snapshot's horizon sets aside
            if each and (horizon := self._horizon([after.removeprefix("after=")])) is not None:
                found = found.unionByName(listed(self._changes(each, horizon, old=True), SUPERSEDED))
        if not self.spec.order_column:
            changes = self._outcomes(paths, self.spec.state_schema, rejected=False)
            found = found.unionByName(listed(moved_changes(changes, self.spec), MOVED_KEY))
        return found.dropDuplicates(PLACE)

    # -- writing ---------------------------------------------------------

    def overwrite(self, rows: DataFrame) -> int:
        """Replace the table's contents; returns the new version.

        Records of the feed that the table has seen stay behind: applied once
        more they change nothing, whether their rows are still there or not.
        """
        version, base, pending = self._layers()
        no_pos = F.lit(None).cast(self.spec.position)
        state = rows.select(
            *[named(f.name).cast(f.dataType).alias(f.name) for f in self.spec.schema.fields]
        ).withColumns({POS: no_pos, DELETED: F.lit(False), GONE: no_pos})
        if self.buckets:
            state = state.repartition(self.buckets, *[named(k) for k in self.spec.keys])
        self._write_snapshot(state, version + 1, self._seen(base, pending) if base or pending else None)
        return version + 1

    def _seen(self, base: list[str], pending: list[str]) -> DataFrame:
        """The last record that the table knows of, in the declared order or of each partition of the feed."""
        schema = T.StructType([T.StructField(POS, self.spec.position)])
        last = F.max("time").alias("time") if self.spec.order_column else F.max("offset").alias("offset")
        by = [] if self.spec.order_column else PLACE[:2]
        known = [self._outcomes(pending, schema, r) for r in (False, True)]
        known.append(self._snapshot(base).select(POS))
        seen = known[0].unionByName(known[1]).unionByName(known[2]).select(f"{POS}.*").where("topic IS NOT NULL").groupBy(*by).agg(last)
        before = self._horizon(base)
        if before is not None:
            seen = seen.unionByName(before).groupBy(*by).agg(last)
        return seen

    def update_where(self, conditions: Conditions, updates: Mapping[str, object]) -> int:
        """Set columns on the rows that meet the conditions; returns the new
        version. The rows keep their feed positions: later records still change
        them, earlier ones do not. Keys stay as they are."""
        if changed_keys := {c.lower() for c in updates} & {k.lower() for k in self.spec.keys}:
            raise ValueError(f"key columns cannot be set: {sorted(changed_keys)}")
        version, base, pending = self._layers()
        state = self._state(base, pending)
        where = ~F.col(DELETED) & predicate(state, conditions)
        changed = updated(state, conditions, updates, where)
        self._write_snapshot(changed, version + 1, self._horizon(base))
        return version + 1

    def delete_where(self, conditions: Conditions) -> int:
        """Delete the rows that meet the conditions; returns the new version.
        Those that came from the feed leave a marker at their position, so that
        only later records bring them back."""
        version, base, pending = self._layers()
        state = self._state(base, pending)
        hit = F.coalesce(~F.col(DELETED) & predicate(state, conditions), F.lit(False))
        marked = state.where(~hit | F.col(POS).isNotNull()).withColumn("_hit", hit)
        flags = {DELETED: F.col("_hit") | F.col(DELETED), GONE: F.when(F.col("_hit"), F.col(POS)).otherwise(F.col(GONE))}
        emptied = {c: F.when(~F.col("_hit"), named(c)) for c in self.spec.columns if c not in self.spec.keys}
        left = marked.select(
            *[(emptied | flags).get(c, named(c)).alias(c) for c in state.columns]
        )
        self._write_snapshot(left, version + 1, self._horizon(base))
        return version + 1

    def has(self, tag: str) -> bool:
        """Whether a batch is among the changes since the last snapshot. One
        from before may be committed again, which changes nothing."""
        return any(path.rsplit("/", 1)[-1].split("-", 1)[1] == tag for path in self._layers()[2])

    def commit(self, decoded: DataFrame, tag: str) -> bool:
        """Add the outcome of a batch of decoded records under a tag; False if
        it is there already."""
        version, base, pending = self._layers()
        if any(path.rsplit("/", 1)[-1].split("-", 1)[1] == tag for path in pending):
            return False
        after = base[0].rsplit("/", 1)[-1] if base else None
        folder = f"{self.path}/changes/after={after}/batch={version + 1:010d}-{tag}"
        outcome = batch_outcome(decoded, self.spec)
        outcome.write.mode("overwrite").partitionBy(REJECTED).parquet(folder)
        return True

    def compact(self, forget: Column | None = None, low_water: bool = False) -> int:
        """Write the newest version as a snapshot. Delete markers stay until
        ``forget``, a condition on ``_pos``, says the feed cannot send anything
        older than them again.

        ``low_water`` makes what has been committed a bound of its own: the last
        record of each partition, or in the declared order. Markers below it go, and
        changes that come in below it afterwards are not applied but listed by
        ``rejects`` as superseded. That is for feeds whose batches come in order.
        """
        version, base, pending = self._layers()
        if not pending:
            return version
        state = self._state(base, pending)
        if low_water:  # no record is above it yet
            forget = F.lit(True)
        if forget is not None:
            state = state.where(~(F.col(DELETED) & F.coalesce(forget, F.lit(False))))
        self._write_snapshot(state, version, self._seen(base, pending) if low_water else self._horizon(base))
        return version

    def compact_if_due(self, ratio: float, forget: Column | None = None) -> bool:
        """Compact once the changes are larger than ``ratio`` x the snapshot,
        so that what is rewritten stays in proportion to what came in."""
        _, base, pending = self._layers()
        due = bool(pending) and self._bytes(pending) > ratio * self._bytes(base)
        if due:
            self.compact(forget)
        return due

    def obsolete(self) -> list[str]:
        """Folders that reading the newest version no longer needs. Removing
        them gives up older versions, and the rejects of their batches; that is
        left to the operator."""
        _, base, _ = self._layers()
        if not base:
            return []
        current = base[0].rsplit("/", 1)[-1]
        older = [f"snapshots/{n}" for n in self._names("snapshots") if version_of(n) <= version_of(current)]
        older += [f"changes/{n}" for n in self._names("changes") if n != f"after={current}"]
        return [f"{self.path}/{n}" for n in older if n != f"snapshots/{current}"]
