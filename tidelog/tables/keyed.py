"""Keyed, versioned tables on plain parquet.

Both kinds share one rule for which rows a reader sees. `merge on read` appends every change to
a log and applies the rule when reading; `copy on write` applies it when writing, to the key
buckets a change touches, and each commit holds the new version of those buckets.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.changes import fold_partial, latest_per_key
from tidelog.schemas import TableSpec
from tidelog.tables import commits

COMMIT = "commit_time"
FIRST = "000"
# Keys of commits no larger than this pass Spark's size check for a broadcast.
FEW_BYTES = 8 << 20


def resolve(
    rows: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    key_deletes: DataFrame | None = None,
) -> DataFrame:
    """Winning row per key, deletes included as op 'd'.

    A delete by key has no order value: it ends every version committed before it. Of the
    others the greatest in (order_by, commit) wins.
    """
    if key_deletes is not None:
        # One row per key and commit first: the join below then meets no hot key.
        rows = latest_per_key(rows, [*keys, COMMIT], order_by or [COMMIT])
        ends = key_deletes.groupBy(*keys).agg(F.max(COMMIT).alias("__end"))
        rows = (
            rows.join(ends, list(keys), "left")
            .where(F.col("__end").isNull() | (F.col(COMMIT) > F.col("__end")))
            .drop("__end")
        )
    return latest_per_key(rows, keys, [*order_by, COMMIT])


def resolve_columns(
    rows: DataFrame,
    patches: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    key_deletes: DataFrame | None = None,
) -> DataFrame:
    """The row of each key with patches, column by column, deletes included as op 'd'.

    Rows and deletes speak about every column, patches about those that are not null; of the
    versions that speak about a column the greatest in (order_by, commit) gives its value. `op`,
    order and commit are those of the greatest version. Arrival decides nothing but equal orders.
    """
    rank = F.struct(*order_by, COMMIT).alias("r")
    values = [c for c in rows.columns if c not in (*keys, *order_by, "op", COMMIT)]
    alive = F.coalesce(F.col("op") != "d", F.lit(True))

    def cells(df: DataFrame, whole: bool) -> DataFrame:
        """Each column as its value and the order it was said in; null where nothing was said."""
        def cell(c: str) -> Column:
            said = F.struct(rank, F.when(alive, F.col(c)).alias("v"))
            return (said if whole else F.when(~alive | F.col(c).isNotNull(), said)).alias(c)

        top = F.struct(rank, F.col("op").alias("v")).alias("op")
        return df.select(*keys, *(cell(c) for c in values), top, F.col(COMMIT).alias("__at"))

    def last(df: DataFrame, by: Sequence[str]) -> DataFrame:
        # Combined before the shuffle: a task ships one row per key however often it occurs.
        return df.groupBy(*by).agg(*(F.max_by(c, F.col(c)["r"]).alias(c) for c in (*values, "op")))

    both = cells(rows, True).unionByName(cells(patches, False))
    if key_deletes is not None:
        # One row per key and commit first: the join below then meets no hot key.
        ends = key_deletes.groupBy(*keys).agg(F.max(COMMIT).alias("__end"))
        both = last(both, [*keys, "__at"]).join(ends, list(keys), "left").where(
            F.col("__end").isNull() | (F.col("__at") > F.col("__end")))
    out = {c: F.col(c)["v"] for c in (*values, "op")}
    out |= {c: F.col("op")["r"][c] for c in (*order_by, COMMIT)}
    return last(both, keys).select(*(out[c].alias(c) if c in out else c for c in rows.columns))


class KeyedTable:
    """A table with a record key, an order between versions, and a timeline of commits.

    One writer at a time; commit ids must grow.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, spec: TableSpec):
        self.spark = spark
        self.path = path
        self.schema = schema
        self.spec = spec

    @staticmethod
    def create(
        spark: SparkSession, path: str, schema: T.StructType, spec: TableSpec
    ) -> "KeyedTable":
        for c in (*spec.keys, *spec.order_by, *spec.partition_by):
            if c not in schema.names:
                raise ValueError(f"column {c!r} is not in the table")
        if {"op", COMMIT} & set(schema.names):
            raise ValueError(f"'op' and '{COMMIT}' are added by the table itself")
        if any(c.startswith("__") for c in schema.names):
            raise ValueError("names that begin with '__' are the library's own")
        if len(set(schema.names)) != len(schema.names):
            raise ValueError("a column is declared twice")
        saved = {"schema": json.loads(schema.json()), "spec": spec.to_dict()}
        text = json.dumps(saved)
        if commits.exists(spark, f"{path}/spec/table.json"):
            if json.loads(spark.read.text(f"{path}/spec").first()["value"]) != json.loads(text):
                raise ValueError(f"{path} holds a table of another schema or spec")
            return KeyedTable._of(spark, path, schema, spec)
        commits.write_text(spark, f"{path}/spec/table.json", text)
        commits.make_dir(spark, f"{path}/log")
        return KeyedTable._of(spark, path, schema, spec)

    @staticmethod
    def open(spark: SparkSession, path: str) -> "KeyedTable":
        saved = json.loads(spark.read.text(f"{path}/spec").first()["value"])
        return KeyedTable._of(
            spark, path, T.StructType.fromJson(saved["schema"]), TableSpec.from_dict(saved["spec"])
        )

    @staticmethod
    def _of(spark, path, schema, spec) -> "KeyedTable":
        kind = MergeOnRead if spec.kind == "mor" else CopyOnWrite
        return kind(spark, path, schema, spec)

    # -- writing ---------------------------------------------------------------------------

    @property
    def log(self) -> str:
        return f"{self.path}/log"

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("op", T.StringType())])

    def _rows(self, df: DataFrame, op: str) -> DataFrame:
        """Input in the table's columns and types; `op` is taken from the input if it is there."""
        if "op" not in df.columns:
            df = df.withColumn("op", F.lit(op))
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self._stored()])

    def insert(self, df: DataFrame, commit: str | None = None, overwrite: bool = False) -> str:
        """Add rows; a row whose key exists replaces it. `overwrite` starts the table anew."""
        commit = self._allot(commit)
        if overwrite:
            self.truncate(commit)
        self._write(self._rows(df, "c"), commit)
        return commit

    def upsert(self, df: DataFrame, commit: str | None = None) -> str:
        """Apply rows, or change events if `df` has an `op` column. The commit of a micro-batch
        that is done is left as it is; any other id that was used is refused."""
        if isinstance(commit, commits.OfBatch) and commits.is_complete(self.spark, self.log, commit):
            return commit
        commit = self._allot(commit)
        self._write(self._rows(df, "u"), commit)
        return commit

    def patch(self, df: DataFrame, commit: str | None = None) -> str:
        """Apply changes in which a null or missing column keeps the value the row has.

        Here only the rows of the changed keys are read back; they take part as the oldest change
        of equal order, so a late change fills no more than what is null.
        """
        commit = self._allot(commit)
        spec = self.spec
        keys = list(spec.keys)
        absent = [f for f in self.schema if f.name not in df.columns]
        df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
        changes = self._rows(df, "u").withColumn("__new", F.lit(1))
        held = (
            self.as_of(self.last_commit())
            .join(changes.select(*keys).distinct(), keys, "left_semi")
            .select(*self.columns, F.lit("u").alias("op"), F.lit(0).alias("__new"))
        )
        values = [c for c in self.columns if c not in (*keys, *spec.order_by)]
        folded = fold_partial(
            held.unionByName(changes), keys, [*spec.order_by, "__new"], values
        )
        self._write(self._rows(folded, "u"), commit)
        return commit

    def update_where(
        self, cond: Column | str, values: Mapping[str, Column], commit: str | None = None
    ) -> str:
        """Set columns of the current rows that satisfy a condition.

        A new order value below the stored one loses like any older change.
        """
        return self.upsert(
            self.snapshot().where(cond).withColumns(dict(values)).drop(COMMIT), commit
        )

    def delete_where(self, cond: Column | str, commit: str | None = None) -> str:
        return self.delete_keys(self.snapshot().where(cond), commit)

    def truncate(self, commit: str | None = None) -> str:
        """Empty the table from this commit on. A mark, not a rewrite: history stays readable."""
        commit = self._allot(commit)
        empty = self.spark.createDataFrame([], "cut boolean")
        commits.write(empty, f"{self.path}/truncates", commit)
        return commit

    def _allot(self, commit: str | None) -> str:
        """The id of a new commit: later than all others. An id that was used would lose its rows,
        and an earlier one would be hidden or hide: both are refused. Only a micro-batch's commit
        may be the last one, which is that batch running again."""
        last = self.last_commit()
        if commit is None:
            return max(commits.clock_commit(), commits.following(last)) if last.isdigit() or not last \
                else commits.following(last)
        if commit < last or commit == last and not isinstance(commit, commits.OfBatch):
            raise ValueError(f"commit {commit!r} is not later than {last!r}")
        return commit

    def stream_commit(self, batch: DataFrame, batch_id: int) -> str:
        """The commit of a micro-batch. Its token, the query and the batch, is kept with the id: a
        batch that runs again gets the id it had, and batches of different queries never share one."""
        token = f"{self.path}/tokens/{commits.query_of(batch)}-{batch_id}"
        last = self.last_commit()
        if commits.exists(self.spark, token):
            commit = commits.OfBatch(self.spark.read.text(token).first()["value"])
            if commit > last or (commit, "log") in self.commit_ids():
                return commit
        commit = commits.OfBatch(commits.following(last))
        commits.write_text(self.spark, token, commit)
        return commit

    # -- timeline --------------------------------------------------------------------------

    def _timeline(self, kind: str) -> list[str]:
        return commits.complete(self.spark, f"{self.path}/{kind}")

    def _cut(self, upto: str | None) -> str:
        """Newest truncation a reader at `upto` is subject to. Rows written by the truncating
        commit itself survive it."""
        cuts = [c for c in self._timeline("truncates") if upto is None or c <= upto]
        return cuts[-1] if cuts else ""

    def _between(self, kind: str, after: str, upto: str | None) -> list[str]:
        cut = self._cut(upto)
        return [
            c for c in self._timeline(kind)
            if c > after and c >= cut and (upto is None or c <= upto)
        ]

    def commit_ids(self) -> list[tuple[str, str]]:
        kinds = ("log", "patches", "deletes", "truncates")
        return [(c, k) for k in kinds for c in self._timeline(k)]

    def commits(self) -> DataFrame:
        """Every commit, newest first; unlike the rows it also shows commits that only delete."""
        return commits.listing(self.spark, self.commit_ids())

    def last_commit(self) -> str:
        return max((c for c, _ in self.commit_ids()), default="")

    def publish(self) -> str:
        """The folder with one small file per complete commit, for streams that follow the table.
        Those not told yet are told now, in their order."""
        told = f"{self.path}/told"
        commits.make_dir(self.spark, told)
        known = set(commits.names(self.spark, told))
        for c in sorted({c for c, _ in self.commit_ids()} - known):
            commits.write_text(self.spark, f"{told}/{c}", c)
        return told

    # -- reading ---------------------------------------------------------------------------

    def snapshot(self) -> DataFrame:
        """Current rows, each with the commit that wrote it."""
        return self.as_of(None)

    def as_of(self, instant: str | None) -> DataFrame:
        """Rows as they were once all commits <= `instant` were done."""
        return self._visible(self._state(instant))

    def _visible(self, rows: DataFrame) -> DataFrame:
        return rows.where("op <> 'd'").select(*self.columns, COMMIT)

    def stream_changes(self, from_commit: str = FIRST) -> DataFrame:
        """Rows as they are committed, from a commit on, as a streaming frame; patches, which are
        parts of rows, are not among them (see `follow_changes`)."""
        schema = self._stored().add(COMMIT, "string")
        return (
            self.spark.readStream.schema(schema).parquet(self.log)
            .where(F.col(COMMIT) >= from_commit)
            .select(*schema.names)
        )


class MergeOnRead(KeyedTable):
    """log/commit_time=.../    changes, with `op`
    patches/commit_time=.../   changes of some columns, the others null, with `op`
    deletes/commit_time=.../   keys deleted without an order value
    base/upto=.../             the log folded up to a commit
    """

    def _write(self, rows: DataFrame, commit: str) -> None:
        if self.spec.partition_by:
            # A few even files per partition, also for one that dominates the commit.
            rows = rows.hint("rebalance", *self.spec.partition_by)
        commits.write(rows, self.log, commit, self.spec.partition_by)

    def patch(self, df: DataFrame, commit: str | None = None) -> str:
        """Apply changes in which a null or missing column says nothing about it. They are kept as
        they come and a read takes the last word on each column, so late changes, and rows that
        come later than a patch of a greater order, are right in any order of arrival."""
        commit = self._allot(commit)
        absent = {f.name: F.lit(None) for f in self.schema if f.name not in df.columns}
        commits.write(self._rows(df.withColumns(absent), "u"), f"{self.path}/patches", commit)
        return commit

    def _patches(self, ids: Sequence[str]) -> DataFrame | None:
        """Patches of some commits; None if they have none."""
        done = set(self._timeline("patches")).intersection(ids)
        if not done:
            return None
        return commits.read(self.spark, f"{self.path}/patches", sorted(done), self._stored())

    def _resolve(self, rows: DataFrame, patches: DataFrame | None, deletes: DataFrame | None) -> DataFrame:
        """Winning row per key; only keys with patches are folded column by column."""
        spec, keys = self.spec, list(self.spec.keys)
        if patches is None:
            return resolve(rows, keys, spec.order_by, deletes)
        patched = patches.select(*keys).distinct()
        whole = resolve(rows.join(patched, keys, "left_anti").select(*rows.columns), keys, spec.order_by, deletes)
        own = rows.join(patched, keys, "left_semi").select(*rows.columns)
        return whole.unionByName(resolve_columns(own, patches, keys, spec.order_by, deletes))

    def changed(self, ids: Sequence[str]) -> DataFrame:
        """The rows of some commits as they came, with `op` and the commit; of keys patched there the
        rows as of the last of the commits instead of the patches."""
        done = set(self._timeline("log"))
        rows = commits.read(self.spark, self.log, [c for c in ids if c in done], self._stored())
        patches = self._patches(ids)
        if patches is None:
            return rows
        touched = patches.select(*self.spec.keys).distinct()
        return rows.unionByName(self._state(max(ids), touched).select(*rows.columns))

    def load_history(self, df: DataFrame, commit: str) -> None:
        """Load many commits, named by a column, at once."""
        df = df.withColumn("__commit", F.col(commit))
        if "op" not in df.columns:
            df = df.withColumn("op", F.lit("c"))
        rows = df.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self._stored()], "__commit"
        )
        commits.write_history(rows, self.log, "__commit", self.spec.partition_by)

    def delete_keys(self, keys: DataFrame, commit: str | None = None) -> str:
        """Delete rows by key alone; a key the table does not have is no error."""
        commit = self._allot(commit)
        commits.write(keys.select(*self.spec.keys), f"{self.path}/deletes", commit)
        return commit

    def _key_schema(self) -> T.StructType:
        return T.StructType([self.schema[k] for k in self.spec.keys])

    def _changes(self, after: str, upto: str | None) -> tuple[DataFrame, DataFrame | None]:
        """Log rows and key deletes committed in (after, upto]."""
        rows = commits.read(
            self.spark, self.log, self._between("log", after, upto), self._stored()
        )
        ends = self._between("deletes", after, upto)
        if not ends:
            return rows, None
        deletes = commits.read(self.spark, f"{self.path}/deletes", ends, self._key_schema())
        return rows, deletes

    def _base(self, instant: str | None) -> tuple[str, DataFrame | None]:
        root = f"{self.path}/base"
        found = [
            b for b in commits.complete(self.spark, root, "upto")
            if b >= self._cut(instant) and (instant is None or b <= instant)
        ]
        if not found:
            return "", None
        schema = self._stored().add(COMMIT, "string")
        rows = commits.read(self.spark, root, found[-1:], schema, "upto").drop("upto")
        return found[-1], rows

    def _state(self, instant: str | None, only: DataFrame | None = None) -> DataFrame:
        """The row of each key as of a commit, hidden ones included; `only` of some keys."""
        spec = self.spec
        upto, base = self._base(instant)
        kinds = ("log", "patches", "deletes")
        if base is not None and only is not None:
            base = base.join(only, list(spec.keys), "left_semi")
        if base is not None and not any(self._between(k, upto, instant) for k in kinds):
            return base
        rows, deletes = self._changes(upto, instant)
        if only is not None:
            rows = rows.join(only, list(spec.keys), "left_semi").select(*rows.columns)
        patches = self._patches(self._between("patches", upto, instant))
        if patches is not None and only is not None:
            patches = patches.join(only, list(spec.keys), "left_semi").select(*rows.columns)
        if base is None:
            return self._resolve(rows, patches, deletes)
        # Only keys the log touches since the base are ranked again. Untouched base rows pass
        # as they are, unsorted, and unshuffled too where the touched keys are few.
        keys = list(spec.keys)
        touched = rows.select(*keys)
        for more in (patches, deletes):
            touched = touched if more is None else touched.unionByName(more.select(*keys))
        touched = touched.distinct()
        again = base.join(touched, keys, "left_semi").unionByName(rows)
        return base.join(touched, keys, "left_anti").select(*rows.columns).unionByName(
            self._resolve(again.select(*rows.columns), patches, deletes)
        )

    def images(self, after: str, upto: str) -> DataFrame:
        """What the commits (after, upto] changed: the keys, and the row before (`old`) and behind
        (`new`) as structs of the table's columns; null where there was or is none.

        Of small commits only rows of touched keys are ranked: their keys are broadcast and cut the
        log before any shuffle. Keys of large ones would have the log shuffled row by row, so there
        it is ranked first and a task ships one row per key. A truncation touches all rows there were.
        """
        keys = list(self.spec.keys)
        wrote = sum(
            commits.size(self.spark, f"{self.path}/{kind}", self._between(kind, after, upto))
            for kind in ("log", "patches", "deletes")
        )
        rows, deletes = self._changes(after, upto)
        patches = self._patches(self._between("patches", after, upto))
        touched = rows.select(*keys)
        for more in (patches, deletes):
            touched = touched if more is None else touched.unionByName(more.select(*keys))
        before = self._state(after) if after else None
        if before is not None and self._cut(upto) > after:
            touched = touched.unionByName(before.select(*keys))
        touched = touched.distinct()
        only = touched if wrote <= FEW_BYTES and not self._cut(upto) > after else None

        def image(state, name):
            row = F.struct(*(F.col(c).alias(c) for c in self.columns)).alias(name)
            return state.where("op <> 'd'").join(touched, keys, "left_semi").select(*keys, row)

        new = image(self._state(upto, only), "new")
        if before is None:
            kind = new.schema["new"].dataType
            return new.select(*keys, F.lit(None).cast(kind).alias("old"), "new")
        old = image(self._state(after, only), "old")
        return old.join(new, keys, "full").select(*keys, "old", "new").where("not (old <=> new)")

    def bulk_insert(self, df: DataFrame, commit: str | None = None) -> str:
        """Append rows as they come, each a version of its own in `versions`."""
        return self.insert(df, commit)

    def versions(self, after: str = "", upto: str | None = None) -> DataFrame:
        """Every row and patch written in the commits (after, upto], not folded."""
        rows = commits.read(
            self.spark, self.log, self._between("log", after, upto), self._stored()
        )
        patches = self._patches(self._between("patches", after, upto))
        return rows if patches is None else rows.unionByName(patches)

    def incremental(
        self, begin: str = FIRST, end: str | None = None, with_deletes: bool = False
    ) -> DataFrame:
        """Latest version, within the commits (begin, end], of each key changed there.

        With `with_deletes` the changes keep their `op`, and deleted keys appear as 'd' rows. Keys
        patched there come with their row as of the end.
        """
        rows, deletes = self._changes(begin, end)
        patches = self._patches(self._between("patches", begin, end))
        if patches is None:
            latest = resolve(rows, self.spec.keys, self.spec.order_by, deletes)
        else:
            patched = patches.select(*self.spec.keys).distinct()
            others = rows.join(patched, list(self.spec.keys), "left_anti").select(*rows.columns)
            latest = resolve(others, self.spec.keys, self.spec.order_by, deletes).unionByName(
                self._state(end, patched).select(*rows.columns))
        if not with_deletes:
            return self._visible(latest)
        if deletes is None:
            return latest
        keys = list(self.spec.keys)
        gone = deletes.groupBy(*keys).agg(F.max(COMMIT).alias(COMMIT))
        gone = gone.join(latest, keys, "left_anti").withColumn("op", F.lit("d"))
        return latest.unionByName(gone, allowMissingColumns=True)

    def compact(self) -> str:
        """Fold the log so far into a base. Ordered deletes stay in it, hidden from readers:
        without them an older event that comes late would bring the key back. Deletes by key
        need not stay, since every later commit outlives them anyway. The log is kept. A table with
        patches is not folded: a row would not tell the order of its columns any more."""
        upto = self.last_commit()
        if not upto or self._between("patches", "", None):
            return upto
        state = self._state(upto)
        if self.spec.partition_by:
            state = state.hint("rebalance", *self.spec.partition_by)
        commits.write(
            state, f"{self.path}/base", upto, self.spec.partition_by, "upto"
        )
        return upto


class CopyOnWrite(KeyedTable):
    """log/commit_time=.../bucket=.../    the buckets a commit changed, whole, with `op`

    A reader takes the newest version of every bucket. A key lives in the bucket its hash
    names, so keys being unique no bucket grows beyond its share. Deleted keys stay in
    their bucket as hidden rows.
    """

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.spec.keys), F.lit(self.spec.buckets)).cast("int")

    def _buckets(self, upto: str | None, before: str | None = None) -> dict[str, str]:
        """Newest commit of every bucket: at most one entry per bucket."""
        done = {c for c in self._between("log", "", upto) if before is None or c < before}
        found = commits.children(self.spark, self.log, "bucket")
        return {b: c for c, b in found if c in done}

    def _read(self, versions: Mapping[str, str]) -> DataFrame:
        schema = (
            self._stored().add("written", "string").add(COMMIT, "string").add("bucket", "integer")
        )
        if not versions:
            out = self.spark.createDataFrame([], schema)
        else:
            out = (
                self.spark.read.schema(schema).option("basePath", self.log)
                .parquet(*[f"{self.log}/commit_time={c}/bucket={b}" for b, c in versions.items()])
            )
        return out.select(*self._stored().names, F.col("written").alias(COMMIT), "bucket")

    def _rewrite(
        self, touching: DataFrame, merge: Callable[[DataFrame, int], DataFrame], commit: str
    ) -> None:
        """New versions of the buckets the keys of `touching` fall in."""
        if commits.is_complete(self.spark, self.log, commit):
            return
        # At most one value per bucket comes back.
        touched = {r[0] for r in touching.select("bucket").distinct().collect()}
        versions = self._buckets(commit, before=commit)
        old = self._read({b: c for b, c in versions.items() if int(b) in touched})
        commits.write(
            merge(old, max(len(touched), 1)).withColumnRenamed(COMMIT, "written"),
            self.log, commit, ["bucket", *self.spec.partition_by],
        )

    def _write(self, rows: DataFrame, commit: str) -> None:
        spec = self.spec
        incoming = (
            latest_per_key(rows, spec.keys, spec.order_by or spec.keys)
            .withColumn(COMMIT, F.lit(commit))
            .withColumn("bucket", self._bucket())
        )

        def merge(old: DataFrame, tasks: int) -> DataFrame:
            # Rows meet in their bucket by one shuffle: ranking by (bucket, key) needs no
            # other, and each bucket comes out of one task.
            both = old.unionByName(incoming).repartition(tasks, "bucket")
            return latest_per_key(both, ["bucket", *spec.keys], [*spec.order_by, COMMIT])

        # Used twice: for the buckets it touches and for the merge.
        incoming.persist()
        try:
            self._rewrite(incoming, merge, commit)
        finally:
            incoming.unpersist()

    def delete_keys(self, keys: DataFrame, commit: str | None = None) -> str:
        """Delete rows by key alone; a key the table does not have is no error."""
        commit = self._allot(commit)
        on = [*self.spec.keys, "bucket"]
        gone = keys.select(*self.spec.keys).distinct().withColumn("bucket", self._bucket())
        # The hidden row has no order value, so whatever comes later replaces it.
        emptied = [
            F.col(f.name) if f.name in self.spec.keys
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in self.schema
        ]

        def merge(old: DataFrame, tasks: int) -> DataFrame:
            dead = old.join(gone, on, "left_semi").select(
                *emptied, F.lit("d").alias("op"), F.lit(commit).alias(COMMIT), "bucket"
            )
            kept = old.join(gone, on, "left_anti").select(*dead.columns)
            return kept.unionByName(dead).repartition(tasks, "bucket")

        self._rewrite(gone, merge, commit)
        return commit

    def _state(self, instant: str | None) -> DataFrame:
        return self._read(self._buckets(instant)).drop("bucket")

    def stream_changes(self, from_commit: str = FIRST) -> DataFrame:
        """Refused: a commit holds whole buckets, rows that did not change among them."""
        raise ValueError("a copy-on-write table has no stream of changes")

    def changed(self, ids: Sequence[str]) -> DataFrame:
        """Refused like `stream_changes`."""
        return self.stream_changes()

    def incremental(self, begin: str = FIRST, end: str | None = None) -> DataFrame:
        return self.as_of(end).where(F.col(COMMIT) > begin)
