"""Write aside, check, then switch what readers see.

A published name is a view over a managed table that is never changed by a rebuild: each rebuild
writes a new table and then repoints the view in one catalog operation. A failed build leaves the
view, and with it the old rows, as they were. The version before the current one is kept until the
next rebuild, so queries that started on it can finish.

In partitioned versions each write stores its rows of each partition under a slot of their own, the first partition level. Replacing
some partitions adds slots, and lists which slots are live in a small table; repointing the view at that list is the one
step that changes what readers see. A failure before it leaves slots no view shows. Readers prune by their list at run time, so
they never open other slots: those that only the version before the current one shows are kept for it, and dropped by the next write.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.names import as_list, col, quoted
from tableloom.operators.incremental import anti_by_keys
from tableloom.operators.schema import apply_contract

Check = Callable[[DataFrame], None]

#: Storage models whose rows are a plain bag: each may take over from the others.
BAGS = frozenset({"rebuild", "append", "insert_overwrite", "custom"})
#: Models an incremental run may rebuild when asked to. Histories and stored aggregates are not among them.
REBUILDABLE = BAGS | {"merge", "merge_log", "microbatch"}


class StorageModelError(ValueError):
    """A run would change a name that is stored in another way, or that this library does not store."""


def _literal(text: object) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


#: Files of a random distribution that are dealt by writing their shares aside; more files have small shares and are dealt by a shuffle.
DEALT_ASIDE = 64


def dealt(df: DataFrame, files: int, share: str) -> DataFrame:
    """Rows with the ``share`` each belongs to, of ``files`` equal ones: every task deals its rows in turn, whatever their values, each from another share on."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + F.spark_partition_id()
    return df.withColumn(share, F.pmod(place, F.lit(files)).cast("int"))


def gathered(shares: DataFrame, files: int, share: str) -> DataFrame:
    """The rows stored by share, one task for each: it reads that share's files, compressed by column as they are, and nothing is shuffled.

    To be planned under ``tasks_kept``.
    """
    parts = [shares.where(col(share) == i).drop(share).coalesce(1) for i in range(files)]
    return reduce(DataFrame.unionAll, parts)


@contextmanager
def tasks_kept(spark: SparkSession) -> Iterator[None]:
    """Unions planned in the block run all their parts' tasks; Spark 4.1 would else join parts of one task each into a single task."""
    key = "spark.sql.unionOutputPartitioning"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def rebalanced(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows gathered by the columns their files are split by.

    Without this every task writes a file into every partition it has a row for. Adaptive execution
    splits a partition that holds a large share of the rows over several tasks and joins small ones.
    """
    return df.hint("rebalance", *([partitions] if partitions else []), *[col(c) for c in columns])


#: The column of a row's share in a random distribution, while it is dealt.
SHARE = "write_share"

#: The hidden first partition level: a write's number and a digest of the partition's values.
SLOT = "write_slot"

#: Partitions dropped by one statement.
DROPPED_AT_ONCE = 500


def _slot(write: str, partition: Sequence[str]) -> Column:
    # files know no difference between an empty text and null
    values = F.to_json(F.array(*[F.nullif(col(p).cast("string"), F.lit("")) for p in partition]))
    return F.concat(F.lit(f"{write}-"), F.substring(F.sha2(values, 256), 1, 32))


def _spec(values: Mapping[str, str | None]) -> str:
    return "PARTITION (" + ", ".join(f"{quoted(k)} = {'NULL' if v is None else _literal(v)}" for k, v in values.items()) + ")"


class Publisher:
    """Publishes into one database. Runs on the same name must not overlap."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database
        self._staged: set[str] = set()

    def name(self, table: str) -> str:
        return f"{quoted(self.database)}.{quoted(table)}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def properties(self, table: str) -> dict[str, str]:
        """The stored properties of a published name; empty if there is none."""
        if not self.exists(table):
            return {}
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()}

    def property(self, table: str, key: str) -> str | None:
        return self.properties(table).get(key)

    def current_version(self, table: str) -> str | None:
        return self.property(table, "version_table")

    def require_model(self, table: str, model: str, rebuild: bool = False) -> None:
        """Refuse a run on a name stored in another way, before anything is written.

        A new name fits every model. With ``rebuild`` the stored rows are to be replaced as a whole, which only models that
        can be computed again allow. A view that was not published by a run may be taken over by a rebuild alone.
        """
        if not self.exists(table):
            return
        known = self.properties(table)
        stored = known.get("table_model")
        if stored is None and self.spark.catalog.getTable(self.name(table)).tableType != "VIEW":
            raise StorageModelError(f"{table} is a plain table; drop or rename it first")
        if rebuild and (stored is None or stored in REBUILDABLE):
            return
        if stored is None or (stored != model and not {stored, model} <= BAGS):
            raise StorageModelError(f"{table} is stored as {stored or 'a view of its own'}, not as {model}; rebuild it")

    # -- rebuilds ---------------------------------------------------------------------------

    def write_version(
        self,
        table: str,
        df: DataFrame,
        partition_by: Sequence[str] | str | None = None,
        bucket_by: tuple[int, Sequence[str] | str] | None = None,
        gather: bool = True,
        slots: bool = False,
    ) -> str:
        """Write a new version that nobody reads yet and return its table name.

        Rows are gathered by their partition or bucket first, unless ``gather`` is off. Buckets of no column are a random
        distribution: so many files of equal size. A version with ``slots`` is one whose
        partitions can be replaced one by one.
        """
        version = f"{table.lower()}__v_{uuid.uuid4().hex[:12]}"
        if bucket_by and not as_list(bucket_by[1]):
            if partition_by:
                raise ValueError("a random distribution has no partitions")
            files, share = bucket_by[0], SHARE
            if files > DEALT_ASIDE:
                return self._save(version, df.repartition(files))
            while share in (c.lower() for c in df.columns):
                share += "_"
            with self.stage(table, dealt(df, files, share), share) as shares, tasks_kept(self.spark):
                return self._save(version, gathered(shares, files, share))
        elif not gather:
            pass
        elif partition_by:
            df = rebalanced(df, as_list(partition_by))
        elif bucket_by:
            df = rebalanced(df, as_list(bucket_by[1]), bucket_by[0])
        levels = as_list(partition_by)
        if slots:
            if SLOT in (c.lower() for c in df.columns):
                raise ValueError(f"the column name {SLOT} is taken by partitioned tables")
            df, levels = df.withColumn(SLOT, _slot("0", levels)), [SLOT, *levels]
        return self._save(version, df, levels, bucket_by)

    def _save(self, version: str, df: DataFrame, levels: Sequence[str] = (), bucket_by: tuple[int, Sequence[str] | str] | None = None) -> str:
        writer = df.write.format("parquet").mode("errorifexists")
        if levels:
            writer = writer.partitionBy(*levels)
        if bucket_by:
            buckets, columns = bucket_by
            columns = as_list(columns)
            writer = writer.bucketBy(buckets, *columns).sortBy(*columns)
        writer.saveAsTable(self.name(version))
        return version

    def switch(
        self,
        table: str,
        version: str,
        properties: Mapping[str, object] | None = None,
        hidden: Sequence[str] = (),
        select: str | None = None,
        live: str | None = None,
    ) -> None:
        """Point the published name at a version, then drop versions older than the one just left.

        ``hidden`` columns serve the layout only and are not part of the published view. ``select``
        is the view's query where it is more than the columns of the version. ``live`` is the table of the slots to
        show, if they are not those the version was written with.
        """
        old = self.properties(table)
        before = old.get("version_table")
        if before == version:
            before = old.get("previous_table")
        if select is None:
            columns = self.spark.table(self.name(version)).columns
            shown = ", ".join(f"v.{quoted(c)}" for c in columns if c not in (*hidden, SLOT))
            select = f"SELECT {shown} FROM {self.name(version)} v"
            if live:
                select += f" LEFT SEMI JOIN {self.name(live)} l ON v.{SLOT} = l.{SLOT} AND l.live = 1"
            elif SLOT in columns:
                select += f" WHERE v.{SLOT} LIKE '0-%'"
        stored = {"version_table": version, "previous_table": before or "", **(properties or {}), "live_table": live or "", "previous_live": old.get("live_table") or ""}
        if old.get("descriptions"):
            stored = {"descriptions": old["descriptions"], **stored}
        self._define(table, select, stored)
        self.drop_stale(table)

    def _define(self, table: str, select: str, properties: Mapping[str, object]) -> None:
        """Point a view at a query, with its properties and the descriptions among them, in one catalog operation."""
        said = json.loads(str(properties.get("descriptions") or "{}"))
        listed = [(c, said.get("columns", {}).get(c.lower())) for c in self.spark.sql(select).columns]
        columns = ", ".join(quoted(c) + (f" COMMENT {_literal(text)}" if text else "") for c, text in listed)
        comment = f" COMMENT {_literal(said['table'])}" if said.get("table") else ""
        props = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in properties.items())
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(table)} ({columns}){comment} TBLPROPERTIES ({props}) AS {select}")

    def describe(self, table: str, text: str | None = None, columns: Mapping[str, str] | None = None) -> None:
        """Describe a published name and columns of it. Descriptions stay through rebuilds, of columns as long as they are there.

        An empty text takes a description away; what is not mentioned stays as it is.
        """
        self._current(table)
        have = {c.lower() for c in self.read(table).columns}
        unknown = [c for c in columns or {} if c.lower() not in have]
        if unknown:
            raise ValueError(f"{table} has no columns {unknown}")
        known = {k: v for k, v in self.properties(table).items() if not k.startswith("view.")}
        said = json.loads(known.get("descriptions") or "{}")
        said = {"table": said.get("table", "") if text is None else text, "columns": said.get("columns", {}) | {c.lower(): t for c, t in (columns or {}).items()}}
        lines = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").collect()
        (select,) = [r["data_type"] for r in lines if r["col_name"] == "View Text"]
        self._define(table, select, {**known, "descriptions": json.dumps(said)})

    def drop_stale(self, table: str) -> None:
        """Drop stages, and versions that are neither current nor the one before: leftovers of earlier runs."""
        now = self.properties(table)
        keep = {*(now.get(k) for k in ("version_table", "previous_table", "live_table", "previous_live")), *self._staged}
        listed = self.spark.sql(f"SHOW TABLES IN {quoted(self.database)} LIKE '{table}__*'").collect()
        for name in (row["tableName"] for row in listed):
            if name.startswith(tuple(f"{table.lower()}__{kind}_" for kind in ("v", "stage", "live"))) and name not in keep:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name(name)}")

    @contextmanager
    def stage(self, table: str, df: DataFrame, partition_by: str | None = None) -> Iterator[DataFrame]:
        """The rows written once to a helper table, which is dropped when the block ends.

        All uses inside the block read the same rows, the source is read once, and a lost executor
        costs a re-read of files.
        """
        name = f"{table.lower()}__stage_{uuid.uuid4().hex[:12]}"
        self._staged.add(name)
        try:
            writer = df.write.format("parquet")
            (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(self.name(name))
            yield df.sparkSession.table(self.name(name))
        finally:
            self._staged.discard(name)
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(name)}")

    def replace(
        self,
        table: str,
        df: DataFrame,
        partition_by: Sequence[str] | str | None = None,
        bucket_by: tuple[int, Sequence[str] | str] | None = None,
        contract: T.StructType | None = None,
        check: Check | None = None,
        properties: Mapping[str, object] | None = None,
        hidden: Sequence[str] = (),
    ) -> DataFrame:
        """Build, check and publish. Any failure before the switch leaves the old rows published."""
        properties = {"table_model": "rebuild", **(properties or {})}
        self.require_model(table, str(properties["table_model"]), rebuild=properties["table_model"] in REBUILDABLE)
        version = self.write_version(table, apply_contract(df, contract), partition_by, bucket_by, slots=bool(partition_by))
        try:
            if check is not None:
                check(self.spark.table(self.name(version)).drop(SLOT))
            self.switch(table, version, properties, hidden)
        except Exception:
            if self.current_version(table) != version:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name(version)}")
            raise
        return self.read(table)

    # -- changes to the current version -----------------------------------------------------

    def _current(self, table: str) -> str:
        version = self.current_version(table)
        if version is None:
            raise ValueError(f"{table} has not been published")
        return version

    def stored(self, table: str) -> DataFrame:
        """The published rows of the current version with its layout columns."""
        version, live = self._current(table), self.property(table, "live_table")
        rows = self.spark.table(self.name(version))
        if SLOT not in rows.columns:
            return rows
        if live:
            rows = rows.join(self.spark.table(self.name(live)).where("live = 1").select(SLOT), SLOT, "left_semi")
        else:
            rows = rows.where(col(SLOT).startswith("0-"))
        return rows.drop(SLOT)

    def partitions(self, version: str) -> list[str]:
        """The partition columns of a stored table, without the slot."""
        described = [r["col_name"] for r in self.spark.sql(f"DESCRIBE TABLE {self.name(version)}").collect()]
        if "# Partition Information" not in described:
            return []
        return [n for n in described[described.index("# Partition Information") + 1 :] if not n.startswith("#") and n != SLOT]

    def entries(self, table: str) -> DataFrame:
        """The published partitions of a table that is stored by partition: a row of their values for each. No data column is read."""
        version, live = self._current(table), self.property(table, "live_table")
        partitions = [col(p) for p in self.partitions(version)]
        if live:
            return self.spark.table(self.name(live)).select(*partitions).distinct()
        return self.spark.table(self.name(version)).where(col(SLOT).startswith("0-")).select(*partitions).distinct()

    def insert(self, version: str, rows: DataFrame, gather_by: Sequence[str] = ()) -> None:
        """Add rows to a stored table, columns matched by name. A failing insert commits no file."""
        rows = rows.select(*[col(c) for c in self.spark.table(self.name(version)).columns])
        buckets, columns = self.buckets(version)
        if buckets and gather_by:
            rows = rebalanced(rows, [*gather_by, *columns])
        elif buckets:
            # the hash and the number the table places rows by: a task has whole buckets
            rows = rows.repartition(buckets, *[col(c) for c in columns])
        elif gather_by:
            rows = rebalanced(rows, gather_by)
        rows.write.insertInto(self.name(version))

    def buckets(self, version: str) -> tuple[int, list[str]]:
        """How many buckets a stored table has, and by which columns; 0 if it has none."""
        known = {r["col_name"]: r["data_type"] for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(version)}").collect()}
        if "Num Buckets" not in known:
            return 0, []
        return int(known["Num Buckets"]), [c.strip().strip("`") for c in known["Bucket Columns"].strip("[]").split(",")]

    def append(self, table: str, batch: DataFrame) -> DataFrame:
        """Insert by name. A failing insert changes nothing; into a partitioned table, neither does one that is cut short."""
        version = self._current(table)
        if SLOT in self.spark.table(self.name(version)).columns:
            return self._write_slots(table, version, batch, None, keep=True)
        self.insert(version, batch, self.partitions(version))
        return self.read(table)

    def overwrite_partitions(
        self, table: str, batch: DataFrame, named: DataFrame | None = None, before_publish: Callable[[], None] | None = None,
        properties: Mapping[str, object] | None = None,
    ) -> DataFrame:
        """Replace the stored partitions the batch has rows for, and those ``named``, which are emptied if it has none.

        The version must be partitioned; ``named`` has its partition columns. All partitions change in one step, the
        ``properties`` with them, and a failure before it changes nothing. Which partitions are touched stays a table: the driver sees none of them until, a write later,
        they are dropped from the catalog. Running this again gives the same.
        """
        version = self._current(table)
        if SLOT not in self.spark.table(self.name(version)).columns:
            raise ValueError(f"{table} is not stored by partition")
        return self._write_slots(table, version, batch, named, keep=False, before_publish=before_publish, properties=properties)

    def _write_slots(self, table, version, batch, named, keep: bool, before_publish=None, properties=None) -> DataFrame:
        known, partitions = self.properties(table), self.partitions(version)
        stored = self.spark.table(self.name(version))
        write = self._begin_write(version, known, partitions)
        self.insert(version, batch.withColumn(SLOT, _slot(write, partitions)), partitions)

        entries = [col(SLOT), *[col(p) for p in partitions]]
        new = stored.where(col(SLOT).startswith(f"{write}-")).select(*entries).distinct()  # no data column is read for this
        live = self.spark.table(self.name(known["live_table"])).drop("live") if known.get("live_table") \
            else stored.where(col(SLOT).startswith("0-")).select(*entries).distinct()
        with self.stage(table, new) as new:
            if not keep:
                touched = new.select(*entries[1:])
                if named is not None:
                    # the table's types decide which values are the same
                    touched = touched.unionByName(named.select(*[col(p).cast(stored.schema[p].dataType).alias(p) for p in partitions])).distinct()
                live = anti_by_keys(live, touched, partitions)
            listed = f"{table.lower()}__live_{uuid.uuid4().hex[:12]}"
            live.unionByName(new).withColumn("live", F.lit(1)).write.format("parquet").saveAsTable(self.name(listed))
        if before_publish is not None:
            before_publish()
        own = {k: v for k, v in known.items() if not k.startswith(("view.", "previous_", "version_", "live_"))}
        shown = {c.lower() for c in self.read(table).columns}
        self.switch(table, version, {**own, **(properties or {})}, hidden=[c for c in stored.columns if c.lower() not in shown], live=listed)
        return self.read(table)

    def _begin_write(self, version: str, known: Mapping[str, str], partitions: Sequence[str]) -> str:
        """A number for this write, after the slots nobody needs any more are dropped.

        Those are the slots that the version before the current one showed and the current one does not, and what a write
        left that was never published.
        """
        marks = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name(version)}").collect()}
        last = int(marks.get("last_write", "0"))
        specs = []
        if known.get("live_table"):
            current = self.spark.table(self.name(known["live_table"]))
            if known.get("previous_live"):
                before = self.spark.table(self.name(known["previous_live"])).drop("live")
            else:
                before = self.spark.table(self.name(version)).where(col(SLOT).startswith("0-")).select(*[col(c) for c in (SLOT, *partitions)]).distinct()
            gone = before.join(current.select(SLOT), SLOT, "left_anti").select(col(SLOT), *[col(p).cast("string").alias(p) for p in partitions])
            specs += [_spec(r.asDict()) for r in gone.collect()]  # entries of the catalog, of the partitions one write replaced
        if last:
            shown = col(SLOT).startswith(f"{last}-")
            lost = self.spark.table(self.name(version)).where(shown).select(*[col(c) for c in (SLOT, *partitions)]).distinct()
            if known.get("live_table"):
                lost = lost.join(self.spark.table(self.name(known["live_table"])).select(SLOT), SLOT, "left_anti")
            specs += [_spec(r.asDict()) for r in lost.select(col(SLOT), *[col(p).cast("string").alias(p) for p in partitions]).collect()]
        for i in range(0, len(specs), DROPPED_AT_ONCE):
            self.spark.sql(f"ALTER TABLE {self.name(version)} DROP IF EXISTS {', '.join(specs[i:i + DROPPED_AT_ONCE])}")
        # a number is taken before anything is written under it, so no two writes share one
        self.spark.sql(f"ALTER TABLE {self.name(version)} SET TBLPROPERTIES ('last_write' = '{last + 1}')")
        return str(last + 1)

    def drop_partition(self, table: str, **spec: object) -> None:
        """Empty one stored partition."""
        version = self._current(table)
        self.spark.sql(f"ALTER TABLE {self.name(version)} DROP IF EXISTS {_spec(spec)}")

    # -- views and copies -------------------------------------------------------------------

    def create_view(self, table: str, query: str, contract: T.StructType | None = None) -> DataFrame:
        """Create or replace a view from SQL text. The contract is checked first, so a bad model keeps the old view.

        A published name becomes a view of its own, and its versions are dropped once it reads the new query; histories and
        stored aggregates, which cannot be computed again, are refused.
        """
        self.require_model(table, "view", rebuild=True)
        df = apply_contract(self.spark.sql(query), contract)
        if contract is None:
            body = query
        else:
            casts = ", ".join(
                f"CAST({quoted(f.name)} AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in contract
            )
            body = f"SELECT {casts} FROM ({query})"
        published = self.current_version(table) is not None
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(table)} AS {body}")
        if published:
            self.drop_stale(table)
        return df

    def freeze_view(self, view: str, table: str) -> DataFrame:
        """Copy a view's present rows to a plain table, which must not exist yet."""
        if view.lower() == table.lower():
            raise ValueError("source view and destination table must differ")
        if self.spark.catalog.getTable(self.name(view)).tableType not in ("VIEW", "TEMPORARY"):
            raise ValueError(f"{view} is not a view")
        if self.exists(table):
            raise ValueError(f"destination {table} already exists")
        self.read(view).write.format("parquet").mode("errorifexists").saveAsTable(self.name(table))
        return self.read(table)

    def store_failures(self, table: str, failures: DataFrame, limit: int | None = None, order_by=None) -> DataFrame:
        """Publish the failing rows of a data test; a limit, if the test asks for one, comes with an order."""
        if limit is not None:
            order = as_list(order_by) or failures.columns
            failures = failures.orderBy(*[col(c) for c in order]).limit(limit)
        return self.replace(table, failures)

    def view_failures(self, table: str, failures: DataFrame) -> DataFrame:
        """The failing rows of a data test as a view over those stored under another name, for readers that expect a view."""
        rows = self.store_failures(f"{table}__rows", failures)
        shown = ", ".join(quoted(c) for c in rows.columns)
        self.create_view(table, f"SELECT {shown} FROM {self.name(f'{table}__rows')}")
        return self.read(table)
