"""One history run whose cost follows the current versions, not the whole past.

All versions live in one table partitioned by the run that wrote them and by whether they are
closed. A run writes two partitions: the versions that are current after it, and those it closed.
The published view takes the closed partitions of all committed runs and the current partition of
the last one, so past versions are never copied, a failed run is invisible, and publishing is one
view replacement.

Versions lie in buckets of their key, so a run joins its source to the current ones without moving these. Each version of a key begins
after the one before it, or the checks of the run's own rows fail; ids can thus only repeat for keys that had left and return, and
only these are looked up in the past.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.functions.names import col, quoted, resolve
from tableloom.operators.history import (
    HistorySpec,
    advance_current,
    advance_touched,
    check_schema,
    compares_few_columns,
    history_violations,
    initial_history,
    raise_on_violations,
    source_violations,
    touched_keys,
)
from tableloom.plans.publish import Publisher, StorageModelError

RUN, CLOSED = "history_run", "history_closed"

#: Buckets of a history, unless its first run says otherwise: as many tasks join it.
BUCKETS = 16


def _versions_table(table: str) -> str:
    return f"{table}__versions"


def _visible(run: int) -> str:
    return f"(({CLOSED} AND {RUN} <= {run}) OR (NOT {CLOSED} AND {RUN} = {run}))"


def _publish(publisher: Publisher, table: str, columns: list[str], run: int) -> None:
    listed = ", ".join(quoted(c) for c in columns)
    publisher.spark.sql(
        f"CREATE OR REPLACE VIEW {publisher.name(table)} TBLPROPERTIES ('table_model' = 'history', 'history_run' = '{run}') AS "
        f"SELECT {listed} FROM {publisher.name(_versions_table(table))} WHERE {_visible(run)}"
    )


def _write_run(publisher: Publisher, table: str, rows: DataFrame, closed, run: int) -> None:
    versions = publisher.name(_versions_table(table))
    # what a failed attempt at this run left; some catalogs only drop partitions that are named in full
    publisher.spark.sql(f"ALTER TABLE {versions} DROP IF EXISTS PARTITION ({RUN} = {run}, {CLOSED} = true), PARTITION ({RUN} = {run}, {CLOSED} = false)")
    publisher.insert(_versions_table(table), rows.withColumn(RUN, F.lit(run)).withColumn(CLOSED, closed))


def run_history(
    publisher: Publisher,
    table: str,
    source: DataFrame,
    spec: HistorySpec,
    run_ts: datetime | str,
    validate: bool = True,
    before_publish: Callable[[], None] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Build the history on the first call, which chooses its buckets, advance it on later ones, and return it."""
    publisher.require_model(table, "history")
    with publisher.stage(table, source) as staged:
        history = _run_staged(publisher, table, staged, spec, run_ts, validate, before_publish, buckets)
    publisher.drop_stale(table)
    return history


def _run_staged(publisher, table, source, spec, run_ts, validate, before_publish, buckets) -> DataFrame:
    spark, versions = publisher.spark, publisher.name(_versions_table(table))
    taken = {c.lower() for c in source.columns} & {RUN.lower(), CLOSED.lower()}
    if taken:
        raise ValueError(f"the column names {sorted(taken)} are taken by the stored history")
    if not publisher.exists(table):
        if validate:
            raise_on_violations(source_violations(source, spec), "history source")
        if publisher.property(_versions_table(table), "published"):
            raise StorageModelError(f"{_versions_table(table)} holds a history whose view {table} is gone; restore the view, or drop the table to begin anew")
        first = initial_history(source, spec, run_ts)
        listed = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in first.schema)
        spark.sql(f"DROP TABLE IF EXISTS {versions}")
        spark.sql(f"CREATE TABLE {versions} ({listed}, {RUN} INT, {CLOSED} BOOLEAN) USING parquet "
                  f"PARTITIONED BY ({RUN}, {CLOSED}) CLUSTERED BY ({', '.join(quoted(k) for k in resolve(first, spec.keys))}) INTO {buckets} BUCKETS")
        _write_run(publisher, table, first, F.lit(False), 0)
        if validate:
            written = spark.table(versions).where(f"{RUN} = 0").drop(RUN, CLOSED)
            raise_on_violations(history_violations(written, spec), "history result")
        if before_publish is not None:
            before_publish()
        _publish(publisher, table, first.columns, 0)
        # from here on the past must not be taken for what a failed first run left
        spark.sql(f"ALTER TABLE {versions} SET TBLPROPERTIES ('published' = 'true')")
        return publisher.read(table)

    last = int(publisher.property(table, "history_run"))
    run = last + 1
    history = publisher.read(table)
    added = check_schema(history.schema, source.schema, spec)
    if spec.tracks_deletes and spec.names.is_deleted not in history.columns:
        raise ValueError(f"history {table} has no column {spec.names.is_deleted}; rebuild it to track deletes")
    if validate:
        raise_on_violations(source_violations(source, spec, history), "history source")
    # Only current versions take part, so only their partition is read.
    current = spark.table(versions).where(f"NOT {CLOSED} AND {RUN} = {last}").drop(RUN, CLOSED)
    if compares_few_columns(current, source, spec):
        with publisher.stage(table, touched_keys(current, source, spec, run_ts)) as touched:
            decided = advance_touched(current, source, touched, spec, run_ts)
            return _commit(publisher, table, decided, source, spec, added, run, validate, before_publish)
    decided = advance_current(current, source, spec, run_ts)
    return _commit(publisher, table, decided, source, spec, added, run, validate, before_publish)


def _repeated_ids(versions: DataFrame, spec: HistorySpec, run: int) -> DataFrame:
    """How many ids of keys that are new among the current versions were used in the past."""
    own = [*resolve(versions, spec.keys), spec.names.scd_id]
    part = lambda closed, runs: versions.where((F.col(CLOSED) == closed) & runs).select(*[col(c) for c in own])
    before = part(False, F.col(RUN) == run - 1).select(*[col(c) for c in own[:-1]])
    arrived = part(False, F.col(RUN) == run).join(before, own[:-1], "left_anti")
    return arrived.join(part(True, F.col(RUN) < run), own, "left_semi").agg(F.count(F.lit(1)).alias("reused_ids"))


def _commit(publisher, table, decided, source, spec, added, run, validate, before_publish) -> DataFrame:
    spark, versions, last = publisher.spark, publisher.name(_versions_table(table)), run - 1
    if added:
        listed = ", ".join(f"{quoted(c)} {source.schema[c].dataType.simpleString()}" for c in added)
        have = {c.lower() for c in spark.table(versions).columns}
        if any(c.lower() not in have for c in added):
            spark.sql(f"ALTER TABLE {versions} ADD COLUMNS ({listed})")
    tag, *columns = decided.columns
    _write_run(publisher, table, decided, col(tag).isin("update", "delete"), run)
    if validate:
        written = spark.table(versions).where(f"{RUN} = {run}").select(*[col(c) for c in columns])
        counts = history_violations(written, spec)
        if spec.hard_deletes == "invalidate":
            counts = counts.unionByName(_repeated_ids(spark.table(versions), spec, run), allowMissingColumns=True)
        raise_on_violations(counts.agg(*[F.sum(c).alias(c) for c in counts.columns]), "history result")
    if before_publish is not None:
        before_publish()
    _publish(publisher, table, columns, run)
    # Readers that started on the previous run still need its current versions; older ones can go.
    if last > 0:
        spark.sql(f"ALTER TABLE {versions} DROP IF EXISTS PARTITION ({RUN} = {last - 1}, {CLOSED} = false)")
    return publisher.read(table)
