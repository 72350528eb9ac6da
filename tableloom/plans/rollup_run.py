"""Stored aggregates as published tables: build now or later, refresh all or only what went stale."""

from __future__ import annotations

from collections.abc import Mapping
import hashlib
import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions.names import col
from tableloom.functions.timing import Calendar
from tableloom.operators.incremental import within_partitions
from tableloom.operators.rollup import (
    FILE,
    Model,
    changed_files,
    definition_digest,
    empty_like,
    file_partitions,
    fingerprints,
    in_files,
    stale_partitions,
)
from tableloom.plans.publish import Check, Publisher


@dataclass(frozen=True)
class RollupConfig:
    """``partition`` names stored columns and how the base computes them (columns or SQL text).

    Without it every refresh is complete. What the model does is told from its plan; ``definition`` is a text or version to add, for what no plan
    shows, such as the body of a Python function. With the result's columns and the partition expressions they make
    the definition that is stored. If a refresh comes with another one, ``apply`` rebuilds all, ``continue`` keeps the
    stored rows untouched, and ``fail`` stops the run.

    ``fingerprint`` is how stale partitions are found: by digests of the base's ``rows``, or from the ``files`` of a file-backed base, of
    which unchanged ones are not opened. Partitions given as `Calendar` let the recomputation skip by the files' statistics.
    """

    build: str = "immediate"
    refresh: str = "auto"
    partition: Mapping[str, Column | str] = field(default_factory=dict)
    fingerprint: str = "rows"
    definition: str = ""
    on_definition_change: str = "apply"

    def validate(self) -> None:
        if self.on_definition_change not in ("apply", "continue", "fail"):
            raise ValueError(f"on_definition_change {self.on_definition_change!r} is none of apply, continue, fail")
        if self.build not in ("immediate", "deferred"):
            raise ValueError(f"build {self.build!r} is neither immediate nor deferred")
        if self.refresh not in ("auto", "complete"):
            raise ValueError(f"refresh {self.refresh!r} is neither auto nor complete")
        if self.fingerprint not in ("rows", "files"):
            raise ValueError(f"fingerprint {self.fingerprint!r} is neither rows nor files")

    def defined(self, base: DataFrame, model: Model) -> str:
        """A digest of what the aggregate is; reads no rows."""
        columns = [f"{f.name} {f.dataType.simpleString()}" for f in model(base).schema]
        parts = [f"{n}={e if isinstance(e, str) else e._jc.toString() if isinstance(e, Column) else repr(e)}" for n, e in self.partition.items()]
        return hashlib.sha256(json.dumps([self.definition, columns, parts, definition_digest(model, base)]).encode()).hexdigest()

    def digest(self, base: DataFrame) -> DataFrame:
        return (fingerprints if self.fingerprint == "rows" else file_partitions)(base, self.partition)


class DefinitionChanged(ValueError):
    """A refresh came with another definition than the stored one's."""


def _stored(config: RollupConfig, base: DataFrame, model: Model) -> dict[str, str]:
    return {"table_model": "rollup", "definition": config.defined(base, model), "fingerprint": config.fingerprint}


def _prints(table: str) -> str:
    return f"{table}__fingerprints"


def build_rollup(
    publisher: Publisher, table: str, base: DataFrame, model: Model, config: RollupConfig, check: Check | None = None
) -> DataFrame:
    """Create the stored aggregate, or only its schema if the build is deferred."""
    config.validate()
    publisher.require_model(table, "rollup")
    rows = model(base)
    if config.build == "deferred":
        if config.partition:
            publisher.replace(_prints(table), empty_like(config.digest(base)))
        return publisher.replace(table, empty_like(rows), partition_by=list(config.partition), check=check, properties=_stored(config, base, model))
    return _complete(publisher, table, base, model, config, check)


def _complete(publisher, table, base, model, config, check=None) -> DataFrame:
    rows = model(base)
    if not config.partition:
        return publisher.replace(table, rows, check=check, properties=_stored(config, base, model))
    # Fingerprints are taken first: a base that changes meanwhile looks stale next time, never fresh.
    prints = publisher.write_version(_prints(table), config.digest(base))
    out = publisher.replace(table, rows, partition_by=list(config.partition), check=check, properties=_stored(config, base, model))
    publisher.switch(_prints(table), prints)
    return out


def refresh_rollup(
    publisher: Publisher, table: str, base: DataFrame, model: Model, config: RollupConfig, check: Check | None = None
) -> DataFrame:
    """Bring the stored aggregate up to date with its base, and with its definition if that changed."""
    config.validate()
    publisher.require_model(table, "rollup")
    if publisher.exists(table) and publisher.property(table, "definition") != config.defined(base, model):
        if config.on_definition_change == "continue":
            return publisher.read(table)
        if config.on_definition_change == "fail":
            raise DefinitionChanged(f"{table} is stored by another definition")
        return _complete(publisher, table, base, model, config, check)
    known = publisher.property(table, "fingerprint") == config.fingerprint and publisher.exists(_prints(table))
    if config.refresh == "complete" or not config.partition or not known:
        return _complete(publisher, table, base, model, config, check)
    if config.fingerprint == "files":
        return _refresh_by_files(publisher, table, base, model, config)
    prints = publisher.write_version(_prints(table), config.digest(base))
    after = publisher.spark.table(publisher.name(prints))
    stale = stale_partitions(publisher.read(_prints(table)), after, list(config.partition))
    rewrite_partitions(publisher, table, base, model, config.partition, stale)
    publisher.switch(_prints(table), prints)
    return publisher.read(table)


def _refresh_by_files(publisher: Publisher, table: str, base: DataFrame, model: Model, config: RollupConfig) -> DataFrame:
    """Find new, rewritten and vanished files by their metadata, and recompute what they have rows of from the files that have any."""
    before, names = publisher.read(_prints(table)), [col(n) for n in config.partition]
    new, gone = changed_files(before, base, config.partition)
    with publisher.stage(_prints(table), new) as new:
        stale = new.select(*names).unionByName(gone.select(*names)).distinct()
        kept = before.join(gone.select(*FILE).distinct(), list(FILE), "left_anti")
        pairs = publisher.write_version(_prints(table), kept.unionByName(new))
        with publisher.stage(table, stale) as stale:
            holders = within_partitions(publisher.spark.table(publisher.name(pairs)), stale, list(config.partition))
            rewrite_partitions(publisher, table, in_files(base, holders), model, config.partition, stale)
    publisher.switch(_prints(table), pairs)
    return publisher.read(table)


def _of_partitions(base: DataFrame, listed: DataFrame, partition: Mapping[str, Column | str | Calendar]) -> DataFrame:
    """The rows of the listed partitions. Ranges of calendar partitions are compared with the bare column too, so that scans skip by statistics."""
    near = base
    for name, part in partition.items():
        if isinstance(part, Calendar):
            least, greatest, nulls = listed.agg(F.min(col(name)), F.max(col(name)), F.count_if(col(name).isNull())).first()
            cond = F.lit(False) if least is None else part.within(least, greatest, base.schema[part.column].dataType)
            near = near.where(cond | col(part.column).isNull() if nulls else cond)
    return within_partitions(near, listed, partition)


def rewrite_partitions(
    publisher: Publisher, table: str, base: DataFrame, model: Model, partition: Mapping[str, Column | str], stale: DataFrame
) -> DataFrame:
    """Recompute the listed partitions from the base and store them in one step; those left without rows go.

    Running this again gives the same result, so a run that was cut short can simply be repeated.
    """
    with publisher.stage(table, stale.select(*[col(n) for n in partition]).distinct()) as listed:
        if listed.isEmpty():
            return publisher.read(table)
        return publisher.overwrite_partitions(table, model(_of_partitions(base, listed, partition)), listed)
