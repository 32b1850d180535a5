"""Namespaced tables as parquet directories (C2, C3) and the load operators (L1, L2).

A write never touches what is there. ``root/<schema>/<table>/_g=<generation>/
_b=<batch>/_a=<attempt>`` is one finished write, marked by a ``_SUCCESS`` file.
A table is, of its newest generation with a finished write, the newest finished
attempt of every batch. ``mode="delete"`` starts a generation, any other mode
adds an attempt of its batch to the newest. So a failed write leaves the old rows,
a retried one replaces its own batch, and a frame may read the table that it is
written to. ``vacuum`` removes what no longer counts.

*Partitions.* With ``partition_by`` an attempt holds a directory per value, which
scans prune. ``mode="replace"`` writes an attempt that replaces, within its batch,
the partitions that it has rows for; the others' files stay as they are. The rows of
a partition are dealt to about equal files by adaptive execution, so a hot month is
many files and a small one is one.

*Declared rules.* With ``schema`` the frame is cast to the declared columns, and NOT
NULL and length violations are counted by the write itself. The attempt counts only
where there are none; otherwise ``ConstraintError`` names them and the old rows stay.
The frame is read once.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.conform import ConstraintError, conform, rule_counts
from starloom.schemas import TableSchema
from starloom.session import configure

#: Directory levels of a write; a partitioned table is read from the table's own path,
#: so they come back as columns, which are dropped.
_LEVELS = ("_g", "_b", "_a")
_PARTIAL = "p"
_DONE = "_SUCCESS"


def _part(batch_id: str | int) -> str:
    """A batch id as a directory name: what is not a letter, digit or dash by its code."""
    return "_b=" + re.sub(r"[^A-Za-z0-9-]", lambda m: f"_{ord(m[0]):x}_", str(batch_id))


class _Folder:
    """The few file-system calls a table needs, on whatever store its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path
        at = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = at.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def children(self, name: str = "") -> list[str]:
        if not self.fs.exists(self._at(name)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._at(name)))

    def has(self, name: str) -> bool:
        return self.fs.exists(self._at(name))

    def has_rows(self, name: str) -> bool:
        """Whether there is anything but markers below."""
        return any(not n.startswith(("_SUCCESS", ".")) for n in self.children(name))

    def mark(self, name: str) -> None:
        self.fs.create(self._at(name), True).close()

    def remove(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


def _numbered(names: list[str], level: str) -> list[str]:
    """The children with a number, newest first."""
    return sorted((n for n in names if re.fullmatch(rf"{level}=[0-9]{{8}}{_PARTIAL}?", n)), reverse=True)


def _leaves(folder: _Folder, attempt: str) -> dict[str, str]:
    """The partition directories of an attempt by their values; its own path where it
    is not partitioned."""
    found, open_ = {}, [""]
    while open_:
        at = open_.pop()
        inner = [n for n in folder.children(attempt + at) if "=" in n]
        open_ += [f"{at}/{n}" for n in inner]
        if not inner:
            found[at] = attempt + at
    return found


def _attempts(folder: _Folder, generation: str) -> dict[str, list[str]]:
    """What counts of every batch of a generation: its newest finished whole attempt,
    with the partitions that later ones replaced."""
    out = {}
    for batch in folder.children(generation):
        newer: list[str] = []
        for attempt in _numbered(folder.children(f"{generation}/{batch}"), "_a"):
            if folder.has(f"{generation}/{batch}/{attempt}/{_DONE}"):
                newer.append(f"{generation}/{batch}/{attempt}")
                if not attempt.endswith(_PARTIAL):
                    break
        if len(newer) == 1:
            out[batch] = newer
        elif newer:
            leaves: dict[str, str] = {}
            for attempt in newer:
                leaves = {**_leaves(folder, attempt), **leaves}
            out[batch] = [path for at, path in sorted(leaves.items()) if at]
    return out


def _current(folder: _Folder) -> tuple[str | None, dict[str, list[str]]]:
    for generation in _numbered(folder.children(), "_g"):
        if found := _attempts(folder, generation):
            return generation, found
    return None, {}


def _next(names: list[str], level: str) -> str:
    last = _numbered(names, level)
    return f"{level}={int(last[0].strip(_PARTIAL)[-8:]) + 1 if last else 0:08d}"


@dataclass
class Catalog:
    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        """``schema.table`` -> ``root/schema/table``; a bare name goes to ``public``."""
        schema, _, table = name.rpartition(".")
        return f"{self.root.rstrip('/')}/{schema or 'public'}/{table}"

    def exists(self, name: str) -> bool:
        """Whether the table has a finished write; an unreachable or forbidden
        folder raises."""
        return bool(_current(_Folder(self.spark, self.path(name)))[1])

    def read(self, name: str, schema: TableSchema | None = None, without_batch: str | int | None = None) -> DataFrame:
        """The table's rows, without those of one batch if asked. With ``schema``, a
        table (or a rest) that does not exist yet reads as empty (``CREATE TABLE IF
        NOT EXISTS`` followed by a read)."""
        path = self.path(name)
        folder = _Folder(self.spark, path)
        _, found = _current(folder)
        own = None if without_batch is None else _part(without_batch)
        rest = [p for b, paths in found.items() if b != own for p in paths]
        every = [p for paths in found.values() for p in paths]
        if not every and schema is None:
            raise FileNotFoundError(f"no finished write of {name} under {path}")
        if rest or (found and schema is None):  # only the batch that is left out: no rows of it
            rows = self._rows(folder, rest or every)
            return rows if rest else rows.where("false")
        return self.spark.createDataFrame([], schema.struct())

    def _rows(self, folder: _Folder, parts: list[str]) -> DataFrame:
        paths = [f"{folder.path}/{p}" for p in parts]
        if not any("=" in n for p in parts for n in [*p.split("/")[3:], *folder.children(p)]):
            return self.spark.read.parquet(*paths)
        with_rows = [f"{folder.path}/{p}" for p in parts if folder.has_rows(p)] or paths
        return self.spark.read.option("basePath", folder.path).parquet(*with_rows).drop(*_LEVELS)

    def vacuum(self, name: str) -> int:
        """Remove superseded and unfinished writes; how many. Not while the table is
        being written or an older state of it read."""
        folder = _Folder(self.spark, self.path(name))
        generation, found = _current(folder)
        n = 0
        for g in _numbered(folder.children(), "_g"):
            for batch in folder.children(g):
                kept = found.get(batch, []) if g == generation else []
                for attempt in folder.children(f"{g}/{batch}"):
                    own = f"{g}/{batch}/{attempt}"
                    if not any(k == own or k.startswith(f"{own}/") for k in kept):
                        folder.remove(own)
                        n += 1
        return n


def generation_of(catalog: Catalog, name: str) -> str:
    """The directory name of the generation that an append to the table goes to."""
    folder = _Folder(catalog.spark, catalog.path(name))
    return _current(folder)[0] or _next(folder.children(), "_g")


def write_table(
    df: DataFrame, path: str, mode: str = "delete", batch_id: str | int = 0,
    partition_by: Sequence[str] = (), schema: TableSchema | None = None,
) -> None:
    """``delete``: clear and load (S3, C3). ``replace``: the partitions that the frame
    has rows for, of one batch. Anything else: idempotent append of one batch.
    ``partition_by`` may name columns beside those of ``schema``."""
    spark = df.sparkSession
    configure(spark)
    if mode == "replace" and not partition_by:
        raise ValueError("only partitions can be replaced; name them in partition_by")
    for c in partition_by:
        if not isinstance(df.schema[c].dataType, T.IntegerType | T.DateType):
            raise ValueError(f"{c}: a partition column is an int or a date, as others change their type when read back")
    folder = _Folder(spark, path.rstrip("/"))
    generation, found = _current(folder)
    if mode == "delete" or generation is None:
        generation = _next(folder.children(), "_g")
    batch = f"{generation}/{_part(batch_id)}"
    if mode == "replace":
        for part in found.get(_part(batch_id), []):
            if "/" not in part[len(batch) + 1 :] and any(n.startswith("part-") for n in folder.children(part)):
                raise ValueError(f"{part} was written without partitions, so none can be replaced")
    attempt = _next(folder.children(batch), "_a") + (_PARTIAL if mode == "replace" else "")
    broken = None
    if schema is not None:
        df = conform(df, schema, "none", keep=partition_by)
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if schema is not None and (counts := rule_counts(schema)):
        # the last step before the write, so that every row is counted in its own task
        broken = Observation()
        df = df.observe(broken, *[count.alias(f"{column}:{rule}") for column, rule, count in counts])
    df.write.mode("errorifexists").partitionBy(*partition_by).option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", str(broken is None).lower()
    ).parquet(f"{folder.path}/{batch}/{attempt}")
    if broken is not None:
        violations = [(*name.split(":"), n) for name, n in broken.get.items() if n]
        if violations:
            folder.remove(f"{batch}/{attempt}")
            raise ConstraintError(schema.name, violations)
        folder.mark(f"{batch}/{attempt}/{_DONE}")


def load_dimension(
    catalog: Catalog, name: str, df: DataFrame, mode: str = "delete", batch_id: str | int = 0,
    schema: TableSchema | None = None,
) -> DataFrame:
    """LoadDimension (L1): clear when ``mode == 'delete'``, else append; returns the table."""
    write_table(df, catalog.path(name), mode, batch_id, schema=schema)
    return catalog.read(name)


def load_fact(
    catalog: Catalog, name: str, df: DataFrame, mode: str = "delete", batch_id: str | int = 0,
    partition_by: Sequence[str] = (), schema: TableSchema | None = None,
) -> DataFrame:
    """LoadFact (L2): same modes as ``load_dimension``, and by partitions where asked
    (``operators.partitions`` gives those of a month)."""
    write_table(df, catalog.path(name), mode, batch_id, partition_by, schema)
    return catalog.read(name)
