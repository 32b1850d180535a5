"""Key ranges of a table's batches, claimed before their rows are numbered (K2).

``max(key) + 1`` gives two appends that run at once the same keys. Instead a batch
claims a range as long as it has rows, by creating the next numbered file in the
table's folder; a store creates a file once, so one of several writers gets it and the
others take the next. A range begins where the one before ends, so keys stay dense
however many batches append at once, and a retry of a batch finds its own range.

The table's present keys are the base of a generation's first range. A claim that was
begun and not finished (a driver that died between creating and closing a file of some
bytes) has an unknown length; later claims wait for it and then raise.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession

from starloom.operators.keys import next_key, with_surrogate_key
from starloom.plans.tables import Catalog, generation_of

WAIT_S = 30.0


@dataclass(frozen=True)
class KeyRange:
    batch: str
    start: int
    rows: int

    @property
    def end(self) -> int:
        return self.start + self.rows


class _Claims:
    """Numbered files of one folder, each created once."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def create(self, number: int, text: str) -> bool:
        """Whether this call created the file."""
        at = self._at(f"{number:010d}")
        self.fs.mkdirs(at.getParent())
        uri = urlparse(self.fs.makeQualified(at).toString())
        if uri.scheme == "file":  # Hadoop's local files are checked and then created, which two may pass
            try:
                with os.fdopen(os.open(at.toUri().getPath(), os.O_WRONLY | os.O_CREAT | os.O_EXCL), "w") as f:
                    f.write(text)
            except FileExistsError:
                return False
            return True
        try:
            out = self.fs.create(at, False)
        except Exception:
            if self.fs.exists(at):
                return False
            raise
        out.write(text.encode())
        out.close()
        return True

    def read(self, wait_s: float) -> list[KeyRange]:
        """All claims in order; one that is being written is waited for."""
        if not self.fs.exists(self._at("")):
            return []
        names = sorted(s.getPath().getName() for s in self.fs.listStatus(self._at("")))
        found = []
        for name in (n for n in names if n.isdigit()):
            end = time.monotonic() + wait_s
            while not (text := self._text(name)).endswith("}"):
                if time.monotonic() > end:
                    raise TimeoutError(f"the claim {self.path}/{name} was never finished; remove it if its writer is gone")
                time.sleep(0.05)
            found.append(KeyRange(**json.loads(text)))
        return found

    def _text(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def claim_range(
    catalog: Catalog, name: str, batch_id: str | int, rows: int, base: int = 0, wait_s: float = WAIT_S
) -> KeyRange:
    """The batch's range of the table's present generation: its own from before where it
    is long enough, else the next one. ``base`` is the least key of the first range."""
    claims = _Claims(catalog.spark, f"{catalog.path(name)}/_ranges/{generation_of(catalog, name)}")
    batch = str(batch_id)
    while True:
        taken = claims.read(wait_s)
        for r in taken:
            if r.batch == batch and r.rows >= rows:
                return r
        mine = KeyRange(batch, max([base, *(r.end for r in taken)]), rows)
        if claims.create(len(taken), json.dumps(mine.__dict__)):
            return mine


def append_with_range(
    catalog: Catalog, name: str, new_rows: DataFrame, key: str, order_by: Sequence[Column | str], batch_id: str | int
) -> DataFrame:
    """Key the new rows from a range of their own (see the module's text); they are
    counted first. ``name`` may be a table that does not exist yet."""
    base = 0
    if catalog.exists(name):
        base = catalog.spark.range(1).select(next_key(catalog.read(name, without_batch=batch_id), key)).first()[0]
    r = claim_range(catalog, name, batch_id, new_rows.count(), base)
    return with_surrogate_key(new_rows, key, order_by, start=r.start)
