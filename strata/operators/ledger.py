"""Load ledger: what was loaded into a table, kept beside its data in ``_ledger`` (readers of the table skip the folder).

One small file per batch (id, rows, greatest key, partitions) and one with the table's greatest surrogate key. A load asks
two files of a fixed name, whatever the size of the table or the number of loads: has this batch been loaded, and where do
the keys go on. The key file names the batch that is being written; if a load broke off, it still does, and the next load
takes the greatest key from the data once. Loads into one table run one after the other.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER, KEYS = "_ledger", "keys.json"
BATCH_SCHEMA = "batch_id string, loaded_at string, rows long, greatest_key long, partitions array<string>"


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.root = spark, f"{path.rstrip('/')}/{FOLDER}"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._store = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _read(self, name: str) -> dict | None:
        at = self._path(f"{self.root}/{name}")
        if not self._store.exists(at):
            return None
        stream = self._store.open(at)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _write(self, name: str, content: dict) -> None:
        """Under another name first, so that a broken write leaves no half file."""
        new, at = self._path(f"{self.root}/.{name}.new"), self._path(f"{self.root}/{name}")
        stream = self._store.create(new, True)
        try:
            stream.write((json.dumps(content) + "\n").encode())
        finally:
            stream.close()
        self._store.delete(at, False)
        if not self._store.rename(new, at):
            raise OSError(f"{at} could not be written")

    @staticmethod
    def _name(batch_id: str) -> str:
        return f"batch-{hashlib.sha256(batch_id.encode()).hexdigest()[:32]}.json"

    def loaded(self, batch_id: str) -> bool:
        return self._read(self._name(batch_id)) is not None

    def greatest_key(self) -> int | None:
        """None: not known (no load so far, or the last one broke off)."""
        keys = self._read(KEYS)
        return None if keys is None or keys["writing"] else keys["greatest_key"]

    def begin(self, batch_id: str, greatest_key: int | None) -> None:
        self._write(KEYS, {"greatest_key": greatest_key, "writing": batch_id})

    def end(self, batch_id: str, rows: int, greatest_key: int | None, partitions: list[str] | None) -> None:
        self._write(self._name(batch_id), {"batch_id": batch_id, "loaded_at": dt.datetime.now(dt.timezone.utc).isoformat(),
                                           "rows": rows, "greatest_key": greatest_key, "partitions": partitions})
        self._write(KEYS, {"greatest_key": greatest_key, "writing": None})


def batches(spark: SparkSession, path: str) -> DataFrame:
    """The loads of a table: batch_id, loaded_at, rows, greatest_key, partitions."""
    return spark.read.schema(BATCH_SCHEMA).json(f"{path.rstrip('/')}/{FOLDER}/batch-*.json")


def stored_greatest_key(target: DataFrame, key_name: str) -> int:
    """The greatest key from the data: for tables without a ledger and after a load that broke off."""
    return target.agg(F.max(key_name)).first()[0] or 0
