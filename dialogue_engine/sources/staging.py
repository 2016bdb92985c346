"""Writing the tables of a run as one unit.

New rows are written beside the old ones, in a folder that readers skip, and put in place when all
of them are there. Before that, the old run can be read whole; a crash leaves it as it was. The
change itself is a list of renames, stored before the first of them is made: a crash between two
leaves the list, and whoever writes there next makes the rest of them first.
"""

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

STAGED = "_staged"
PLAN = "swap.json"


class _Store:
    """The file system of a folder, through the session."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._jvm = spark._jvm
        self.files = self.at(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, path: str):
        return self._path(path)

    def exists(self, path: str) -> bool:
        return self.files.exists(self.at(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(f.getPath().getName() for f in self.files.listStatus(self.at(path)))

    def make(self, path: str) -> None:
        self.files.mkdirs(self.at(path))

    def delete(self, path: str) -> None:
        self.files.delete(self.at(path), True)

    def move(self, source: str, target: str) -> None:
        self.make(target.rsplit("/", 1)[0])
        if not self.files.rename(self.at(source), self.at(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def write(self, path: str, text: str) -> None:
        out = self.files.create(self.at(path), True)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, path: str) -> str:
        stream = self.files.open(self.at(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def _put_in_place(store: _Store, root: str, staged: str) -> None:
    """Make the renames of a stored list that are still to be made. Each can be made again: a
    staged folder that is gone is in its place already."""
    for folder in json.loads(store.read(f"{staged}/{PLAN}")):
        if store.exists(f"{staged}/new/{folder}"):
            target = f"{root}/{folder}" if folder else root
            if store.exists(target):
                store.delete(target)
            store.move(f"{staged}/new/{folder}", target)
    store.delete(staged)


def finish_swaps(spark: SparkSession, root: str) -> None:
    """End what a crash has interrupted: staged rows whose list of renames was stored are put in
    place. Others stay unseen, as their run may still be at work; ``drop_staged`` deletes them."""
    store = _Store(spark, root)
    for name in store.names(f"{root}/{STAGED}"):
        staged = f"{root}/{STAGED}/{name}"
        if store.exists(f"{staged}/{PLAN}"):
            _put_in_place(store, root, staged)


def drop_staged(spark: SparkSession, root: str) -> None:
    """Delete staged rows that were never put in place. Call it when nothing writes to ``root``."""
    finish_swaps(spark, root)
    _Store(spark, root).delete(f"{root}/{STAGED}")


class Staging:
    """New rows for the tables under ``root``, partitioned by run, which replace the old rows of the
    same runs together when ``commit`` is called."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        finish_swaps(spark, root)
        self._spark, self._root = spark, root.rstrip("/")
        self._folder = f"{self._root}/{STAGED}/{uuid.uuid4().hex}"
        self._store = _Store(spark, root)
        self._tables: list[str] = []

    def path(self, table: str) -> str:
        """Where the new rows of a table are, before the commit."""
        return f"{self._folder}/new/{table}".rstrip("/")

    def write(self, df: DataFrame, table: str, fmt: str = "parquet", runs: Iterable[str] = ()) -> None:
        """Stage rows with a ``run_id``. Runs named in ``runs`` lose their old rows even if they have
        no new ones. The rebalance hint sends a small run to few tasks and a large one to many."""
        df.hint("rebalance", "run_id").write.partitionBy("run_id").format(fmt).save(self.path(table))
        utils = self._spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        for run in runs:
            self._store.make(f"{self.path(table)}/{utils.getPartitionPathString('run_id', run)}")
        self._tables.append(table)

    def commit(self) -> None:
        """Put all staged runs in place of the old ones."""
        folders = [
            f"{table}/{name}".lstrip("/")
            for table in self._tables
            for name in self._store.names(self.path(table))
            if name.startswith("run_id=")
        ]
        # the list counts once it has its name, so half of one is never read
        self._store.write(f"{self._folder}/{PLAN}.part", json.dumps(folders))
        self._store.move(f"{self._folder}/{PLAN}.part", f"{self._folder}/{PLAN}")
        _put_in_place(self._store, self._root, self._folder)

    def discard(self) -> None:
        self._store.delete(self._folder)
