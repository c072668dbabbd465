"""A table of batches that readers see whole, and that can be compacted beneath them.

Each attempt at a batch writes a folder of its own; then one small commit file, put in
place by an atomic rename, says which folder is the batch. A reader takes the folders
that commits name, so while a batch is replayed it sees the old rows or the new ones. A
*snapshot*, swapped in the same way, names the folders of batches that were rewritten as
one and, for each run, up to which batch they reach; their commits count no more.

The newest batch of a run is never compacted: it is the only one a stream can replay.
Each compaction rewrites what came since the one before and nothing older, so all rows are
rewritten once. Commits and folders out of use are kept for readers that began before,
until ``vacuum``. One stream and one compaction may be at work at a time.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from riskstream.streaming.sinks import BatchRef

SNAPSHOT = "snapshot"
FILE_BYTES = 64 << 20  # of a compacted file, unless their number is given


class CommittedTable:
    """Batches under ``root``, a folder all executors share. An empty table has no folder."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType | str) -> None:
        self.spark, self.root, self.schema = spark, root, schema
        jvm = spark.sparkContext._jvm
        self._fs_package = jvm.org.apache.hadoop.fs
        self._path(root)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path(root).getFileSystem(conf)
        self._context = self._fs_package.FileContext.getFileContext(
            self._files.makeQualified(self._path(root)).toUri(), conf
        )

    def _path(self, name: str):
        return self._fs_package.Path(name)

    def _put(self, name: str, content: dict) -> None:
        """A file of the manifest, replaced as a whole."""
        target = self._files.makeQualified(self._path(f"{self.root}/_commits/{name}"))
        partial = self._path(f"{target.getParent()}/.{uuid.uuid4().hex}")
        out = self._files.create(partial)
        try:
            out.write(bytearray(json.dumps(content).encode()))
        finally:
            out.close()
        kind = getattr(self._fs_package, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        self._context.rename(self._context.makeQualified(partial), target, options)

    def _listed(self, folder: str) -> list:
        try:
            return list(self._files.listStatus(self._path(folder)))
        except Py4JJavaError as error:
            if "FileNotFoundException" not in str(error.java_exception.getClass().getName()):
                raise
            return []

    def _manifest(self) -> dict[str, dict]:
        names = [s.getPath().getName() for s in self._listed(f"{self.root}/_commits")]
        names = [n for n in names if not n.startswith(".")]
        if not names:
            return {}
        # Small files of one line; read by Spark, wherever the table lies.
        lines = self.spark.read.schema("value string, name string").text(
            [f"{self.root}/_commits/{n}" for n in names]
        ).selectExpr("value", "_metadata.file_name as name")
        return {row.name: json.loads(row.value) for row in lines.collect()}

    def _state(self) -> tuple[dict, list[dict]]:
        """The snapshot, and the commits it does not hold, by run and batch."""
        manifest = self._manifest()
        snapshot = manifest.pop(SNAPSHOT, {"folders": [], "upto": {}})
        later = [
            c for c in manifest.values() if c["batch_id"] > snapshot["upto"].get(c["run"], -1)
        ]
        return snapshot, sorted(later, key=lambda c: (c["run"], c["batch_id"]))

    def _frame(self, folders: list[str]) -> DataFrame:
        reader = self.spark.read.schema(self.schema)
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return reader.parquet(*[f"{self.root}/{folder}" for folder in folders])

    def write(self, frame: DataFrame, batch: BatchRef) -> DataFrame:
        """Store a batch in place of what an earlier attempt at it stored; its rows as stored."""
        folder = f"data/{batch.run}-{batch.batch_id}-{uuid.uuid4().hex}"
        frame.write.mode("error").parquet(f"{self.root}/{folder}")
        self._put(
            f"{batch.run}-{batch.batch_id}",
            {"run": batch.run, "batch_id": batch.batch_id, "folder": folder},
        )
        return self._frame([folder])

    def read(self) -> DataFrame:
        """All committed batches, as they are at this moment."""
        snapshot, later = self._state()
        return self._frame([*snapshot["folders"], *[c["folder"] for c in later]])

    def _size(self, folders: list[str]) -> int:
        paths = [self._path(f"{self.root}/{folder}") for folder in folders]
        return sum(self._files.getContentSummary(path).getLength() for path in paths)

    def compact(
        self, files: int | None = None, merge: Callable[[DataFrame], DataFrame] | None = None
    ) -> int:
        """Rewrite the batches since the last compaction as ``files`` files; how many there were.

        Unless given, the number of files follows from the batches' size, and so does that of
        the tasks which write them. ``merge`` may reduce their rows, if the table's reader
        adds up what it reads.
        """
        snapshot, later = self._state()
        newest = {c["run"]: c["batch_id"] for c in later}  # in order: the last one stays
        closed = [c for c in later if c["batch_id"] < newest[c["run"]]]
        if not closed:
            return 0
        folder = f"data/compacted-{uuid.uuid4().hex}"
        batches = [c["folder"] for c in closed]
        files = files or max(1, -(-self._size(batches) // FILE_BYTES))
        rows = self._frame(batches)
        rows = (merge(rows) if merge else rows).repartition(files)
        rows.write.mode("error").parquet(f"{self.root}/{folder}")
        upto = snapshot["upto"] | {c["run"]: c["batch_id"] for c in closed}
        self._put(SNAPSHOT, {"folders": [*snapshot["folders"], folder], "upto": upto})
        return len(closed)

    def vacuum(self, older_than: float) -> int:
        """Delete what is out of use and was written that many seconds ago; how many folders.

        Readers that began later than that are not disturbed.
        """
        snapshot, later = self._state()
        before = (time.time() - older_than) * 1000
        named = {*snapshot["folders"], *[c["folder"] for c in later]}
        used = {SNAPSHOT, *[f"{c['run']}-{c['batch_id']}" for c in later]}

        def stale(folder: str, keep: set[str]) -> list:
            return [
                s.getPath() for s in self._listed(f"{self.root}/{folder}")
                if s.getPath().getName() not in keep and s.getModificationTime() < before
            ]

        for path in stale("_commits", used):
            self._files.delete(path, False)
        folders = stale("data", {name.split("/")[1] for name in named})
        for path in folders:
            self._files.delete(path, True)
        return len(folders)


def is_committed(spark: SparkSession, root: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/_commits")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
