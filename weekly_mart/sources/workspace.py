"""Shared-storage workspace: where written layers live.

The root is the folder the cluster names in ``spark.checkpoint.dir`` (a
shared, fault-tolerant file system), or a folder of the warehouse where that
is unset. A table is a folder of versions: every write makes a new one,
``target/v-<number>-<id>``, through Spark's commit protocol, and the newest
version with a ``_SUCCESS`` file is the table. That file is the only switch:
data is never moved, a job that dies leaves the version before it in place,
and a DataFrame opened earlier goes on reading its own version.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _code_version() -> str:
    """Hash of this package's source: a code change never reuses old tables."""
    root = Path(__file__).resolve().parents[1]
    h = hashlib.sha1()
    for f in sorted(root.rglob("*.py")):
        if "llm" in f.relative_to(root).parts:  # no table of this workspace comes from there
            continue
        h.update(f.relative_to(root).as_posix().encode())
        h.update(f.read_bytes())
    return h.hexdigest()[:12]


CODE_VERSION = _code_version()
#: Replaced versions stay this long for readers that opened them earlier.
KEEP_SECONDS = 7 * 24 * 3600
_VERSION = re.compile(r"v-(\d{8})-[0-9a-f]{8}")
#: Kept with a version: counts taken while it was written; beside the versions: notes on each.
_COUNTS, _NOTES = "_counts.json", "_notes"


def checkpoint_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or else a folder of the warehouse, which on a cluster must not be machine-local."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return warehouse.rstrip("/") + "/_workspace"


class Workspace:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or checkpoint_root(spark)).rstrip("/")

    # -- file system helpers (Hadoop FileSystem, works on any cluster FS) --
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs, jpath

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *[p.strip("/") for p in parts]])

    def exists(self, path: str) -> bool:
        fs, jpath = self._fs(path)
        return bool(fs.exists(jpath))

    def delete(self, path: str) -> None:
        fs, jpath = self._fs(path)
        if fs.exists(jpath):
            fs.delete(jpath, True)

    def children(self, path: str) -> list[str]:
        """Names of the folders in a folder."""
        fs, jpath = self._fs(path)
        if not fs.exists(jpath):
            return []
        return sorted(st.getPath().getName() for st in fs.listStatus(jpath) if st.isDirectory())

    def put_text(self, path: str, text: str) -> None:
        fs, jpath = self._fs(path)
        out = fs.create(jpath, True)
        out.write(bytearray(text.encode()))
        out.close()

    def get_text(self, path: str) -> str:
        fs, jpath = self._fs(path)
        stream = fs.open(jpath)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def mark(self, path: str) -> None:
        """An empty file that says something is finished."""
        self.put_text(path, "")

    def make_folder(self, path: str) -> None:
        fs, jpath = self._fs(path)
        fs.mkdirs(jpath)

    def fingerprint(self, *paths: str) -> str:
        """Hash of this code and of every input file's path, size and time.

        Files are listed one by one and folded into one number, so the order and
        the count of files don't matter."""
        h = hashlib.sha1(CODE_VERSION.encode())
        for p in paths:
            fs, jpath = self._fs(p)
            h.update(p.encode())
            files, folded = fs.listFiles(jpath, True), 0
            while files.hasNext():
                st = files.next()
                entry = f"{st.getPath().toString()}:{st.getLen()}:{st.getModificationTime()}"
                folded = (folded + int.from_bytes(hashlib.sha1(entry.encode()).digest())) % (1 << 160)
            h.update(folded.to_bytes(20))
        return h.hexdigest()[:16]

    # -- versions -------------------------------------------------------------
    def _versions(self, target: str) -> list[tuple[str, int, bool]]:
        """(path, time, complete) of every version, oldest first."""
        fs, jtarget = self._fs(target)
        if not fs.exists(jtarget):
            return []
        jvm = self.spark.sparkContext._jvm
        found = [st for st in fs.listStatus(jtarget) if _VERSION.fullmatch(st.getPath().getName())]
        return [
            (
                st.getPath().toString(),
                st.getModificationTime(),
                bool(fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))),
            )
            for st in sorted(found, key=lambda st: st.getPath().getName())
        ]

    def current(self, target: str) -> str | None:
        """Folder of the newest complete version."""
        return next((path for path, _, done in reversed(self._versions(target)) if done), None)

    def is_complete(self, target: str) -> bool:
        return self.current(target) is not None

    def read(self, target: str) -> DataFrame:
        path = self.current(target)
        if path is None:
            raise FileNotFoundError(f"no complete version of {target}")
        return self.spark.read.parquet(path)

    def counted(self, target: str) -> dict[str, int] | None:
        """The counts kept with the newest complete version, if it has any."""
        path = self.current(target)
        if path is None or not self.exists(f"{path}/{_COUNTS}"):
            return None
        return json.loads(self.get_text(f"{path}/{_COUNTS}"))

    def note(self, path: str) -> str:
        target, version = path.rsplit("/", 1)
        return self.get_text(f"{target}/{_NOTES}/{version}")

    # -- writes ---------------------------------------------------------------
    def write(self, df: DataFrame, target: str, fmt: str = "parquet", counts: dict[str, str] | None = None, **options) -> str:
        """Write a new version of ``target``; returns its folder.

        ``counts`` are named aggregates, as SQL, that are worked out while the rows are
        written and kept with the version (`counted` reads them back)."""
        partition_by = options.pop("partition_by", None)
        seen = Observation() if counts else None

        def save(path: str) -> None:
            rows = df.observe(seen, *[F.expr(c).alias(name) for name, c in counts.items()]) if counts else df
            w = rows.write.format(fmt).mode("errorifexists").options(**options)
            (w.partitionBy(*partition_by) if partition_by else w).save(path)

        path = self.write_with(save, target)
        if counts:
            self.put_text(f"{path}/{_COUNTS}", json.dumps({name: seen.get[name] for name in counts}))
        return path

    def write_with(self, save: Callable[[str], None], target: str, note: str | None = None) -> str:
        """A new version of ``target`` that ``save`` writes to the folder it is given; ``note`` is kept with it."""
        before = self._versions(target)
        number = 1 + max((int(_VERSION.search(path)[1]) for path, _, _ in before), default=0)
        path = f"{target}/v-{number:08d}-{uuid.uuid4().hex[:8]}"
        try:
            if note is not None:
                self.put_text(f"{target}/{_NOTES}/{path.rsplit('/', 1)[1]}", note)
            save(path)
        except Exception:
            self.delete(path)  # a failed job leaves no partial folder behind
            raise
        self._expire(before)
        return path

    def _expire(self, replaced: list[tuple[str, int, bool]]) -> None:
        for path, changed, _ in replaced:
            if changed < (time.time() - KEEP_SECONDS) * 1000:
                self.delete(path)

    def materialize(
        self, target: str, build: Callable[[], DataFrame], fmt: str = "parquet",
        counts: dict[str, str] | None = None, **options
    ) -> DataFrame:
        """Write ``build()`` to ``target`` unless a complete copy is there; read it back."""
        if not self.is_complete(target):
            self.write(build(), target, fmt=fmt, counts=counts, **options)
        return self.read(target) if fmt == "parquet" else None
