"""Runs as folders of validated documents and tables.

Nothing invalid is written, nothing finished is overwritten, and the pointer to the
latest run moves last. Tables are written by Spark's commit protocol into a staging
folder beside their place and renamed; small documents go through the same file
system. Any Hadoop file system does; a rename of a folder is one step on HDFS and
local disks, on object stores it is a copy, and there the manifest, written after
everything else, is what makes a run.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_ID = re.compile(r"^\d{8}T\d{6}Z-\d+$")
POINTER = "LATEST_RUN_ID"


class PublishError(ValueError):
    """A refusal: what it names was not written."""


def serialized(document: Mapping | list) -> bytes:
    """The one rendering of a document: keys sorted, two blanks, one final newline."""
    return (json.dumps(document, sort_keys=True, ensure_ascii=False, indent=2, separators=(",", ": ")) + "\n").encode()


def run_id(now: float | None = None, pid: int | None = None) -> str:
    return time.strftime("%Y%m%dT%H%M%SZ", time.gmtime(now)) + f"-{os.getpid() if pid is None else pid}"


class Store:
    """Documents and tables below a root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, name: str) -> bool:
        return self._fs().exists(self._path(name))

    def delete(self, name: str) -> None:
        self._fs().delete(self._path(name), True)

    def read(self, name: str) -> bytes | None:
        if not self.exists(name):
            return None
        # binaryFile passes over empty files
        rows = self.spark.read.format("binaryFile").load(f"{self.root}/{name}").select("content").collect()
        return bytes(rows[0][0]) if rows else b""

    def _put(self, name: str, data: bytes) -> None:
        """Write beside the place, then rename over it: no reader sees a part."""
        fs, to = self._fs(), self._path(name)
        own = self._path(f"{os.path.dirname(name)}/.tmp-{uuid.uuid4().hex}".lstrip("/"))
        try:
            out = fs.create(own, True)
            out.write(bytearray(data))
            out.close()
            if fs.exists(to):
                fs.delete(to, False)
            if not fs.rename(own, to):
                raise PublishError(f"{name} could not be put into place")
        finally:
            if fs.exists(own):
                fs.delete(own, False)

    def write_document(self, name: str, document: Mapping | list, validate: Callable[[Mapping | list], Iterable[str]] = lambda d: ()) -> None:
        """Validate, then write; an invalid document leaves everything as it was."""
        if problems := list(validate(document)):
            raise PublishError(f"{name}: {len(problems)} problems: {'; '.join(problems[:3])}")
        self._put(name, serialized(document))

    def write_table(self, name: str, table: DataFrame, violations: DataFrame | None = None, by: Iterable[str] = (), sort: Iterable = (), overwrite: bool = False) -> int:
        """Write a table if ``violations``, a report over it, is empty; rows sorted
        within its files if ``sort`` says how. Gives the number of rows written."""
        if violations is not None and (some := violations.limit(3).collect()):
            raise PublishError(f"{name}: {'; '.join(str(r.asDict()) for r in some)}")
        if self.exists(name) and not overwrite:
            raise PublishError(f"{name} is there already")
        stage = f".staging-{uuid.uuid4().hex}"
        by = list(by)
        order = [*by, *sort] if sort else []  # the writer keeps an order that begins with its partitions
        try:
            w = (table.sortWithinPartitions(*order) if order else table).write
            w.partitionBy(*by).parquet(f"{self.root}/{stage}") if by else w.parquet(f"{self.root}/{stage}")
            n = self.spark.read.parquet(f"{self.root}/{stage}").count()
            fs, to = self._fs(), self._path(name)
            fs.mkdirs(to.getParent())
            if overwrite and fs.exists(to):
                fs.delete(to, True)
            if not fs.rename(self._path(stage), to):
                raise PublishError(f"{name} could not be put into place")
            return n
        finally:
            self.delete(stage)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    # Places: what belongs to a run, and what goes on from run to run.

    def cells(self, run: str) -> str:
        return f"runs/{run}/cells"

    def topics(self, run: str) -> str:
        return f"runs/{run}/topics"

    def ledger(self) -> str:
        return "ledgers"

    def rejections(self) -> str:
        return "rejections"

    def manifest(self, run: str) -> str:
        return f"runs/{run}/manifest.json"

    def finished(self, run: str) -> bool:
        """Whether the run has a manifest, which is what finished means: ask before
        writing anything for it."""
        return self.exists(self.manifest(run))

    def publish(self, run: str, manifest: Mapping, validate: Callable[[Mapping], Iterable[str]] = lambda d: ()) -> None:
        """The manifest, then the pointer, and nothing after it. Refused for a run
        that didn't finish, a manifest of another run, a name that is none, and a run
        that has a manifest."""
        if not RUN_ID.match(run):
            raise PublishError(f"{run!r} is no run identifier")
        if manifest.get("finished_at") is None:
            raise PublishError(f"run {run} isn't finished")
        if manifest.get("harvest_run_id") != run:
            raise PublishError(f"the manifest is of run {manifest.get('harvest_run_id')!r}, not of {run!r}")
        if self.finished(run):
            raise PublishError(f"run {run} has a manifest already")
        self.write_document(self.manifest(run), manifest, validate)
        self._put(POINTER, f"{run}\n".encode())

    def latest(self, validate: Callable[[Mapping], Iterable[str]] = lambda d: ()) -> str | None:
        """The run that the pointer names, or None before the first. Raises where its
        manifest is missing, can't be read, is invalid or of another run."""
        raw = self.read(POINTER)
        run = raw.decode().strip() if raw else ""
        if not run:
            return None
        data = self.read(self.manifest(run))
        if data is None:
            raise PublishError(f"the pointer names {run}, which has no manifest")
        try:
            doc = json.loads(data)
        except ValueError as e:
            raise PublishError(f"the manifest of {run} can't be read: {e}") from e
        if problems := list(validate(doc)):
            raise PublishError(f"the manifest of {run} is invalid: {'; '.join(problems[:2])}")
        if doc.get("harvest_run_id") != run:
            raise PublishError(f"the pointer names {run}, its manifest {doc.get('harvest_run_id')!r}")
        return run

    def load_ledger(self, schema: str, cells: Iterable[str]) -> DataFrame:
        """The ledger so far: empty before the first run. One that holds cells that
        aren't configured is refused."""
        if not self.exists(self.ledger()):
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).parquet(f"{self.root}/{self.ledger()}")
        if odd := found.where(~F.col("cell_id").isin(*cells)).select("cell_id").distinct().limit(3).collect():
            raise PublishError(f"the ledger holds cells that aren't configured: {sorted(r[0] for r in odd)}")
        return found

    def write_bundle(self, name: str, documents: Mapping[str, tuple[Mapping, Callable[[Mapping], Iterable[str]]]]) -> None:
        """Several documents as one: all are validated, written into a staging folder,
        checked to be exactly these, and put into place by one rename."""
        if self.exists(name):
            raise PublishError(f"{name} is there already")
        for n, (doc, validate) in documents.items():
            if problems := list(validate(doc)):
                raise PublishError(f"{n}: {'; '.join(problems[:3])}")
        stage, fs = f".staging-{uuid.uuid4().hex}", self._fs()
        try:
            for n, (doc, _) in documents.items():
                self._put(f"{stage}/{n}", serialized(doc))
            there = sorted(str(s.getPath().getName()) for s in fs.listStatus(self._path(stage)))
            if there != sorted(documents):
                raise PublishError(f"{name}: staged {there}, not {sorted(documents)}")
            fs.mkdirs(self._path(name).getParent())
            if not fs.rename(self._path(stage), self._path(name)):
                raise PublishError(f"{name} could not be put into place")
        finally:
            self.delete(stage)

    def debris(self) -> list[str]:
        """Temporary names that an interrupted writer left."""
        fs, out = self._fs(), []
        if fs.exists(self._path("")):
            todo = [self._path("")]
            while todo:
                for s in fs.listStatus(todo.pop()):
                    n = s.getPath().getName()
                    if n.startswith((".tmp-", ".staging-")):
                        out.append(str(s.getPath().toString()))
                    elif s.isDirectory():
                        todo.append(s.getPath())
        return sorted(out)


class Durations:
    """Seconds of named steps, three decimals, from a clock that never runs back."""

    def __init__(self, clock: Callable[[], float] = time.monotonic):
        self._clock, self._begun, self.seconds = clock, {}, {}

    def begin(self, step: str) -> None:
        self._begun[step] = self._clock()

    def end(self, step: str) -> float:
        took = self._clock() - self._begun.pop(step)
        if took < 0:
            raise ValueError(f"{step} took {took} seconds")
        self.seconds[step] = round(took, 3)
        return self.seconds[step]


def narrowed(limit: float, asked: float | None, what: str) -> float:
    """A bound may be asked to be narrower than the configuration's, never wider."""
    if asked is None:
        return limit
    if not 0 < asked <= limit:
        raise ValueError(f"{what} may be at most {limit:g}, not {asked:g}")
    return asked
