"""Fitted models kept as versions: tables, pipelines and figures that are served only once published whole.

A version is written to a folder of its own. Publishing is one small record in ``log/``, moved into place by a
rename that fails if its number is taken: readers see all of a version or nothing of it, two writers get two
numbers, and a job that dies half-way leaves a folder that no record names. Every read goes through the log.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..session import file_system

_RECORD = re.compile(r"(\d{10})\.json")


@dataclass(frozen=True)
class Version:
    """One published version. ``tables`` and ``pipelines`` are opened on demand."""

    spark: SparkSession
    path: str
    number: int
    as_of: str
    metrics: dict = field(default_factory=dict)
    schemas: dict = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.schemas[name]).parquet(f"{self.path}/{name}")

    def pipeline(self, name: str) -> PipelineModel:
        return PipelineModel.load(f"{self.path}/{name}")


class ModelStore:
    """Versions of named models under one folder of a shared store."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def publish(self, name: str, as_of, tables: dict[str, DataFrame] | None = None, pipelines: dict[str, PipelineModel] | None = None,
                metrics: dict | None = None) -> Version:
        """Write everything, then name it in the log; ``as_of`` is the last day the model has seen."""
        path, schemas = f"{self.root}/{name}/data/{uuid.uuid4().hex}", {}
        for key, table in (tables or {}).items():
            table.write.parquet(f"{path}/{key}")
            schemas[key] = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
        for key, pipeline in (pipelines or {}).items():
            pipeline.write().save(f"{path}/{key}")
        record = {"as_of": str(as_of), "path": path, "metrics": metrics or {}, "schemas": schemas}
        return self._commit(name, record)

    def _commit(self, name: str, record: dict) -> Version:
        log = f"{self.root}/{name}/log"
        fs, _ = file_system(self.spark, log)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        draft = path(f"{log}/.{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(record).encode()))
        out.close()
        files = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        no_overwrite = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        no_overwrite[0] = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        while True:
            number = max(self.numbers(name), default=0) + 1
            target = path(f"{log}/{number:010d}.json")
            try:
                files.rename(draft, target, no_overwrite)
            except Exception:
                if not fs.exists(target):  # a failure of the store; a taken number is tried again with the next
                    raise
                continue
            return Version(self.spark, record["path"], number, record["as_of"], record["metrics"], record["schemas"])

    def numbers(self, name: str) -> list[int]:
        """Published numbers, ascending."""
        fs, log = file_system(self.spark, f"{self.root}/{name}/log")
        if not fs.exists(log):
            return []
        found = (_RECORD.fullmatch(s.getPath().getName()) for s in fs.listStatus(log))
        return sorted(int(m.group(1)) for m in found if m)

    def versions(self, name: str) -> list[Version]:
        """All published versions, ascending: one short record each."""
        fs, _ = file_system(self.spark, self.root)
        out = []
        for n in self.numbers(name):
            stream = fs.open(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/log/{n:010d}.json"))
            try:
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            r = json.loads(text)
            out.append(Version(self.spark, r["path"], n, r["as_of"], r["metrics"], r["schemas"]))
        return out

    def get(self, name: str, as_of=None, number: int | None = None) -> Version:
        """The newest version that had seen nothing after ``as_of`` (any, if None), or the version of a number."""
        known = [v for v in self.versions(name) if (number is None or v.number == number) and (as_of is None or v.as_of <= str(as_of))]
        if not known:
            raise KeyError(f"no version of {name!r} for as_of={as_of}, number={number}")
        return max(known, key=lambda v: (v.as_of, v.number))

    def prune(self, name: str, keep: int) -> int:
        """Remove all but the newest ``keep`` versions, record first: what a reader can still name is whole."""
        if keep < 1:
            raise ValueError("at least one version stays")
        gone = self.versions(name)[:-keep]
        for v in gone:
            for path in (f"{self.root}/{name}/log/{v.number:010d}.json", v.path):
                fs, where = file_system(self.spark, path)
                fs.delete(where, True)
        return len(gone)
