"""Publishing a star as a whole, and loading it in parts.

A run writes its tables to a folder of its own, ``root/runs/<run>``.  When all
of them are written, a manifest (paths, schemas, row counts, content
fingerprints, high-water marks of surrogate keys) is put in place by one rename,
``root/manifests/<number>.json``.  Readers follow the manifest with the highest
number, so they see one star or the next, never tables of two; a run that fails
leaves the former star as it was.

Runs claim their manifest's number first (``root/manifests/<number>.claim``,
created exclusively).  Two runs that start from one manifest claim the same
number: the second one gets ``PublishConflict`` and publishes nothing, so keys
that both handed out are never visible twice.  A run that fails gives its claim
back; one that was killed leaves it, and ``release`` removes it by hand.
Exclusive creation and rename are those of the file system (HDFS and local
folders have them; object stores need a committer that does).
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starbuild.plans import star as stars
from starbuild.sources import sinks


class PublishConflict(RuntimeError):
    """Another run has published, or is publishing, after the same manifest."""


@dataclass
class Table:
    paths: list[str]          # relative to the root; a fact loaded in parts has one a load
    schema: str               # JSON
    rows: int
    partition_by: list[str] = field(default_factory=list)
    content: list[str] = field(default_factory=list)     # fingerprint of each path


@dataclass
class Manifest:
    number: int
    run: str
    tables: dict[str, Table]
    high_water: dict[str, int] = field(default_factory=dict)     # next free surrogate key of a table

    def json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def of(cls, text: str) -> Manifest:
        found = json.loads(text)
        return cls(found["number"], found["run"], {n: Table(**t) for n, t in found["tables"].items()}, found["high_water"])


class _Files:
    """The few file operations needed, on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        if not self.fs.exists(self.path(folder)):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(folder))]

    def create(self, name: str, text: str = "") -> None:
        out = self.fs.create(self.path(name), False)
        out.write(bytearray(text.encode()))
        out.close()

    def text(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def rename(self, old: str, new: str) -> None:
        if not self.fs.rename(self.path(old), self.path(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _numbers(files: _Files, kind: str) -> list[int]:
    return sorted(int(m[1]) for n in files.names("manifests") if (m := re.fullmatch(rf"(\d+)\.{kind}", n)))


def latest(spark: SparkSession, root: str, number: int | None = None) -> Manifest | None:
    """The manifest in force (or the one with ``number``), None without any."""
    files = _Files(spark, root)
    number = number if number is not None else max(_numbers(files, "json"), default=None)
    return None if number is None else Manifest.of(files.text(f"manifests/{number:010d}.json"))


def read_table(spark: SparkSession, root: str, name: str, manifest: Manifest | None = None) -> DataFrame:
    """A table of the published star, all its loads, as it was written."""
    manifest = manifest or latest(spark, root)
    if manifest is None or name not in manifest.tables:
        raise KeyError(f"{name} is not published under {root}")
    table = manifest.tables[name]
    schema = StructType.fromJson(json.loads(table.schema))
    parts = [sinks.read_parquet(spark, sinks.table_path(root, p), schema, table.partition_by) for p in table.paths]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def release(spark: SparkSession, root: str, number: int) -> None:
    """Removes the claim of a run that was killed (make sure that it was)."""
    _Files(spark, root).delete(f"manifests/{number:010d}.claim")


def publish(spark: SparkSession, root: str, build: Callable[[str, Manifest | None], Manifest]) -> Manifest:
    """Runs ``build(run folder, manifest in force)`` and publishes the manifest it
    returns (its number is set here).  Nothing is published if it fails."""
    files = _Files(spark, root)
    base = latest(spark, root)
    number = base.number + 1 if base else 1
    claim = f"manifests/{number:010d}.claim"
    try:
        files.create(claim)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            raise PublishConflict(f"manifest {number} of {root} is claimed by another run") from None
        raise
    try:
        if f"{number:010d}.json" in files.names("manifests"):      # published since it was read
            raise PublishConflict(f"manifest {number} of {root} is published")
        manifest = build(f"runs/{number:010d}-{uuid.uuid4().hex[:12]}", base)
        manifest.number = number
        draft = f"manifests/_draft-{uuid.uuid4().hex}"
        files.create(draft, manifest.json())
        files.rename(draft, f"manifests/{number:010d}.json")
        return manifest
    finally:
        files.delete(claim)


def load_star(spark: SparkSession, staged: DataFrame, spec: stars.StarSpec, root: str, append: bool = False,
              entity_src: DataFrame | None = None, rollup_src: DataFrame | None = None,
              fact_partition_by: list[str] | None = None, **layout) -> Manifest:
    """Writes a star in a run folder and publishes it.

    The star in force is extended: its flag combinations keep their surrogate
    keys and new ones continue from its high-water mark, so facts of earlier
    loads stay right.  With ``append`` its facts and dates stay and those of
    ``staged`` are added (a load by month, state, ...); otherwise ``staged`` is
    the whole table.  The other dimensions are written anew from their sources.
    The fact's content must equal the staged rows, or nothing is published."""
    def build(run: str, base: Manifest | None) -> Manifest:
        known = read_table(spark, root, spec.flag_dim_name, base) if base else None
        dates = read_table(spark, root, spec.date_dim_name, base) if base and append else None
        start = base.high_water[spec.flag_dim_name] if base else 0
        written = stars.write_star(spark, staged, spec, sinks.table_path(root, run), entity_src=entity_src,
                                   rollup_src=rollup_src, fact_partition_by=fact_partition_by, known_flags=known,
                                   first_flag_key=start, known_dates=dates, **layout)
        if written.staged_content != written.content[spec.fact_name]:
            raise ValueError(f"{spec.fact_name} does not hold the staged rows")
        tables = {}
        for name in written.paths:
            content = written.content[name]
            old = base.tables[name] if base and append and name == spec.fact_name else Table([], "", 0)
            if old.paths and old.schema != written.schemas[name].json():
                raise ValueError(f"the schema of {name} has changed; load the whole table")
            tables[name] = Table([*old.paths, f"{run}/{name}"], written.schemas[name].json(), old.rows + content.rows,
                                 written.partitions[name], [*old.content, content.text])
        fresh = tables[spec.flag_dim_name].rows - (base.tables[spec.flag_dim_name].rows if base else 0)
        return Manifest(0, run, tables, {spec.flag_dim_name: start + fresh})

    return publish(spark, root, build)


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Removes the manifests before the last ``keep`` and the run folders that
    only they name; returns these folders.  Folders that no manifest names (runs
    under way, failed runs) stay."""
    files = _Files(spark, root)
    numbers = _numbers(files, "json")
    held = [latest(spark, root, n) for n in numbers]
    used = {p.rsplit("/", 1)[0] for m in held[-keep:] for t in m.tables.values() for p in t.paths}
    gone = sorted({p.rsplit("/", 1)[0] for m in held[:-keep] for t in m.tables.values() for p in t.paths} - used)
    for m in held[:-keep]:
        files.delete(f"manifests/{m.number:010d}.json")
    for folder in gone:
        files.delete(folder)
    return gone
