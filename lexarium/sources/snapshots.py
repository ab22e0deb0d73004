"""Tables that change together, as versions of one folder.

A version is one manifest, ``_log/<number>.json``: for each table its schema and its parts, which are folders of Parquet files with
tags. A change writes new parts first and its manifest last, by a rename that fails if the number is taken; parts are never changed
once written. So a reader, who takes all tables from one manifest, sees a change whole or not at all, a run that dies between any two
steps leaves the version before it, and of two writers of one version one gets ``Conflict``. Tables and parts that a change doesn't
touch are named again, not copied. The file system's rename has to be atomic (HDFS, local disks; not plain object stores).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import sinks

LOG, DATA = "_log", "data"


class Conflict(Exception):
    """Somebody else has made the next version."""


@dataclass(frozen=True)
class Table:
    schema: str
    parts: tuple[dict, ...] = ()


@dataclass(frozen=True)
class Snapshot:
    root: str
    version: int = 0
    tables: dict[str, Table] = field(default_factory=dict)

    def parts(self, name: str) -> tuple[dict, ...]:
        return self.tables[name].parts if name in self.tables else ()

    def table(self, spark: SparkSession, name: str, parts: tuple[dict, ...] | None = None) -> DataFrame:
        """A table, or some of its parts; parts that were written by partitions can be pruned by them."""
        own = self.tables[name]
        return read_parts(spark, self.root, own.schema, own.parts if parts is None else parts)


def read_parts(spark: SparkSession, root: str, schema: str, parts: tuple[dict, ...]) -> DataFrame:
    types = T.StructType.fromJson(json.loads(schema))
    plain = [f"{root}/{p['path']}" for p in parts if not p.get("by")]
    frames = [spark.read.schema(types).parquet(*plain)] if plain else []
    for p in parts:
        if p.get("by"):
            frames.append(spark.read.schema(types).option("basePath", f"{root}/{p['path']}").parquet(f"{root}/{p['path']}").select(*types.names))
    if not frames:
        return spark.createDataFrame([], types)
    out = frames[0]
    for more in frames[1:]:
        out = out.union(more)
    return out


def _versions(spark: SparkSession, root: str) -> list[int]:
    fs, at = sinks._fs(spark, f"{root}/{LOG}")
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _manifest(root: str, version: int) -> str:
    return f"{root}/{LOG}/{version:020d}.json"


def latest(spark: SparkSession, root: str) -> Snapshot:
    """The newest version; version 0, without tables, of a folder that has none."""
    root = root.rstrip("/")
    versions = _versions(spark, root)
    return at_version(spark, root, versions[-1]) if versions else Snapshot(root)


def at_version(spark: SparkSession, root: str, version: int) -> Snapshot:
    body = sinks.read_text(spark, _manifest(root.rstrip("/"), version))
    if body is None:
        raise FileNotFoundError(f"no version {version} in {root}")
    tables = {n: Table(t["schema"], tuple(t["parts"])) for n, t in json.loads(body)["tables"].items()}
    return Snapshot(root.rstrip("/"), version, tables)


def commit(spark: SparkSession, base: Snapshot, tables: dict[str, Table]) -> Snapshot:
    """The version after base, with these tables in place of those of base; ``Conflict`` if there is one already."""
    new = Snapshot(base.root, base.version + 1, base.tables | tables)
    body = json.dumps({"version": new.version, "made_at": time.time(), "tables": {n: {"schema": t.schema, "parts": list(t.parts)} for n, t in new.tables.items()}})
    target = _manifest(base.root, new.version)
    part = f"{base.root}/{LOG}/.part-{uuid.uuid4().hex}"
    sinks.write_text(spark, part, body)
    fs, part_at = sinks._fs(spark, part)
    context = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(part_at.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(part_at), fs.makeQualified(sinks._fs(spark, target)[1]), options)
    except Exception as e:
        if sinks.exists(spark, target):
            raise Conflict(f"version {new.version} of {base.root}") from e
        raise
    finally:
        fs.delete(part_at, False)
    return new


def write_part(df: DataFrame, root: str, name: str, by: tuple[str, ...] = (), options: dict[str, str] | None = None, **tags: object) -> dict:
    """df as a new part that no version names yet."""
    path = f"{DATA}/{name}-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).partitionBy(*by).parquet(f"{root}/{path}")
    rows = read_parts(df.sparkSession, root, df.schema.json(), ({"path": path, "by": list(by)},)).count()  # from the footers
    return {"path": path, "rows": rows, "tags": tags, "by": list(by)}


def _rebased(spark: SparkSession, root: str, change: Callable[[Snapshot], dict[str, Table]], tries: int = 20) -> Snapshot:
    """Commits what change makes of the newest version, again on the next one if somebody was faster; the parts are there already."""
    for _ in range(tries):
        base = latest(spark, root)
        try:
            return commit(spark, base, change(base))
        except Conflict:
            continue
    raise Conflict(f"{tries} times in {root}")


def publish(tables: dict[str, DataFrame | None], root: str, spark: SparkSession) -> Snapshot:
    """Replaces whole tables, all in one version; None and empty tables are skipped, so that what was there stays."""
    root = root.rstrip("/")
    made: dict[str, Table] = {}
    for name, df in tables.items():
        if df is not None and (part := write_part(df, root, name))["rows"]:
            made[name] = Table(df.schema.json(), (part,))
    return _rebased(spark, root, lambda _: made) if made else latest(spark, root)


def replace_run(rows: DataFrame, root: str, name: str, run_id: str, patterns: list[str], source: str | None = None) -> Snapshot:
    """Puts rows (run_id, pattern_name, source, ...) in place of what table ``name`` had of this run and these patterns (and source), in one version.

    A part is one pattern and source of a run, so the rest of the table isn't read. A pattern without rows keeps none. Rows that are
    of another run, pattern or source are refused, null ones among them.
    """
    spark, root = rows.sparkSession, root.rstrip("/")
    keys = ["run_id", "pattern_name", "source"]
    own = (F.col("run_id") == run_id) & F.col("pattern_name").isin(*patterns) & (F.col("source") == source if source is not None else F.col("source").isNotNull())
    groups = rows.groupBy(*keys, F.coalesce(own, F.lit(False)).alias("own")).agg(F.count("*").alias("n")).collect()  # a row a pattern and source
    if other := [g for g in groups if not g["own"]]:
        raise ValueError(f"rows outside the run: {other[0]}")
    path, parts = f"{DATA}/{name}-{uuid.uuid4().hex}", []
    if groups:
        numbers = spark.createDataFrame([(*(g[k] for k in keys), i) for i, g in enumerate(groups)], "run_id string, pattern_name string, source string, part_ int")
        rows.join(F.broadcast(numbers), keys).select(*rows.columns, "part_").write.partitionBy("part_").parquet(f"{root}/{path}")
        parts = [{"path": f"{path}/part_={i}", "rows": g["n"], "tags": {k: g[k] for k in keys}, "by": []} for i, g in enumerate(groups)]

    def change(base: Snapshot) -> dict[str, Table]:
        covered = lambda t: t["run_id"] == run_id and t["pattern_name"] in patterns and (source is None or t["source"] == source)
        kept = [p for p in base.parts(name) if not covered(p["tags"])]
        return {name: Table(rows.schema.json(), (*kept, *parts))}

    return _rebased(spark, root, change)


def views(spark: SparkSession, snapshot: Snapshot, prefix: str = "") -> list[str]:
    """The tables of one version as temporary views for SQL."""
    names = [f"{prefix}{n}" for n in snapshot.tables if n.isidentifier()]
    for n in names:
        snapshot.table(spark, n[len(prefix) :]).createOrReplaceTempView(n)
    return names


def clean(spark: SparkSession, root: str, keep: int = 3, hours: float = 24) -> list[str]:
    """Deletes all but the newest ``keep`` versions, then the parts that none of these names and that are older than ``hours``, as
    younger ones may belong to a change that isn't finished. Returns the parts' paths."""
    root = root.rstrip("/")
    versions = _versions(spark, root)
    fs, data = sinks._fs(spark, f"{root}/{DATA}")
    for v in versions[: -max(keep, 1)]:
        fs.delete(sinks._fs(spark, _manifest(root, v))[1], False)
    named = {p["path"].split("/")[1] for v in versions[-max(keep, 1) :] for t in at_version(spark, root, v).tables.values() for p in t.parts}
    limit = (time.time() - hours * 3600) * 1000
    gone = []
    for s in fs.listStatus(data) if fs.exists(data) else []:
        if s.getPath().getName() not in named and s.getModificationTime() <= limit:
            fs.delete(s.getPath(), True)
            gone.append(f"{DATA}/{s.getPath().getName()}")
    return gone
