"""Publication of a job's outputs as one commit.

Every write goes to new version folders inside the table (``<table>/year=2025/month=5/commit_version=<id>``)
that nothing reads yet. A job's commit is one numbered file that names, for every table of the lake, the
version folders that are live, with their rows and an order-free checksum. It is written last, in one
atomic step that fails when the number is taken, so readers see all outputs of a job or none, no
live file is ever moved or overwritten, and a killed job leaves only folders that nobody reads.

A table is read by its live folders in one scan, so partitions and columns are pruned as usual.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.config import LakePaths
from lakerisk.sources.writers import PublishError

VERSION = "commit_version"
_NUMBERED = re.compile(r"(\d{12})\.json")
_ESCAPED = re.compile(r'["#%\'*/:=?\\\x7f{\[\]^\x00-\x1f]')
RETRIES = 20


def _hadoop(spark: SparkSession, path: str):
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    return fs, fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, paths: LakePaths) -> list[int]:
    hadoop, files = _hadoop(spark, paths.commits)
    folder = hadoop.Path(paths.commits)
    if not files.exists(folder):
        return []
    names = (_NUMBERED.fullmatch(s.getPath().getName()) for s in files.listStatus(folder))
    return sorted(int(m[1]) for m in names if m)


def _load(spark: SparkSession, paths: LakePaths, number: int) -> dict:
    return json.loads(spark.read.text(f"{paths.commits}/{number:012d}.json", wholetext=True).first()[0])


def latest(spark: SparkSession, paths: LakePaths) -> dict:
    """The newest commit; an empty lake is commit 0 without tables."""
    numbers = _numbers(spark, paths)
    return _load(spark, paths, numbers[-1]) if numbers else {"number": 0, "tables": {}}


def read_table(spark: SparkSession, paths: LakePaths, layer: str, name: str, commit: dict | None = None) -> DataFrame | None:
    """A live table, or None when no commit has it. `commit` reads an older state."""
    entry = (commit or latest(spark, paths))["tables"].get(f"{layer}/{name}")
    return None if entry is None else _scan(spark, entry, entry["parts"])


def require_table(spark: SparkSession, paths: LakePaths, layer: str, name: str) -> DataFrame:
    table = read_table(spark, paths, layer, name)
    if table is None:
        raise PublishError(f"no commit of {paths.commits} has the table {layer}/{name}")
    return table


def live_rows(spark: SparkSession, paths: LakePaths, layer: str, name: str) -> int:
    """Rows of a live table, from the commit; no scan."""
    entry = latest(spark, paths)["tables"].get(f"{layer}/{name}", {"parts": {}})
    return sum(p["rows"] for p in entry["parts"].values())


def _scan(spark: SparkSession, entry: dict, parts: dict) -> DataFrame:
    schema = T.StructType.fromJson(entry["schema"])
    if not parts:
        return spark.createDataFrame([], schema)
    folders = ["/".join([entry["path"], *filter(None, [at]), f"{VERSION}={p['version']}"]) for at, p in sorted(parts.items())]
    return spark.read.schema(schema).option("basePath", entry["path"]).parquet(*folders).select(*schema.names)


def _partition_name(values: Sequence, by: Sequence[str]) -> str:
    """``year=2025/month=5`` as Spark names the folder."""
    text = lambda v: "__HIVE_DEFAULT_PARTITION__" if v is None else _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", str(v))
    return "/".join(f"{c}={text(v)}" for c, v in zip(by, values))


def schema_columns(entry: dict) -> list[Column]:
    """The columns of a table as a hash takes them; a map has no hash, so its JSON stands for it."""
    fields = T.StructType.fromJson(entry["schema"]).fields
    return [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in fields]


def _checksum(columns: Iterable[Column]) -> Column:
    """Order-free: a sum of row hashes below 2^31.

    Their upper and lower bits are summed apart, as longs that 2^47 rows cannot overflow: a sum of wide
    decimals makes new numbers for every row.
    """
    row = F.pmod(F.xxhash64(*columns), F.lit(1 << 31))
    upper, lower = F.sum(F.shiftright(row, 16)), F.sum(row.bitwiseAND(F.lit((1 << 16) - 1)))
    return F.coalesce(upper.cast("decimal(38,0)") * (1 << 16) + lower, F.lit(0)).cast("string")


@dataclass
class Staged:
    """One table as a job wants it: its new parts, and which old ones they replace."""

    entry: dict
    replaced: set[str] | None  # None: all
    observed: dict = field(default_factory=dict)


class Publication:
    """The outputs of one job. Use as a context: leaving it without an error commits, an error leaves the lake as it was."""

    def __init__(self, spark: SparkSession, paths: LakePaths, job: str) -> None:
        self.spark, self.paths, self.job = spark, paths, job
        self.base = latest(spark, paths)
        self.version = uuid.uuid4().hex
        self.staged: dict[str, Staged] = {}
        self.number: int | None = None

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.commit()

    def read(self, layer: str, name: str) -> DataFrame | None:
        """The table as this job found it."""
        return read_table(self.spark, self.paths, layer, name, self.base)

    def stage(self, layer: str, name: str, rows: DataFrame, by: Sequence[str] = (), replaces: Iterable[Sequence] | None = None, metrics: dict | None = None, single_file: bool = False) -> DataFrame:
        """Write rows to new version folders and verify them; returns them as read back.

        `replaces` lists the partition values whose old rows go, whether or not new ones came for them
        (None: the whole table is replaced). Row count, checksum and `metrics` (name -> aggregate
        column) are observed while the rows are written, so a gate needs no second scan: see `observed`.
        """
        key, path = f"{layer}/{name}", self.paths.table(layer, name)
        columns = [c for c in rows.columns if c not in by]
        schema = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in (*columns, *by)])
        entry = {"path": path, "by": list(by), "schema": schema.jsonValue(), "parts": {}}
        observation = Observation()
        watched = rows.observe(
            observation, F.count(F.lit(1)).alias("_rows"), _checksum(schema_columns(entry)).alias("_checksum"), *[m.alias(n) for n, m in (metrics or {}).items()]
        )
        out = watched.select(*columns, *by).withColumn(VERSION, F.lit(self.version))
        (out.coalesce(1) if single_file else out).write.mode("append").partitionBy(*by, VERSION).parquet(path)
        seen = observation.get
        found = self._written(entry, path, by)
        total = sum(p["rows"] for p in found.values())
        checksum = str(sum(int(p["checksum"]) for p in found.values()))
        if (total, checksum) != (seen["_rows"], seen["_checksum"]):
            raise PublishError(f"{key}: {seen['_rows']} rows were written, {total} are read back, or their values differ")
        entry["parts"] = found
        gone = None if replaces is None else {_partition_name(v, by) for v in replaces} | set(found)
        self.staged[key] = Staged(entry, gone, {k: v for k, v in seen.items() if not k.startswith("_")} | {"rows": total})
        return _scan(self.spark, entry, found)

    def _written(self, entry: dict, path: str, by: Sequence[str]) -> dict:
        """Rows and checksum of each partition this version wrote; at most one row per partition comes back."""
        hadoop, files = _hadoop(self.spark, path)
        hits = files.globStatus(hadoop.Path("/".join([path, *(f"{c}=*" for c in by), f"{VERSION}={self.version}"])))
        names = [s.getPath().getParent() for s in hits or []]
        parts = {"/".join(_tail(p, len(by))): {"version": self.version} for p in names}
        if not parts:
            return {}
        counted = _scan(self.spark, entry, parts).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), _checksum(schema_columns(entry)).alias("sum"))
        return {_partition_name(r[: len(by)], by): {"version": self.version, "rows": r["n"], "checksum": r["sum"]} for r in counted.collect() if r["n"]}

    def observed(self, layer: str, name: str) -> dict:
        """What was observed while a staged table was written."""
        return self.staged[f"{layer}/{name}"].observed

    def part_rows(self, layer: str, name: str) -> dict[str, int]:
        """Rows of every part of a staged table, as read back."""
        return {at: p["rows"] for at, p in self.staged[f"{layer}/{name}"].entry["parts"].items()}

    def commit(self) -> int:
        """Make all staged tables live in one step; returns the commit's number.

        When another job has committed meanwhile, its tables are kept; if it changed one of ours, this
        commit fails and the lake stays as that job left it.
        """
        for _ in range(RETRIES):
            head = latest(self.spark, self.paths)
            for key in self.staged:
                if head["tables"].get(key) != self.base["tables"].get(key):
                    raise PublishError(f"{key} was changed by commit {head['number']} while {self.job} ran")
            tables = dict(head["tables"])
            for key, staged in self.staged.items():
                old = {} if staged.replaced is None or key not in tables else tables[key]["parts"]
                kept = {} if staged.replaced is None else {at: p for at, p in old.items() if at not in staged.replaced}
                if kept and tables[key]["by"] != staged.entry["by"]:
                    raise PublishError(f"{key} changes its partition columns; replace the whole table")
                tables[key] = staged.entry | {"parts": kept | staged.entry["parts"]}
            number = head["number"] + 1
            if self._claim(number, {"number": number, "job": self.job, "time": int(time.time()), "tables": tables}):
                self.number = number
                return number
        raise PublishError(f"{self.job} could not commit: other jobs took {RETRIES} numbers")

    def _claim(self, number: int, body: dict) -> bool:
        """Write the file of a number; False when it is taken. The rename fails rather than overwrites."""
        jvm, context = self.spark.sparkContext._jvm, self.spark.sparkContext
        hadoop, files = _hadoop(self.spark, self.paths.commits)
        draft = hadoop.Path(f"{self.paths.commits}/_draft-{uuid.uuid4().hex}")
        stream = files.create(draft, False)
        stream.write(bytearray(json.dumps(body), "utf-8"))
        stream.close()
        target = hadoop.Path(f"{self.paths.commits}/{number:012d}.json")
        whole = files.makeQualified(draft)
        renames = jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), context._jsc.hadoopConfiguration())
        options = context._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            renames.rename(whole, files.makeQualified(target), options)
            return True
        except Exception as error:
            files.delete(draft, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise


def _tail(path, count: int) -> list[str]:
    """The last `count` names of a Hadoop path, outermost first."""
    out = []
    for _ in range(count):
        out.append(path.getName())
        path = path.getParent()
    return out[::-1]


def parts_table(spark: SparkSession, paths: LakePaths, layer: str, name: str) -> DataFrame:
    """One row per live partition of a table: where it is, its rows and its checksum."""
    entry = latest(spark, paths)["tables"].get(f"{layer}/{name}", {"parts": {}})
    rows = [(at, p["version"], p["rows"], p["checksum"]) for at, p in sorted(entry["parts"].items())]
    return spark.createDataFrame(rows, "part string, version string, rows long, checksum string")


def vacuum(spark: SparkSession, paths: LakePaths, keep: int = 10, older_than_seconds: int = 7 * 24 * 3600) -> int:
    """Remove version folders that none of the last `keep` commits names and that are older than a running job can be.

    Returns the number of folders removed. Older commit files go as well.
    """
    numbers = _numbers(spark, paths)
    states = [_load(spark, paths, n) for n in numbers[-keep:]]
    named: dict[str, set[tuple[str, str]]] = {}
    depth: dict[str, int] = {}
    for state in states:
        for entry in state["tables"].values():
            depth[entry["path"]] = len(entry["by"])
            named.setdefault(entry["path"], set()).update((at, p["version"]) for at, p in entry["parts"].items())
    removed = 0
    limit = (time.time() - older_than_seconds) * 1000
    for path, live in named.items():
        hadoop, files = _hadoop(spark, path)
        for status in files.globStatus(hadoop.Path("/".join([path, *["*=*"] * depth[path], f"{VERSION}=*"]))) or []:
            folder = status.getPath()
            at, version = "/".join(_tail(folder.getParent(), depth[path])), folder.getName().removeprefix(f"{VERSION}=")
            if (at, version) not in live and status.getModificationTime() <= limit:
                removed += bool(files.delete(folder, True))
    hadoop, files = _hadoop(spark, paths.commits)
    for number in numbers[:-keep]:
        files.delete(hadoop.Path(f"{paths.commits}/{number:012d}.json"), False)
    return removed
