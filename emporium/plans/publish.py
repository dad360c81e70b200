"""Atomic, versioned publishing of the marts.

A publish writes every mart into a folder of its own version, checks what was
written, and only then commits.  The commit is one small file, renamed within
the output folder to the next free number; readers take the version that the
highest number names.  So they see all marts of one version or all of another:
a publish that fails or is killed half way changes nothing for them, and can
simply run again.  A rename to a number that is taken fails, so of two
publishers that started from the same version one commits and one raises
``CommitConflict``.

    <out>/versions/<version>/<mart>/part-*.parquet
    <out>/commits/00000007.json        {"version": ..., "tables": {mart: table}}

With ``bucket_facts`` both facts are catalog tables of ``database``, named after
mart and version, and the commit says which; ``drop_versions`` removes them
with the files.  A bucketed join cannot be split at runtime, so lines of hot
orders (more lines than a mean bucket) are written to an unbucketed slice next
to the bucketed one; both are read as one table, or joined slice by slice
(``Published.slices``, ``operators.joins.join_slices``).  All paths go through
Hadoop's file systems.

Checks come with the writing: each mart is written under an ``Observation`` that
counts its rows, its nulls per ``not_null`` column, its values outside an
accepted list and its negative totals, so these checks need no further scan.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Collection, Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from emporium.operators import checks as C
from emporium.operators.joins import hot_keys, split_hot
from emporium.plans.project import MARTS, guard_lookup_fanout
from emporium.plans.suite import ACCEPTED, NOT_NULL, SUITE, Check, run_suite
from emporium.sources import footers

ORPHANS, NEGATIVE = "assert_no_orphaned_order_items", "assert_no_negative_payment_amounts"
AMOUNT = "total_paid_amount"
LINES = "fct_order_items"  # the one mart in which an order may have many rows
HOT = "__hot"


class CommitConflict(RuntimeError):
    """Another publisher committed since this one looked."""


class ChecksFailed(ValueError):
    """Staged marts fail checks that must pass; nothing was committed."""


class Published(Mapping):
    """The marts of one committed version, each read when it is asked for."""

    def __init__(self, spark: SparkSession, out_dir: str, number: int, record: dict):
        self.number, self.version, self.tables = number, record["version"], record["tables"]
        self.hot = record.get("hot", [])
        self._spark, self._out_dir = spark, out_dir

    def __getitem__(self, name: str) -> DataFrame:
        rows, hot = self.slices(name)
        return rows if hot is None else rows.unionByName(hot)

    def slices(self, name: str) -> tuple[DataFrame, DataFrame | None]:
        """The mart without its hot orders, and these (None: there are none)."""
        table = self.tables[name]
        rows = self._spark.table(table) if table else self._spark.read.parquet(self.path(name))
        return rows, self._spark.read.parquet(self.path(name) + HOT) if name in self.hot else None

    def path(self, name: str) -> str:
        return f"{version_dir(self._out_dir, self.version)}/{name}"

    def __iter__(self) -> Iterator[str]:
        return iter(self.tables)

    def __len__(self) -> int:
        return len(self.tables)


@dataclass(frozen=True)
class Staged:
    """Marts written but not committed: readers, and the failures per check (or
    assertion) that were counted while writing."""

    version: str
    tables: dict[str, str | None]
    marts: dict[str, DataFrame]
    rows: dict[str, int]
    failures: dict[str, int] = field(default_factory=dict)
    hot: list[str] = field(default_factory=list)


def version_dir(out_dir: str, version: str) -> str:
    return f"{out_dir.rstrip('/')}/versions/{version}"


def _commits(out_dir: str) -> str:
    return f"{out_dir.rstrip('/')}/commits"


def _path(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    path, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def commit_numbers(spark: SparkSession, out_dir: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in _names(spark, _commits(out_dir)) if n.endswith(".json") and not n.startswith((".", "_"))]


def _record(spark: SparkSession, out_dir: str, number: int) -> dict:
    path, fs = _path(spark, f"{_commits(out_dir)}/{number:08d}.json")
    stream = fs.open(path)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def published(spark: SparkSession, out_dir: str) -> Published | None:
    """The marts of the last commit; None before the first one."""
    numbers = commit_numbers(spark, out_dir)
    return Published(spark, out_dir, numbers[-1], _record(spark, out_dir, numbers[-1])) if numbers else None


def commit(spark: SparkSession, out_dir: str, staged: Staged, after: int) -> Published:
    """Make the staged version the current one, if commit ``after`` (0: none) still is the last."""
    record = {"version": staged.version, "tables": staged.tables, "rows": staged.rows, "hot": staged.hot}
    jvm = spark.sparkContext._jvm
    target = f"{_commits(out_dir)}/{after + 1:08d}.json"
    draft, fs = _path(spark, f"{_commits(out_dir)}/.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(record), "utf-8"))
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    # an empty array of options: never replace a commit that is there
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(draft, _path(spark, target)[0], options)
    except Exception as failed:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(failed):
            raise CommitConflict(f"commit {after + 1} of {out_dir} exists") from None
        raise
    return Published(spark, out_dir, after + 1, record)


def _measures(name: str) -> dict:
    """What is counted while mart ``name`` is written: check id -> aggregate."""
    out = {"rows": F.count(F.lit(1))}
    for ch in (ch for ch in SUITE if ch.model == name):
        column = F.col(ch.columns[0])
        if ch.kind == NOT_NULL:
            out[ch.check_id] = F.count_if(column.isNull())
        elif ch.kind == ACCEPTED:
            out[ch.check_id] = F.count_if(column.isNotNull() & ~column.isin(list(ch.values)))
    if name == "fct_orders":
        out[NEGATIVE] = F.count_if(F.col(AMOUNT) < 0)
    return out


def stage(
    spark: SparkSession,
    models: Mapping[str, DataFrame],
    out_dir: str,
    bucket_facts: int | None = None,
    database: str | None = None,
) -> Staged:
    """Write all marts as a new version, observed; nothing a reader sees changes.

    The fan-out guard (M5) runs first.  Facts are bucketed as by
    ``publish_marts``."""
    if bucket_facts and not database:
        raise ValueError("bucketed facts are catalog tables: name their database")
    guard_lookup_fanout(models["stg_product_category_translation"])
    version = uuid.uuid4().hex
    staged = Staged(version, {}, {}, {})
    accepted = {ch.check_id for ch in SUITE if ch.kind == ACCEPTED}
    for name in MARTS:
        path, bucketed = f"{version_dir(out_dir, version)}/{name}", bucket_facts and name.startswith("fct_")
        df, slices = models[name], {"": models[name]}
        keys = hot_keys(df, "order_id", bucket_facts) if bucketed and name == LINES else []
        if keys:
            slices[""], slices[HOT] = split_hot(df, "order_id", keys)
            staged.hot.append(name)
        counted: Counter = Counter()
        for suffix, rows in slices.items():
            seen, measures = Observation(f"{name}{suffix}-{version}"), _measures(name)
            if bucketed and not suffix:
                rows = rows.repartition(bucket_facts, "order_id")
            # last before the writer, so that each row is counted by the task that writes it
            writer = rows.observe(seen, *(m.alias(k) for k, m in measures.items())).write
            if bucketed and not suffix:
                table = f"{database}.{name}_{version}"
                writer.format("parquet").option("path", path).bucketBy(bucket_facts, "order_id").sortBy("order_id").saveAsTable(table)
                staged.tables[name], staged.marts[name] = table, spark.table(table)
            else:
                writer.parquet(path + suffix)
                own = spark.read.parquet(path + suffix)
                staged.tables.setdefault(name, None)
                staged.marts[name] = staged.marts[name].unionByName(own) if suffix else own
            counted.update(seen.get)
        staged.rows[name] = counted.pop("rows")
        # distinct bad values are not known from a count of rows, unless there are none
        staged.failures.update({k: n for k, n in counted.items() if k not in accepted or n == 0})
    return staged


def assertions(staged: Staged) -> DataFrame:
    """L1 and L2 on the staged marts, as rows of the suite's results."""
    orphans = C.orphaned_order_items(staged.marts["fct_order_items"], staged.marts["fct_orders"])
    counted = orphans.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(ORPHANS).alias("check_id"), F.lit("fct_order_items").alias("model"), F.lit("order_id").alias("columns"), "failures")
    seen = staged.marts["fct_orders"].sparkSession.createDataFrame([(NEGATIVE, "fct_orders", AMOUNT, staged.failures[NEGATIVE])], "check_id string, model string, columns string, failures long")
    both = counted.unionByName(seen)
    return both.select("check_id", "model", F.lit("assertion").alias("kind"), "columns", "failures", (F.col("failures") == 0).alias("passed"))


def check_staged(staged: Staged, models: Mapping[str, DataFrame], suite: tuple[Check, ...] = SUITE) -> DataFrame:
    """The whole suite: marts as staged, other models as lazy plans; what was
    observed while writing is not scanned again."""
    return run_suite({name: staged.marts.get(name, models[name]) for name in models}, suite, staged.failures)


def publish(
    spark: SparkSession,
    models: Mapping[str, DataFrame],
    out_dir: str,
    blocking: Collection[str] | None = None,
    bucket_facts: int | None = None,
    database: str | None = None,
) -> tuple[Published, DataFrame]:
    """Stage, check, commit: the published marts and the results of all checks
    (53 checks, 2 assertions).

    ``blocking`` names the checks that must pass before the commit; None: all.
    A failing one raises ``ChecksFailed`` and leaves the last version current."""
    numbers = commit_numbers(spark, out_dir)
    staged = stage(spark, models, out_dir, bucket_facts, database)
    results = check_staged(staged, models).unionByName(assertions(staged))
    rows = results.collect()  # one row per declared check
    failed = sorted(r["check_id"] for r in rows if not r["passed"] and (blocking is None or r["check_id"] in blocking))
    if failed:
        raise ChecksFailed(f"version {staged.version} of {out_dir} was not committed: {', '.join(failed)}")
    done = commit(spark, out_dir, staged, numbers[-1] if numbers else 0)
    return done, spark.createDataFrame(rows, results.schema)


def null_profile(spark: SparkSession, marts: Published) -> DataFrame:
    """Nulls and rows of every column of the published marts, from the footers of
    their files: no column is read (``sources.footers``).  A slice of hot orders
    is a table of its own here."""
    schemas = {name: df.schema for name, df in marts.items()}
    paths = {name: marts.path(name) for name in marts}
    paths |= {name + HOT: marts.path(name) + HOT for name in marts.hot}
    return footers.null_profiles(spark, paths, schemas | {name + HOT: schemas[name] for name in marts.hot})


def drop_versions(spark: SparkSession, out_dir: str, keep: int = 2, unfinished: bool = False) -> list[str]:
    """Delete committed versions but the last ``keep``; with ``unfinished`` also
    those that no commit names (only when no publish is running).  Their commit
    files stay, as the numbers go on from them.  Returns the versions deleted."""
    if keep < 1:
        raise ValueError("the last version is what readers see")
    records = [_record(spark, out_dir, n) for n in commit_numbers(spark, out_dir)]
    kept = {r["version"] for r in records[-keep:]}
    tables = {r["version"]: [t for t in r["tables"].values() if t] for r in records}
    gone = []
    for version in _names(spark, f"{out_dir.rstrip('/')}/versions"):
        if version not in kept and (unfinished or version in tables):
            for table in tables.get(version, []):
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            path, fs = _path(spark, version_dir(out_dir, version))
            fs.delete(path, True)
            gone.append(version)
    return gone
