"""Files copied, unpacked, archived and restored, with an append-only ledger of every move.

A run first appends what it plans to the ledger, then tasks copy the files as streams of bytes and their results are
appended: source, target, size, SHA-256 and state. Archiving removes a live file only after its copy was read back and has
the bytes the ledger says. All steps can be repeated: a copy appears whole, a copy that is there already with the same
bytes is `present`, one with other bytes `differs` and is neither overwritten nor counted as a copy. So a run that stopped
is finished by running it again, or by `resume` from the ledger alone; the run's name is the caller's, no clock is read.

States: planned, then copied, present, differs or missing, and removed for archived files. File names pass through Spark
frames; the driver sees none of them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import names
from tablewright.operators import layout
from tablewright.sources import files, stores

LEDGER = "run string, action string, source string, target string, size long, sha256 string, state string, step int"
#: Order of the states inside a run.
PLANNED, COPIED, REMOVED = range(3)
_FIELDS = [f.split()[0] for f in LEDGER.split(", ")]


def ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path)


def states(spark: SparkSession, path: str) -> DataFrame:
    """The last state of every move, by run and step."""
    last = F.max_by(F.struct("run", "size", "sha256", "state", "step"), F.struct("run", "step")).alias("last")
    return ledger(spark, path).groupBy("action", "source", "target").agg(last).select("action", "source", "target", "last.*")


def unfinished(spark: SparkSession, path: str) -> DataFrame:
    """Moves that a run planned and did not finish."""
    state, archived = F.col("state"), F.col("action") == "archive"
    return states(spark, path).where((state == "planned") | archived & state.isin("copied", "present"))


def _append(rows: DataFrame, path: str) -> None:
    rows.select(*_FIELDS).write.mode("append").parquet(path)


def _stream(spark: SparkSession, rows: DataFrame, work) -> DataFrame:
    """Apply `work` to the rows in tasks. Their number is given, since rows are small whatever the files they name."""
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "source").mapInPandas(work, LEDGER)


def _copy(frames):
    import pandas as pd

    for frame in frames:
        out = []
        for run, action, source, target in zip(frame["run"], frame["action"], frame["source"], frame["target"]):
            size, sha, state = None, None, "missing"
            here = stores.exists(source)
            if stores.exists(target):
                size, sha = stores.digest(target)
                state = "differs" if here and stores.digest(source) != (size, sha) else "present"
            elif here:
                size, sha = stores.join([source], target)
                state = "copied"
            out.append((run, action, source, target, size, sha, state, COPIED))
        yield pd.DataFrame(out, columns=_FIELDS).astype({"size": "Int64"})


def _unpack(frames):
    """The members of each archive as files below the target folder, one ledger row per member."""
    import zipfile

    import pandas as pd

    for frame in frames:
        for run, action, source, target in zip(frame["run"], frame["action"], frame["source"], frame["target"]):
            out, (store, inner) = [], stores.located(source)
            with store.open_input_file(inner) as raw, zipfile.ZipFile(raw) as archive:
                for info in archive.infolist():
                    if info.is_dir():
                        continue
                    place = member_target(target, info.filename)
                    state, (size, sha) = stores.put(archive, info, place)
                    out.append((run, action, f"{source}!{info.filename}", place, size, sha, state, COPIED))
            yield pd.DataFrame(out, columns=_FIELDS).astype({"size": "Int64"})


def member_target(folder: str, member: str) -> str:
    """table=/date=/file of a member, as `landing` has it for a file."""
    table, _, file = member.rsplit("/", 1)[-1].partition(".")
    day = file.split("_", 1)[0].rsplit(".", 1)[-1].replace("-", "")
    return f"{folder.rstrip('/')}/table={table}/date={day}/{file}"


def _remove(frames):
    import pandas as pd

    for frame in frames:
        out = []
        for row in frame.itertuples(index=False):
            if stores.exists(row.target) and stores.digest(row.target)[1] == row.sha256:
                stores.remove(row.source)
                out.append((row.run, row.action, row.source, row.target, row.size, row.sha256, "removed", REMOVED))
        yield pd.DataFrame(out, columns=_FIELDS).astype({"size": "Int64"})


def _run(spark: SparkSession, planned: DataFrame, path: str, run: str, action: str) -> DataFrame:
    """Plan, copy, and for the archive remove. Returns the ledger's rows of this run and action."""
    plan = planned.select(F.lit(run).alias("run"), F.lit(action).alias("action"), "source", "target", F.lit(None).cast("long").alias("size"),
                          F.lit(None).cast("string").alias("sha256"), F.lit("planned").alias("state"), F.lit(PLANNED).alias("step"))
    _append(plan, path)
    return _execute(spark, path, run, action)


def _execute(spark: SparkSession, path: str, run: str, action: str) -> DataFrame:
    def mine() -> DataFrame:  # read anew each time: a frame keeps the list of files it was made with
        return ledger(spark, path).where((F.col("run") == run) & (F.col("action") == action))

    planned = mine().where(F.col("step") == PLANNED).dropDuplicates(["source", "target"])
    _append(_stream(spark, planned, _unpack if action == "unpack" else _copy), path)
    if action == "archive":
        copied = mine().where((F.col("step") == COPIED) & F.col("state").isin("copied", "present"))
        _append(_stream(spark, copied.dropDuplicates(["source", "target"]), _remove), path)
    return mine()


def resume(spark: SparkSession, path: str, run: str) -> None:
    """Do what a stopped run had planned. What it did already is found done."""
    actions = ledger(spark, path).where((F.col("run") == run) & (F.col("step") == PLANNED)).select("action").distinct()
    for row in actions.collect():  # at most one per kind of move
        _execute(spark, path, run, row.action)


def landing(name: Column, folder: str) -> Column:
    """table=/date=/file, as the file's name says."""
    return F.concat(F.lit(folder.rstrip("/") + "/"), names.hive_path(names.file_part(name), table=names.table_part(name), date=names.save_date(name)))


def copy_files(spark: SparkSession, listed: DataFrame, path: str, run: str) -> DataFrame:
    """Copy the files that a frame (source, target) names."""
    return _run(spark, listed, path, run, "copy")


def copy_new(spark: SparkSession, source: str, target: str, path: str, run: str, since: date | None = None) -> DataFrame:
    """Copy the files of a source (zip archives aside) to table=/date=/ folders; those copied before are left as they are.

    With `since`, only files modified at or after the day before.
    """
    listed = files.inventory(spark, source).where(~F.endswith("name", F.lit(".zip")))
    listed = files.recent(listed, since) if since else listed
    return copy_files(spark, listed.select(F.col("path").alias("source"), landing(F.col("name"), target).alias("target")), path, run)


def unpack_new(spark: SparkSession, source: str, target: str, path: str, run: str, since: date | None = None) -> DataFrame:
    """The members of a source's zip archives as files in table=/date=/ folders."""
    listed = files.inventory(spark, source, glob="*.zip")
    listed = files.recent(listed, since) if since else listed
    return unpack_files(spark, listed.select(F.col("path").alias("source"), F.lit(target).alias("target")), path, run)


def unpack_files(spark: SparkSession, listed: DataFrame, path: str, run: str) -> DataFrame:
    """Unpack the archives that a frame (source, target folder) names."""
    return _run(spark, listed, path, run, "unpack")


def archive_old(spark: SparkSession, live: str, archived: str, path: str, run: str, as_of: date, days_old: int = 30,
                by_modified: bool = False) -> DataFrame:
    """Move live files older than `days_old` days to date=YYYYMM/ folders, by the date in the name or the time of change."""
    listed = layout.split_by_age(files.inventory(spark, live), as_of, days_old, "name", "last_modified" if by_modified else None)
    target = F.concat(F.lit(archived.rstrip("/") + "/"), "folder", F.lit("/"), "name")
    old = listed.where(F.col("action") == "archive").select(F.col("path").alias("source"), target.alias("target"))
    return _run(spark, old, path, run, "archive")


def restore_all(spark: SparkSession, archived: str, live: str, path: str, run: str) -> DataFrame:
    """Copy archived .zip and .csv files back to the live folder. The archive keeps them."""
    listed = files.inventory(spark, archived).where(F.endswith("name", F.lit(".zip")) | F.endswith("name", F.lit(".csv")))
    return _run(spark, listed.select(F.col("path").alias("source"), F.concat(F.lit(live.rstrip("/") + "/"), "name").alias("target")),
                path, run, "restore")
