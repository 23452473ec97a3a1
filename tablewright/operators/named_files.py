"""Delimited files under names of the caller's choice, all of a run or none.

Spark names its part files itself. Here rows carry the name of their file, and a run goes through three steps:

1. Tasks write pieces, one per file name and task, to a staging folder; what the committed attempts wrote is handed over
   as commit messages and listed. A hot file has several pieces, from as many tasks. If a task fails, nothing else happens.
2. Pieces of one file are joined, one task per file, as a copy of bytes. The list of whole files is the commit: it is
   written in one Spark job and is either there or not.
3. Whole files are moved to their names. `recover` repeats this step for runs that stopped after the commit, and
   removes what runs that stopped before it left behind. Moves can be repeated, so lost executors do no harm.

Staging is below `_staging` in the target folder, which readers pass over, so moves stay inside one store. A reader never
sees a file in part. Two runs that write one name at a time are not coordinated: the later move stays.
"""

from __future__ import annotations

import csv
import hashlib
import io
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tablewright.functions import names
from tablewright.sources import stores
from tablewright.sources.delimited import TEXT_OPTIONS

STAGING = "_staging"
_PIECES = "name string, part int, piece string, rows long"
_WHOLE = "name string, whole string, rows long, size long, sha256 string, overwrite boolean"
_REPORT = "name string, state string, rows long, size long, sha256 string"


@dataclass
class Pieces(WriterCommitMessage):
    """What a task has written: name, partition, path and rows of every piece."""

    pieces: list[tuple[str, int, str, int]] = field(default_factory=list)


class PieceWriter(DataSourceArrowWriter):
    """Writes lines, sorted by file name, to one piece per name."""

    def __init__(self, folder: str, header: str) -> None:
        self.folder, self.header = folder, header

    def write(self, iterator):
        from pyspark import TaskContext

        task, done, out, rows, name = TaskContext.get(), Pieces(), None, 0, None
        store, root = stores.located(self.folder)
        store.create_dir(f"{root}/pieces", recursive=True)

        def finished():
            if out:
                out.close()
                done.pieces[-1] = (*done.pieces[-1][:3], rows)

        for batch in iterator:
            for line_name, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if line_name != name:
                    finished()
                    name, rows = line_name, 0
                    piece = f"pieces/{task.partitionId()}-{task.taskAttemptId()}-{len(done.pieces)}"
                    out = store.open_output_stream(f"{root}/{piece}")
                    out.write(self.header.encode())
                    done.pieces.append((name, task.partitionId(), piece, 0))
                out.write(f"{line}\n".encode())
                rows += 1
        finished()
        return done

    def commit(self, messages):
        store, root = stores.located(self.folder)
        store.create_dir(root, recursive=True)
        fresh = f"{root}/_pieces.json"
        with store.open_output_stream(fresh) as out:
            for message in messages:
                for name, part, piece, rows in message.pieces:
                    out.write((json.dumps({"name": name, "part": part, "piece": piece, "rows": rows}) + "\n").encode())
        store.move(fresh, f"{root}/pieces.json")

    def abort(self, messages):
        stores.remove_folder(self.folder)


class PieceSink(DataSource):
    """The staging of a run as a sink: options path and header."""

    @classmethod
    def name(cls):
        return "named_file_pieces"

    def writer(self, schema, overwrite):
        return PieceWriter(self.options["path"], self.options["header"])


def header_line(columns: list[str], sep: str) -> str:
    text = io.StringIO()
    csv.writer(text, delimiter=sep, lineterminator="\n").writerow(columns)
    return text.getvalue()


def write_named(df: DataFrame, folder: str, name: Column, columns: list[str] | None = None, sep: str = ",",
                overwrite: bool = False, order: list[Column] | None = None, **layers: Column) -> DataFrame:
    """Write each row to the file `name` says, below k=v folders of the layers. Returns what became of every file.

    The report has name (with its folders), state (written, or kept for a file that was there and is not to be overwritten),
    rows, size and sha256. With `order` the rows of a file are in that order, whatever its size. A row whose name is
    null, empty or leads out of the folder stops the run, which then leaves no file. No rows, no files.
    """
    spark, columns = df.sparkSession, columns or df.columns
    staging = f"{folder.rstrip('/')}/{STAGING}/{uuid.uuid4().hex}"
    target = names.hive_path(name, **layers)
    bad = name.isNull() | (name == "") | target.rlike(r"(^|/)\.*(/|$)") | F.startswith(target, F.lit("_"))
    checked = F.when(bad, F.raise_error(F.concat(F.lit("no name for a file: "), F.coalesce(target, F.lit("NULL")))).cast("string")).otherwise(target)
    options = {k: v for k, v in TEXT_OPTIONS.items() if k != "header"}
    line = F.to_csv(F.struct(*columns), {**options, "sep": sep})
    rows = df.withColumn("__file", checked)
    rows = rows.repartitionByRange("__file", *order) if order else rows.hint("rebalance", "__file")
    spark.dataSource.register(PieceSink)
    header = header_line(columns, sep)
    (rows.sortWithinPartitions("__file", *(order or [])).select("__file", line.alias("line"))
     .write.format(PieceSink.name()).mode("append").options(path=staging, header=header).save())
    _assemble(spark, staging, len(header.encode()), overwrite)
    return _publish(spark, folder, staging)


def _assemble(spark: SparkSession, staging: str, header: int, overwrite: bool) -> None:
    """Join the pieces of every file; the list of the joined files commits the run."""
    def joined(frames):
        import pandas as pd

        for frame in frames:
            out = []
            for name, pieces in zip(frame["name"], frame["pieces"]):
                whole = f"whole/{hashlib.md5(name.encode()).hexdigest()}"
                size, sha = stores.join([f"{staging}/{p['piece']}" for p in pieces], f"{staging}/{whole}", header)
                out.append((name, whole, sum(p["rows"] for p in pieces), size, sha, overwrite))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in _WHOLE.split(", ")])

    listed = spark.read.schema(_PIECES).json(f"{staging}/pieces.json")
    files = listed.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("part", "piece", "rows"))).alias("pieces"))
    files.mapInPandas(joined, _WHOLE).write.parquet(f"{staging}/ready")


def _publish(spark: SparkSession, folder: str, staging: str) -> DataFrame:
    """Move the whole files of a committed run to their names. Safe to repeat."""
    root = folder.rstrip("/")

    def moved(frames):
        import pandas as pd

        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                target, whole = f"{root}/{row.name}", f"{staging}/{row.whole}"
                state = "written"
                if stores.exists(whole):
                    if stores.exists(target) and not row.overwrite and stores.digest(target)[1] != row.sha256:
                        state = "kept"
                    else:
                        try:
                            stores.move(whole, target)
                        except FileNotFoundError:  # another attempt of this task moved it
                            state = "written" if stores.exists(target) else "lost"
                elif not stores.exists(target) or stores.digest(target)[1] != row.sha256:
                    state = "kept" if not row.overwrite else "lost"
                out.append((row.name, state, row.rows, row.size, row.sha256))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in _REPORT.split(", ")])

    ready = spark.read.schema(_WHOLE).parquet(f"{staging}/ready")
    ready.mapInPandas(moved, _REPORT).write.mode("overwrite").parquet(f"{staging}/done")
    for rest in ("pieces", "whole"):
        stores.remove_folder(f"{staging}/{rest}")
    return spark.read.schema(_REPORT).parquet(f"{staging}/done")


def recover(spark: SparkSession, folder: str) -> list[str]:
    """Finish the runs that stopped after their commit and clear those that stopped before it. Names of the runs finished.

    Only for a folder that no run writes to now.
    """
    from pyarrow import fs

    store, root = stores.located(f"{folder.rstrip('/')}/{STAGING}")
    finished = []
    for run in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        staging = f"{folder.rstrip('/')}/{STAGING}/{run.base_name}"
        if stores.exists(f"{staging}/done/_SUCCESS"):
            continue
        if stores.exists(f"{staging}/ready/_SUCCESS"):
            _publish(spark, folder, staging)
            finished.append(run.base_name)
        else:
            stores.remove_folder(staging)
    return finished
