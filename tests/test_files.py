"""Named files and file moves: all or nothing, repeatable, and nothing lost."""

import zipfile
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablewright.operators import moves, named_files
from tablewright.sources import stores


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return path


def visible(folder):
    """Relative paths and texts of the files that a reader sees."""
    root = Path(folder)
    return {str(p.relative_to(root)): p.read_text() for p in root.rglob("*") if p.is_file() and not any(x[0] in "_." for x in p.relative_to(root).parts)}


def test_files_have_exactly_the_names_given(spark, tmp_path):
    rows = spark.createDataFrame([("b", "20240115", 2, 'say "hi"'), ("a", "20240115", 1, "x,y"), ("a", "20240116", 3, None), ("a", "20240115", 0, "two\nlines")],
                                 "org string, day string, n int, note string")
    name = F.concat_ws("_", "org", F.lit("calls"), F.concat("day", F.lit(".csv")))
    report = named_files.write_named(rows, str(tmp_path), name, ["n", "note"], order=[F.col("n")], organization=F.col("org"), table=F.lit("calls"))
    assert visible(tmp_path) == {
        "organization=a/table=calls/a_calls_20240115.csv": 'n,note\n0,"two\nlines"\n1,"x,y"\n',
        "organization=a/table=calls/a_calls_20240116.csv": "n,note\n3,\n",
        "organization=b/table=calls/b_calls_20240115.csv": 'n,note\n2,"say ""hi"""\n'}
    assert {(r.name.rsplit("/", 1)[1], r.state, r.rows) for r in report.collect()} == {
        ("a_calls_20240115.csv", "written", 2), ("a_calls_20240116.csv", "written", 1), ("b_calls_20240115.csv", "written", 1)}
    for r in report.collect():
        assert stores.digest(str(tmp_path / r.name)) == (r.size, r.sha256)


def test_files_that_are_there_are_kept_unless_told_otherwise(spark, tmp_path):
    def write(n, overwrite=False):
        return named_files.write_named(spark.createDataFrame([(n,)], "n int"), str(tmp_path), F.lit("x.csv"), overwrite=overwrite).first().state

    assert [write(1), write(2), write(1)] == ["written", "kept", "written"] and visible(tmp_path) == {"x.csv": "n\n1\n"}
    assert write(3, True) == "written" and visible(tmp_path) == {"x.csv": "n\n3\n"}


def test_a_hot_file_is_written_by_many_tasks_in_order(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        named_files.write_named(spark.range(20_000).repartition(5), str(tmp_path), F.lit("hot.csv"), order=[F.col("id").desc()])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    listed = spark.read.json(f"{tmp_path}/_staging/*/pieces.json")
    assert listed.count() > 1
    assert visible(tmp_path) == {"hot.csv": "id\n" + "".join(f"{k}\n" for k in range(19_999, -1, -1))}


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    rows = spark.range(100).withColumn("v", F.when(F.col("id") == 77, F.raise_error(F.lit("broken row")).cast("int")).otherwise(1))
    with pytest.raises(Exception, match="broken row"):
        named_files.write_named(rows, str(tmp_path), F.concat(F.col("id") % 3, F.lit(".csv")))
    assert visible(tmp_path) == {}
    for bad in (F.lit(None).cast("string"), F.lit(""), F.lit("../x.csv"), F.lit("a/../x.csv"), F.lit("_x.csv")):
        with pytest.raises(Exception, match="no name for a file"):
            named_files.write_named(spark.range(3), str(tmp_path), bad)
    assert visible(tmp_path) == {}
    assert named_files.recover(spark, str(tmp_path)) == [] and not list(tmp_path.glob("_staging/*"))


def test_a_task_that_fails_while_writing_leaves_no_file(spark, tmp_path):
    """One of the two tasks cannot write its piece; what the other has written goes too."""
    writer = named_files.PieceWriter(f"{tmp_path}/_staging/run", "h\n")
    blocked = spark.createDataFrame([("a.csv", "1"), ("b.csv", "2")], "name string, line string").repartitionByRange(2, "name")

    class Broken(named_files.PieceSink):
        @classmethod
        def name(cls):
            return "broken_pieces"

        def writer(self, schema, overwrite):
            class Failing(type(writer)):
                def write(self, iterator):
                    done = super().write(iterator)
                    if any(p[0] == "b.csv" for p in done.pieces):
                        raise OSError("no space left")
                    return done

            return Failing(self.options["path"], self.options["header"])

    spark.dataSource.register(Broken)
    with pytest.raises(Exception, match="no space left"):
        blocked.write.format("broken_pieces").mode("append").options(path=f"{tmp_path}/_staging/run", header="h\n").save()
    assert visible(tmp_path) == {} and not (tmp_path / "_staging/run").exists()


def test_a_run_that_stopped_is_finished_or_cleared(spark, tmp_path, monkeypatch):
    def stop(*args):
        raise KeyboardInterrupt

    rows = spark.range(10).withColumn("f", F.concat(F.col("id") % 2, F.lit(".csv")))
    with monkeypatch.context() as m:
        m.setattr(named_files, "_publish", stop)
        with pytest.raises(KeyboardInterrupt):
            named_files.write_named(rows, str(tmp_path), F.col("f"), ["id"])
    with monkeypatch.context() as m:
        m.setattr(named_files, "_assemble", stop)
        with pytest.raises(KeyboardInterrupt):
            named_files.write_named(rows, str(tmp_path), F.concat(F.lit("late"), "f"), ["id"])
    assert visible(tmp_path) == {}
    assert len(named_files.recover(spark, str(tmp_path))) == 1
    assert {k: len(v.split()) for k, v in visible(tmp_path).items()} == {"0.csv": 6, "1.csv": 6}
    assert named_files.recover(spark, str(tmp_path)) == []


def test_no_rows_no_files(spark, tmp_path):
    assert named_files.write_named(spark.range(0), str(tmp_path), F.lit("x.csv")).collect() == [] and visible(tmp_path) == {}


NAMES = ("GL.acme.all.2000-01-01_x.csv", "GL.acme.change.2023-12-30_cr_y.csv")


def test_copies_are_made_once_and_never_overwrite(spark, tmp_path):
    source, target, path = tmp_path / "s", tmp_path / "t", str(tmp_path / "ledger")
    for k, name in enumerate(NAMES):
        put(source / name, f"text {k}")
    put(source / "later.zip", "z")
    first = {(r.source.rsplit("/", 1)[1], r.state) for r in moves.copy_new(spark, str(source), str(target), path, "a").collect()}
    assert first == {(n, s) for n in NAMES for s in ("planned", "copied")}
    assert visible(target) == {"table=GL/date=20000101/acme.all.2000-01-01_x.csv": "text 0", "table=GL/date=20231230/acme.change.2023-12-30_cr_y.csv": "text 1"}
    put(source / NAMES[0], "other text")
    moves.copy_new(spark, str(source), str(target), path, "b")
    last = {r.source.rsplit("/", 1)[1]: (r.run, r.state, r.size) for r in moves.states(spark, path).collect()}
    assert last == {NAMES[0]: ("b", "differs", 6), NAMES[1]: ("b", "present", 6)}
    assert visible(target)["table=GL/date=20000101/acme.all.2000-01-01_x.csv"] == "text 0"
    assert moves.ledger(spark, path).count() == 8


def test_old_files_leave_the_live_folder_and_come_back(spark, tmp_path):
    live, archived, path = tmp_path / "live", tmp_path / "old", str(tmp_path / "ledger")
    for name in (*NAMES, "GL.acme.all.2000-02-01_x.txt", "no-date.csv"):
        put(live / name, name)
    for run in "ab":
        moves.archive_old(spark, str(live), str(archived), path, run, date(2024, 1, 15))
    assert set(visible(live)) == {NAMES[1], "no-date.csv"}
    assert visible(archived) == {f"date=200001/{NAMES[0]}": NAMES[0], "date=200002/GL.acme.all.2000-02-01_x.txt": "GL.acme.all.2000-02-01_x.txt"}
    assert [r.state for r in moves.ledger(spark, path).where(F.endswith("source", F.lit(NAMES[0]))).orderBy("step").collect()] == ["planned", "copied", "removed"]
    moves.restore_all(spark, str(archived), str(live), path, "c")
    assert set(visible(live)) == {*NAMES, "no-date.csv"} and len(visible(archived)) == 2


def test_a_live_file_is_kept_where_the_archive_holds_another(spark, tmp_path):
    live, archived, path = tmp_path / "live", tmp_path / "old", str(tmp_path / "ledger")
    put(live / NAMES[0], "new text")
    put(archived / "date=200001" / NAMES[0], "old text")
    moves.archive_old(spark, str(live), str(archived), path, "a", date(2024, 1, 15))
    assert visible(live) == {NAMES[0]: "new text"}
    assert moves.states(spark, path).first().state == "differs"


def test_a_stopped_run_is_resumed_from_the_ledger(spark, tmp_path, monkeypatch):
    live, archived, path = tmp_path / "live", tmp_path / "old", str(tmp_path / "ledger")
    for k in range(4):
        put(live / f"GL.acme.all.2000-01-0{k + 1}_x.csv", f"text {k}")
    whole = moves._stream

    def only_copies(session, rows, work):
        if work is moves._remove:
            raise KeyboardInterrupt
        return whole(session, rows.limit(2), work)

    with monkeypatch.context() as m:
        m.setattr(moves, "_stream", only_copies)
        with pytest.raises(KeyboardInterrupt):
            moves.archive_old(spark, str(live), str(archived), path, "a", date(2024, 1, 15))
    assert len(visible(live)) == 4 and len(visible(archived)) == 2
    assert moves.unfinished(spark, path).count() == 4
    moves.resume(spark, path, "a")
    assert visible(live) == {} and len(visible(archived)) == 4
    assert moves.unfinished(spark, path).count() == 0
    moves.resume(spark, path, "a")
    assert {r.state for r in moves.states(spark, path).collect()} <= {"removed", "present"}


def test_members_of_archives_land_as_files(spark, tmp_path):
    source, target, path = tmp_path / "s", tmp_path / "t", str(tmp_path / "ledger")
    source.mkdir()
    with zipfile.ZipFile(source / "drop.zip", "w") as out:
        for k, name in enumerate(NAMES):
            out.writestr(f"folder/{name}" if k else name, f"text {k}" * 1000)
        out.writestr("empty/", "")
    for run in "ab":
        moves.unpack_new(spark, str(source), str(target), path, run)
    assert visible(target) == {"table=GL/date=20000101/acme.all.2000-01-01_x.csv": "text 0" * 1000,
                               "table=GL/date=20231230/acme.change.2023-12-30_cr_y.csv": "text 1" * 1000}
    assert sorted((r.run, r.state) for r in moves.ledger(spark, path).where("step = 1").collect()) == [("a", "copied")] * 2 + [("b", "present")] * 2


def test_an_archive_sent_twice_under_two_names_lands_once(spark, tmp_path):
    from tablewright.streaming import intake

    source, target, path, checkpoint = tmp_path / "s", tmp_path / "t", str(tmp_path / "ledger"), str(tmp_path / "c")

    def send(name, member, text):
        (source / name).parent.mkdir(parents=True, exist_ok=True)
        with zipfile.ZipFile(source / name, "w") as out:
            out.writestr(zipfile.ZipInfo(member), text)

    send("one.zip", NAMES[0], "text 0")
    send("same.zip", NAMES[0], "text 0")
    intake.take_in(spark, str(source), str(target), path, checkpoint)
    send("later/two.zip", NAMES[0], "text 0")
    send("new.zip", NAMES[1], "text 1")
    for _ in range(2):
        intake.take_in(spark, str(source), str(target), path, checkpoint)
    assert visible(target) == {"table=GL/date=20000101/acme.all.2000-01-01_x.csv": "text 0", "table=GL/date=20231230/acme.change.2023-12-30_cr_y.csv": "text 1"}
    landed = moves.ledger(spark, path).where("step = 1").collect()
    assert sorted((r.source.split("!")[1], r.state) for r in landed) == [(NAMES[0], "copied"), (NAMES[1], "copied")]
