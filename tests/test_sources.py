import io
import json
import os
import zipfile
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader

from tablewright.operators import joins
from tablewright.plans import flows
from tablewright.sources import archives, catalog, delimited, external, files, paged_json
from tablewright.streaming import ingest, upserts


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_backslash_at_the_end_of_a_quoted_field(spark, tmp_path):
    put(tmp_path / "a.csv", 'name,n\n"C:\\dir\\",1\n"say ""hi""",2\nplain\\,3\n')
    schema = T.StructType.fromDDL("name string, n int")
    rows = [tuple(r) for r in delimited.read_delimited(spark, str(tmp_path), schema, ",").orderBy("n").collect()]
    assert rows == [("C:\\dir\\", 1), ('say "hi"', 2), ("plain\\", 3)]


def test_a_different_header_is_refused(spark, tmp_path):
    put(tmp_path / "a.csv", "b|a\n1|x\n")
    with pytest.raises(Exception):
        delimited.read_delimited(spark, str(tmp_path), T.StructType.fromDDL("a string, b int")).collect()
    with pytest.raises(ValueError):
        delimited.read_expected(spark, str(tmp_path), ["Cost"], T.StructType.fromDDL("a string, b int"))


def test_mixed_headers_line_up_by_name(spark, tmp_path):
    paths = [put(tmp_path / "1.csv", "a|b|junk\n1|x|j\n"), put(tmp_path / "2.csv", "b|a\ny|2\n"), put(tmp_path / "3.csv", "a|c\n3|z\n")]
    df = delimited.read_mixed(spark, paths, {"a": "int"}, ["junk"])
    assert sorted((r.a, r.b, r.c) for r in df.collect()) == [(1, "x", None), (2, "y", None), (3, None, "z")]


def test_union_by_position_needs_equal_headers(spark):
    left = spark.createDataFrame([(1, 2)], "a int, b int")
    assert joins.union_by_position(left, left).count() == 2
    with pytest.raises(ValueError):
        joins.union_by_position(left, left.select("b", "a"))


def pack(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)
    return out.getvalue()


def test_zip_members_with_line_breaks_in_fields(spark, tmp_path):
    put(tmp_path / "d" / "one.zip", pack({"T.a.csv": 'id,t\n1,"two\nlines"\n2,\n', "U.b.csv": "id,t\n3,x\n", "empty/": ""}))
    put(tmp_path / "d" / "note.txt", "no archive")
    packed = archives.archives(spark, str(tmp_path))
    assert packed.count() == 1
    records = archives.expand_records(packed, chunk_rows=2)
    typed = archives.typed_records(records, T.StructType.fromDDL("id int, t string"))
    assert sorted((r.member, r.id, r.t) for r in typed.collect()) == [
        ("T.a.csv", 1, "two\nlines"), ("T.a.csv", 2, None), ("U.b.csv", 3, "x")]


def test_fields_longer_than_the_csv_default_stay_whole(spark, tmp_path):
    text = "x" * 400_000
    put(tmp_path / "long.zip", pack({"a.csv": f"t\n{text}\n"}))
    rows = archives.expand_records(archives.archives(spark, str(tmp_path)), chunk_chars=1000).where("record_no = 1")
    assert rows.first().fields == [text]


def test_inventory_prefix_size_and_dates(spark, tmp_path):
    old = put(tmp_path / "x" / "in_old.csv", "a")
    put(tmp_path / "in_new.csv", "bb")
    put(tmp_path / "in_empty.csv", "")
    put(tmp_path / "out.csv", "c")
    stamp = datetime(2024, 1, 10, tzinfo=timezone.utc).timestamp()
    os.utime(old, (stamp, stamp))
    listed = files.inventory(spark, str(tmp_path), prefix="in_")
    assert {r.name: r["size"] for r in listed.collect()} == {"in_old.csv": 1, "in_new.csv": 2}
    assert [r.name for r in files.inventory(spark, str(tmp_path), "in_", date(2024, 1, 11)).collect()] == ["in_old.csv"]
    assert files.inventory(spark, str(tmp_path), "in_", date(2024, 1, 10)).count() == 0
    assert {r.name for r in files.recent(files.inventory(spark, str(tmp_path)), date(2024, 1, 12)).collect()} == {"in_new.csv", "out.csv"}
    assert files.recent(listed, date(2024, 1, 11)).count() == 2


def test_ledger_files_are_chosen_by_name(spark, tmp_path):
    head = "id|ddsReadTime\n"
    put(tmp_path / "table=GL" / "GL.acme.all.2024-01-01_1.csv", head + "1|2024-01-01 10:00:00\n")
    put(tmp_path / "table=GL" / "GL.acme.change.2024-01-02_upd_1.csv", head + "2|2024-01-02 10:00:00\n3|bad\n")
    put(tmp_path / "table=GL" / "GL.acme.change.2024-01-02_cr_1.csv", head + "4|2024-01-03 00:00:00\n")
    schema = T.StructType.fromDDL("id int, ddsReadTime string")
    ids = {kind: sorted(r.id for r in flows.ledger_frame(spark, str(tmp_path), kind, schema).collect())
           for kind in ("fl", "upd", "cr", "del", "all")}
    assert ids == {"fl": [1], "upd": [2, 3], "cr": [4], "del": [], "all": [1, 2, 3, 4]}
    days = {r.id: r["__Date"] for r in flows.ledger_frame(spark, str(tmp_path), "upd", schema).collect()}
    assert days == {2: date(2024, 1, 2), 3: None}
    mixed = flows.mixed_ledger_frame(spark, str(tmp_path), "cr", {"id": "int"}, [])
    assert [r.id for r in mixed.collect()] == [4]
    assert flows.mixed_ledger_frame(spark, str(tmp_path), "del", {}, []) is None


def test_pages_and_completeness(spark, tmp_path):
    def page(source, number, ids, more, total):
        put(tmp_path / f"source={source}" / f"{number}.json", json.dumps(
            {"page": number, "pageSize": 2, "totalCount": total, "hasMore": more, "data": [{"id": i, "m": {"a": i}} for i in ids]}))

    page("a", 1, [1, 2], True, 3)
    page("a", 2, [3], False, 3)
    page("b", 1, [4, 5], True, 9)  # the pull stopped here; what came before stays
    record = T.StructType.fromDDL("id bigint, m map<string,string>")
    pages = paged_json.read_pages(spark, str(tmp_path), record)
    rows = sorted((r.id, r.m["a"], r.tenantId) for r in paged_json.records_of(pages).collect())
    assert rows == [(1, "1", "a"), (2, "2", "a"), (3, "3", "a"), (4, "4", "b"), (5, "5", "b")]
    state = {r.source: (r.records, r.totalCount, r.complete) for r in joins.expected_rows(pages).collect()}
    assert state == {"a": (3, 3, True), "b": (2, 9, False)}


def test_a_page_that_is_cut_off_stops_the_read(spark, tmp_path):
    put(tmp_path / "source=a" / "1.json", '{"page": 1, "pageSize": 2, "totalCount": 2, "hasMore": false, "data": [{"id": 1}, {"i')
    with pytest.raises(Exception):
        paged_json.records_of(paged_json.read_pages(spark, str(tmp_path), T.StructType.fromDDL("id bigint"))).collect()


def test_a_broken_page_costs_no_other_and_is_reported(spark, tmp_path, database):
    def page(number, ids, more=True):
        return json.dumps({"page": number, "pageSize": 2, "totalCount": 6, "hasMore": more, "data": [{"id": i} for i in ids]})

    put(tmp_path / "source=a" / "1.json", page(1, [1, 2]) + "\n" + page(2, [3, 4])[:-8] + "\n" + page(3, [5, 6], False) + "\n")
    put(tmp_path / "source=b" / "1.json", page(2, [7, 8]) + "\n" + page(3, ["x"]) + "\n" + '{"data": [{"id": 9}]}\n' + page(6, [10]) + "\n")
    record = T.StructType.fromDDL("id bigint")
    good, bad = paged_json.sorted_out(spark, str(tmp_path), record)
    assert sorted((r.source, r.page, [d.id for d in r.data]) for r in good.collect()) == [("a", 1, [1, 2]), ("a", 3, [5, 6]), ("b", 2, [7, 8]), ("b", 6, [10])]
    assert sorted((r.source, r.page or 0, r.reason, r.path.rsplit("/", 1)[1]) for r in bad.collect()) == [
        ("a", 2, "broken", "1.json"), ("b", 0, "no envelope", "1.json"), ("b", 3, "broken", "1.json")]
    assert sorted(tuple(r) for r in paged_json.gaps(good).fillna(-1).collect()) == [("a", 2, 2), ("b", 1, 1), ("b", 3, 5), ("b", 7, -1)]
    rows = flows.pull_dataset(spark, str(tmp_path), "m", record, f"{database}.rejects")
    assert rows.count() == 7 and spark.table(f"{database}.rejects").count() == 3


def test_missing_pages_are_refused(spark, tmp_path):
    put(tmp_path / "source=a" / "1.json", json.dumps({"page": 1, "pageSize": 1, "totalCount": 2, "hasMore": True, "data": [{"id": 1}]}))
    with pytest.raises(ValueError):
        flows.pull_dataset(spark, str(tmp_path), "tt", T.StructType.fromDDL("id bigint"))
    with pytest.raises(ValueError):
        flows.dataset_frame(spark.range(1), "unheard of")


def test_values_that_do_not_fit_stop_the_read_and_line_breaks_survive(spark, tmp_path):
    put(tmp_path / "bad" / "a.csv", "n|t\n1|x\nmany|y\n")
    with pytest.raises(Exception):
        delimited.read_delimited(spark, str(tmp_path / "bad"), T.StructType.fromDDL("n int, t string")).collect()
    frame = spark.createDataFrame([(1, "two\nlines"), (2, "a\r\nb|c"), (3, 'q"')], "n int, t string")
    delimited.write_delimited(frame, str(tmp_path / "out"))
    got = sorted(tuple(r) for r in delimited.read_delimited(spark, str(tmp_path / "out"), frame.schema).collect())
    assert [(n, t.replace("\r\n", "\n")) for n, t in got] == [(1, "two\nlines"), (2, "a\nb|c"), (3, 'q"')]


def test_archive_fields_are_found_by_header(spark, tmp_path):
    put(tmp_path / "one.zip", pack({"a.csv": "B,A\n7,3\n", "b.csv": "a,b\n1,2\n"}))
    records = archives.expand_records(archives.archives(spark, str(tmp_path)))
    typed = archives.typed_records(records, T.StructType.fromDDL("a int, b int"))
    assert sorted((r.a, r.b) for r in typed.collect()) == [(1, 2), (3, 7)]
    with pytest.raises(Exception):
        archives.typed_records(records, T.StructType.fromDDL("a int, c int")).collect()


def test_a_name_may_fit_several_load_types(spark):
    frame = spark.createDataFrame([("T.o.change.2024-01-01_cr_upd_.csv",), ("T.o.all.1_cr_.csv",), ("x",)], "name string")
    assert [r.k for r in frame.select(files.load_types(F.col("name")).alias("k")).collect()] == [["cr", "upd"], ["fl"], []]
    both = spark.createDataFrame([("change._cr_x_upd_",)], "name string")
    assert files.of_type(both, "cr").count() == files.of_type(both, "upd").count() == 1


def test_a_failing_table_without_a_message_is_reported(spark, monkeypatch):
    def fail(name):
        raise RuntimeError

    assert [r.error for r in catalog._each(spark, ["t"], fail, 1).collect()] == ["RuntimeError"]


def echo():
    """A reader that answers a query with its text, and knows two catalog tables. Local, so that it is sent by value."""

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.options = options

        def read(self, partition):
            table = self.options.get("dbtable", "")
            if table.endswith("TABLES"):
                yield from [("SALES", "ORDERS"), ("INFORMATION_SCHEMA", "TABLES")]
            elif table.endswith("COLUMNS"):
                yield from [("ORDERS", "B", "TEXT", 2, "YES"), ("ORDERS", "A", "NUMBER", 1, "NO"), ("OTHER", "C", "TEXT", 1, "YES")]
            else:
                yield (f"{self.options.get('user')}: {self.options.get('query')}",)

    class Echo(DataSource):
        @classmethod
        def name(cls):
            return "echo"

        def schema(self):
            table = self.options.get("dbtable", "")
            if table.endswith("TABLES"):
                return "TABLE_SCHEMA string, TABLE_NAME string"
            if table.endswith("COLUMNS"):
                return "TABLE_NAME string, COLUMN_NAME string, DATA_TYPE string, ORDINAL_POSITION int, IS_NULLABLE string"
            return "answer string"

        def reader(self, schema):
            return Reader(self.options)

    return Echo


def test_external_source_hands_the_query_over(spark):
    spark.dataSource.register(echo())
    source = external.ExternalSource(spark, "echo", {"user": "u"})
    assert source.query("select 1").first()[0] == "u: select 1"
    assert source.ping() is True
    assert [r[0] for r in source.tables().collect()] == ["SALES.ORDERS"]
    assert [tuple(r) for r in source.columns("orders").collect()] == [("A", "NUMBER", 1, "NO"), ("B", "TEXT", 2, "YES")]
    assert external.ExternalSource(spark, "no-such-format").ping() is False
    assert external.ReadRange("id", 0, 100, 8).options() == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "8"}


def test_catalog_listing_and_columns(spark, database):
    for name in ("b", "a"):
        spark.range(3).write.saveAsTable(f"{database}.{name}")
    assert [r[0] for r in catalog.tables(spark, database).collect()] == [f"{database}.a", f"{database}.b"]
    assert catalog.tables(spark, database, first=1).count() == 1
    df = spark.createDataFrame([], T.StructType.fromDDL("x bigint not null, y string"))
    assert [tuple(r) for r in catalog.column_metadata(df).collect()] == [("x", "bigint", 1, "NO"), ("y", "string", 2, "YES")]
    assert catalog.nested_fields(T.StructType.fromDDL("a int, b struct<c:int,d:struct<e:int>>")) == ["a", "b", "b.c", "b.d", "b.d.e"]
    report = {r.table_name: (r.row_count, r.ok) for r in catalog.warm_tables(spark, [f"{database}.a", f"{database}.zz"]).collect()}
    assert report == {f"{database}.a": (3, True), f"{database}.zz": (None, False)}
    assert spark.catalog.isCached(f"{database}.a")
    catalog.release(spark, [f"{database}.a"])
    assert not spark.catalog.isCached(f"{database}.a")


def test_stream_takes_each_file_once(spark, folder):
    source, target, checkpoint = folder(), folder(), folder()
    df = spark.range(10).toDF("id")
    for arrives, expected in ((True, 10), (True, 20), (False, 20)):
        if arrives:
            df.write.mode("append").parquet(source)
        ingest.ingest_new_files(spark, source, target, checkpoint, df.schema, files_per_batch=1)
        assert ingest.landed(spark, target).count() == expected


def test_streaming_upsert_keeps_the_last_change(spark, folder, database):
    source, checkpoint, table = folder(), folder(), f"{database}.t"
    schema = "k bigint, at int, v string"
    for batch in ([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], [(1, 3, "d"), (3, 1, None)]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(source)
        for _ in range(2):
            upserts.upsert_stream(spark, source, T.StructType.fromDDL(schema), table, ["k"], checkpoint, order="at")
    assert sorted(tuple(r) for r in spark.table(table).collect()) == [(1, 3, "d"), (2, 1, "c"), (3, 1, None)]


def test_drop_is_landed_and_problem_files_recorded(spark, tmp_path, folder, database):
    put(tmp_path / "d.zip", pack({"GL.acme.all.2024-01-01_1.csv": "a\n1\n", "GL.acme.odd.2024-01-02_1.csv": "a\n2\n"}))
    packed = archives.archives(spark, str(tmp_path))
    for _ in range(2):
        landed = flows.land_drop(packed, folder(), f"{database}.problem_files")
    assert sorted((r.table, r.date) for r in landed.select("table", "date").distinct().collect()) == [
        ("GL", "20240101"), ("GL", "20240102")]
    assert [(r.file_name, r.table_name) for r in spark.table(f"{database}.problem_files").collect()] == [
        ("GL.acme.odd.2024-01-02_1.csv", "GL")]
    assert landed.where(F.col("record_no") > 0).count() == 2


def test_archives_share_folders_and_replace_only_themselves(spark, folder, database):
    from pathlib import Path

    def drop(**archives):
        rows = [(path, pack({f"GL.acme.all.{day}_1.csv": f"a\n{value}\n" for day, value in members.items()})) for path, members in archives.items()]
        return spark.createDataFrame(rows, "path string, content binary")

    target, control = folder(), f"{database}.problem_files"
    first = {f"z{k}": {"2024-01-01": k, "2024-01-02": k} for k in range(40)}
    flows.land_drop(drop(**first), target, control)
    assert len(list(Path(target).glob("table=*/date=*/drop=*"))) <= 2 * flows.DROP_FOLDERS
    flows.land_drop(drop(late={"2024-01-01": 500}), target, control)
    landed = flows.land_drop(drop(z3={"2024-01-01": 103}, z4={"2024-01-01": 104, "2024-01-03": 104}, new={"2024-01-02": 7}), target, control)
    got = sorted((r.path, r.date, r.fields[0]) for r in landed.where("record_no = 1").collect())
    want = {(path, day): str(v) for path, days in first.items() for day, v in days.items()}
    want |= {("late", "2024-01-01"): "500", ("z3", "2024-01-01"): "103", ("z4", "2024-01-01"): "104", ("z4", "2024-01-03"): "104", ("new", "2024-01-02"): "7"}
    assert got == sorted((path, day.replace("-", ""), v) for (path, day), v in want.items())


def test_landed_pages_of_one_source_are_written_where_their_rows_are(spark):
    """Full pages per scan partition, also where Spark broadcasts nothing by itself: no task gets all of a source."""
    from pathlib import Path

    from tablewright.registry.common import write_pages

    rows = spark.range(0, 5000, 1, 4).select(
        "id", F.when(F.col("id") % 7 == 3, "a\n\"b\"").alias("text"), F.create_map(F.lit("k"), F.col("id").cast("string")).alias("m"),
        F.when(F.col("id") >= 0, "t1").alias("tenantId"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        path = write_pages(rows, "tenantId", 500)
    finally:
        spark.conf.set(key, before)
    assert len([f for f in Path(path).glob("source=t1/part-*")]) == 4
    pages = paged_json.read_pages(spark, path, rows.drop("tenantId").schema)
    assert sorted(r.n for r in pages.select(F.size("data").alias("n")).collect()) == [250] * 4 + [500] * 8
    assert [r.asDict() for r in joins.expected_rows(pages).select("records", "totalCount", "complete").collect()] == [
        {"records": 5000, "totalCount": 5000, "complete": True}]
    back = paged_json.records_of(pages).select("id", "text", "m", "tenantId")
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_landed_pages_take_a_fraction_of_their_text_in_files_of_few_pages(spark, monkeypatch):
    import gzip
    from pathlib import Path

    from tablewright.registry import common, nesting

    monkeypatch.setattr(common, "FILE_PAGES", 2)
    rows = nesting.invoice_texts(spark, "/root/testdata/sf0.001")
    path = common.write_pages(rows, "tenantId", 500)
    landed = list(Path(path).glob("source=t1/part-*"))
    texts = [gzip.decompress(f.read_bytes()) for f in landed]
    assert sum(f.stat().st_size for f in landed) * 10 < sum(map(len, texts))
    assert max(t.count(b"\n") for t in texts) == 2 and sum(t.count(b"\n") for t in texts) == -(-rows.count() // 500)
    pages = paged_json.read_pages(spark, path, rows.drop("tenantId").schema)
    assert joins.expected_rows(pages).select("records", "totalCount", "complete").collect() == [(rows.count(), rows.count(), True)]
    back = paged_json.records_of(pages).select(*rows.columns)
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()


def test_a_compressed_file_of_pages_that_is_cut_off_stops_the_read(spark, tmp_path):
    import gzip

    lines = "".join(json.dumps({"page": n, "pageSize": 1, "totalCount": 9000, "hasMore": n < 9000, "data": [{"id": n * 7919 % 9001}]}) + "\n" for n in range(1, 9001))
    put(tmp_path / "source=a" / "1.json.gz", gzip.compress(lines.encode())[:-4000])
    with pytest.raises(Exception):
        paged_json.records_of(paged_json.read_pages(spark, str(tmp_path), T.StructType.fromDDL("id bigint"))).collect()
