import pytest
from pyspark.sql import functions as F

from tablewright import schemas
from tablewright.functions import records
from tablewright.operators import columns, nested


def one(spark, text, keys):
    df = spark.createDataFrame([(text,)], "t string").withColumn("r", records.in_order(F.col("t"), records.pieces(F.col("t")), keys))
    row = df.select(*[records.value_at(F.col("r"), keys, k).alias(k) for k in keys], records.rejected(F.col("t"), F.col("r"))).first()
    return list(row)[:-1], row[-1]


def test_values_may_hold_commas_equals_and_line_breaks(spark):
    assert one(spark, "a=1, 2, b=x=y\nz\t, c=", ("a", "b", "c")) == (["1, 2", "x=y\nz\t", ""], None)


def test_keys_in_any_order_and_absent(spark):
    assert one(spark, "b=1, a=2", ("a", "b")) == (["2", "1"], None)
    assert one(spark, "a=1, c=3", ("a", "b", "c")) == (["1", None, "3"], None)
    assert one(spark, "c=3", ("a", "b", "c")) == ([None, None, "3"], None)
    assert one(spark, "ab=1, a=2, b=3", ("a", "ab", "b")) == (["2", "1", "3"], None)
    assert one(spark, "b=1, b=2, a=3", ("a", "b")) == (["3", "1"], None)
    assert one(spark, "", ("a", "b")) == ([None, None], None)
    assert one(spark, None, ("a", "b")) == ([None, None], None)


def test_what_fits_nothing_is_kept_as_rejected(spark):
    assert one(spark, "no record at all", ("a", "b")) == ([None, None], "no record at all")
    assert one(spark, "x=1, b=2", ("a", "b")) == ([None, "2"], "x=1, b=2")
    assert one(spark, "{", ("a", "b")) == ([None, None], "{")


def test_keys_inside_braces_are_not_the_records_own(spark):
    assert one(spark, "a={b=1, c={a=5, b={a=9}}, d={}}, b=2", ("a", "b")) == (["{b=1, c={a=5, b={a=9}}, d={}}", "2"], None)
    assert one(spark, "a=[{b=1}, {b=2}], b=3", ("a", "b")) == (["[{b=1}, {b=2}]", "3"], None)
    deep = "{" + ", ".join(f"x={{y={k}}}" for k in range(3000)) + "}"
    assert one(spark, f"a={deep}, b=2", ("a", "b")) == ([deep, "2"], None)


def test_marks_of_other_formats_survive(spark):
    assert one(spark, 'a=$1 \\ x, b=\\$2 "q", c=\\', ("a", "b", "c")) == (["$1 \\ x", '\\$2 "q"', "\\"], None)


def test_items_with_keys_absent_or_moved(spark):
    texts = ["[{id=1, type=Service}, {total=5, itemGroup={rootId=9}, id=2}]", "[{generalLedgerAccount={type=T, number=7}, cost=null, id=3}]", "junk", "[{}]"]
    df = spark.createDataFrame([(k, "t", t) for k, t in enumerate(texts)], "id bigint, tenantId string, items string")
    rows = [r.asDict() for r in nested.parse_items(df, rejected="rest").orderBy("invoiceId", "id").collect()]
    shown = [{k: v for k, v in r.items() if v is not None and k not in ("tenantId", "invoiceId")} for r in rows]
    assert shown == [{"id": "1", "type": "Service"}, {"id": "2", "total": "5", "itemGroup_rootId": "9"},
                     {"id": "3", "generalLedgerAccount_type": "T", "generalLedgerAccount_number": "7"}, {"rest": "junk"}, {}]


def test_deep_entries_with_keys_absent_or_moved(spark):
    df = spark.sql("select map('agent', '{id=4, name=Ann}', 'reason', 'nothing', 'campaign', '{category={id=7, name=web}, id=1}') as c")
    row = nested.deep_keys(df, "c", {"agent": ("name", "externalId", "id"), "reason": ("name", "id"), "campaign": ("name", "id", "category")}, "rest").first()
    assert (row.c_agent_name, row.c_agent_externalId, row.c_agent_id, row.c_reason_name) == ("Ann", None, "4", None)
    assert (row.c_campaign_name, row.c_campaign_id, row.c_campaign_category) == (None, "1", "{id=7, name=web}")
    assert row.rest == {"reason": "nothing"}


def item(**values):
    inner = {k: v for k, v in values.items() if isinstance(v, dict)}
    parts = []
    for key in schemas.ITEM_KEYS:
        if key in inner:
            text = ", ".join(f"{k}={inner[key].get(k, 'null')}" for k in schemas.ITEM_NESTED_KEYS[key])
            parts.append(f"{key}={{{text}}}")
        else:
            parts.append(f"{key}={values.get(key, 'null')}")
    return "{" + ", ".join(parts) + "}"


def test_items_take_their_own_type(spark):
    text = "[" + item(id=1, type="Service", description="a, b", generalLedgerAccount={"type": "Income", "name": "Sales"}) + ", " + \
        item(id=2, itemGroup={"name": "g", "rootId": 9}) + "]"
    df = spark.createDataFrame([(10, "t", text), (11, "t", None)], "id bigint, tenantId string, items string")
    rows = {r.id: r.asDict() for r in nested.parse_items(df).collect()}
    assert set(rows) == {"1", "2"}
    assert rows["1"]["type"] == "Service" and rows["1"]["generalLedgerAccount_type"] == "Income"
    assert rows["1"]["description"] == "a, b" and rows["1"]["itemGroup_name"] is None and rows["1"]["invoiceId"] == 10
    assert rows["2"]["itemGroup_rootId"] == "9" and rows["2"]["generalLedgerAccount_name"] is None
    assert nested.parse_items(df).columns == schemas.invoice_item_schema().fieldNames()


def test_empty_arrays_and_levels_give_no_rows(spark):
    df = spark.createDataFrame([(1, [5, 6]), (2, []), (3, None)], "id int, tags array<bigint>")
    assert [tuple(r) for r in nested.explode_ids(df, "tags", "tag", job="id").collect()] == [(1, 5), (1, 6)]
    accounts = spark.sql("""select named_struct('id', 1, 'name', 'A', 'properties', array(
        named_struct('name', 'p', 'profiles', array(named_struct('id', 7, 'name', 'v'))),
        named_struct('name', 'q', 'profiles', cast(array() as array<struct<id:int,name:string>>)))) as account""")
    assert [tuple(r) for r in nested.explode_profiles(accounts, "account", "properties", "profiles").collect()] == [
        (1, "A", "p", "v", 7)]


def test_tidy(spark):
    df = spark.createDataFrame([('a=", b="x"\t y\\ z',)], "t string")
    assert df.select(records.tidy(F.col("t"))).first()[0] == "a=, b=''x'' y z"


def test_maps_flatten_with_safe_casts(spark):
    df = spark.sql("select 1 as id, map('id', '5', 'name', 'x') as c, map('number', 'no') as j")
    row = columns.flatten_maps(df, {"c": ("id", "name", "gone"), "j": ("number",)}, {"c_id": "bigint", "j_number": "int"}).first()
    assert row.asDict() == {"id": 1, "c_id": 5, "c_name": "x", "c_gone": None, "j_number": None}


def test_extracted_keys_do_not_replace_columns(spark):
    df = spark.sql("select map('a', '1', 'b', '2') as m, 'kept' as x")
    row = columns.extract_keys(df, "m", {"a": "x", "b": "y"}).first()
    assert (row.x, row.y) == ("kept", "2")


def test_conform_fills_casts_and_orders(spark):
    df = spark.createDataFrame([("7", "bad", 1)], "a string, b string, extra int")
    out = columns.conform(df, schemas.from_ddl("b int, a bigint, c map<string,string>"))
    assert out.columns == ["b", "a", "c"] and tuple(out.first()) == (None, 7, None)


def test_fill_ids(spark):
    df = spark.createDataFrame([(None, 2.0), (3.0, None)], "a double, b double")
    assert [tuple(r) for r in columns.fill_ids(df, ("a", "b")).collect()] == [(0, 2), (3, 0)]


@pytest.mark.parametrize("alias,name,table", [
    ("I", "invoices", "invoice"), ("invoice items", "invoice-items", "invoice_item"), ("jobs", "jobs", "job"),
    ("cm", "memberships", "membership"), ("nope", None, None)])
def test_dataset_lookup(spark, alias, name, table):
    assert (schemas.dataset_name(alias), schemas.dataset_table(alias)) == (name, table)
    df = spark.createDataFrame([(alias,)], "a string")
    assert tuple(df.select(schemas.dataset_name_column(F.col("a")), schemas.dataset_table_column(F.col("a"))).first()) == (name, table)


def test_schema_sizes(spark):
    sizes = {name: len(build().fields) for name, build in schemas.DATASET_SCHEMAS.items()}
    assert sizes == {"appointments": 12, "calls": 50, "customers": 14, "invoices": 36, "invoice-items": 35, "jobs": 31,
                     "job-tag-types": 3, "tag-types": 4}
    assert schemas.dataset_schema("memberships") is None
