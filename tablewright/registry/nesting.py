"""Registered queries: nested data and record text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import nested
from tablewright.registry.common import Registry, load
from tablewright.schemas import CALL_DEEP_KEYS, CALL_SHALLOW_KEYS, ITEM_KEYS, ITEM_NESTED_KEYS

registry = Registry()

registry.add("explode_array", """
    select vec_id as "jobId", 'src' as "tenantId", unnest(embedding) as "tagTypeId" from embeddings""")(
    lambda spark, sf: nested.explode_ids(
        load(spark, sf, "embeddings").withColumn("tenant", F.lit("src")), "embedding", "tagTypeId",
        jobId="vec_id", tenantId="tenant"))

registry.add("json_to_map", """
    select event_id, json_extract_string(props, '$.k') as k, len(json_keys(props)) as entries from events""")(
    lambda spark, sf: load(spark, sf, "events").select("event_id", nested.json_map(F.col("props")).alias("m")).select(
        "event_id", F.col("m")["k"].alias("k"), F.size("m").cast("bigint").alias("entries")))

VERSIONS = T.StructType([T.StructField("versions", T.ArrayType(T.StructType([
    T.StructField("key", T.StringType()), T.StructField("name", T.StringType())])))])


@registry.add("json_explode_sort", """
    select p_brand || '-' || cast(p_partkey as varchar) as key, p_name as name from part
    union all select p_type || '-' || cast(p_partkey as varchar), p_name || ' "x"' from part""")
def json_explode_sort(spark: SparkSession, sf: str) -> DataFrame:
    """A JSON document per part, holding two versions."""
    def version(kind: str, name: Column) -> Column:
        return F.struct(F.concat_ws("-", kind, "p_partkey").alias("key"), name.alias("name"))

    documents = load(spark, sf, "part").select(F.to_json(F.struct(F.array(
        version("p_brand", F.col("p_name")), version("p_type", F.concat("p_name", F.lit(' "x"')))).alias("versions"))).alias("text"))
    return nested.explode_document(documents, "text", VERSIONS, "versions", "key")


PROFILE = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
PROPERTY = T.StructType([T.StructField("name", T.StringType()), T.StructField("profiles", T.ArrayType(PROFILE))])
ACCOUNT = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("properties", T.ArrayType(PROPERTY))])


def account_documents(df: DataFrame, key: str, name: str, few: Column) -> DataFrame:
    """A nested account per row: a property with one profile and, where `few` does not hold, one with two.

    Where it holds, the second property has no profiles, as happens in real listings.
    """
    def view(id_: Column, label: str) -> Column:
        return F.struct(id_.alias("id"), F.concat(F.lit(label), F.col(key).cast("string")).alias("name"))

    k = F.col(key)
    none = F.array().cast(T.ArrayType(PROFILE))
    properties = F.array(
        F.struct(F.lit("shop").alias("name"), F.array(view(k, "all-")).alias("profiles")),
        F.struct(F.lit("blog").alias("name"), F.when(few, none).otherwise(
            F.array(view(-k - 1, "in-"), view(-k - 1, "out-"))).alias("profiles")))
    text = F.to_json(F.struct(k.alias("id"), F.col(name).alias("name"), properties.alias("properties")))
    return df.select(F.from_json(text, ACCOUNT).alias("account"))


registry.add("nested_explode_two_level", """
    select c_custkey as id, c_name as "Account", 'shop' as "webProperty", 'all-' || cast(c_custkey as varchar) as "View",
           c_custkey as "viewId" from customer
    union all select c_custkey, c_name, 'blog', side || cast(c_custkey as varchar), -c_custkey - 1
    from customer, (values ('in-'), ('out-')) s(side) where c_acctbal >= 0""")(
    lambda spark, sf: nested.explode_profiles(
        account_documents(load(spark, sf, "customer"), "c_custkey", "c_name", F.col("c_acctbal") < 0),
        "account", "properties", "profiles"))


def record_text(values: dict[str, Column]) -> Column:
    """{k=v, k2=v2} text; a NULL value is written as null."""
    pieces = [F.concat(F.lit(f"{k}="), F.coalesce(v.cast("string"), F.lit("null"))) for k, v in values.items()]
    return F.concat(F.lit("{"), F.concat_ws(", ", *pieces), F.lit("}"))


def item_text(own: dict[str, Column], inner: dict[str, dict[str, Column]]) -> Column:
    null = F.lit(None).cast("string")
    values = {}
    for key in ITEM_KEYS:
        if key in ITEM_NESTED_KEYS:
            entry = inner.get(key)
            values[key] = record_text({k: entry.get(k, null) for k in ITEM_NESTED_KEYS[key]}) if entry else null
        else:
            values[key] = own.get(key, null)
    return record_text(values)


def invoice_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Each line as an invoice of two items, goods and tax; lines with status F that carry no tax have no items."""
    goods = item_text(
        {"id": F.col("l_partkey"), "quantity": F.col("l_quantity").cast("int"), "type": F.lit("Material"),
         "description": F.concat(F.lit("part, "), F.col("l_returnflag")), "order": F.col("l_linenumber")},
        {"itemGroup": {"name": F.col("l_linestatus"), "rootId": F.col("l_suppkey")},
         "generalLedgerAccount": {"detailType": F.lit("Income"), "name": F.col("l_returnflag"), "type": F.lit("Ledger")}})
    tax = item_text(
        {"id": F.col("l_suppkey"), "total": F.round(F.col("l_tax") * 100).cast("int"), "type": F.lit("Service")},
        {"costOfSaleAccount": {"name": F.lit("Tax, state"), "number": F.col("l_linenumber")}})
    text = F.concat(F.lit("["), goods, F.lit(", "), tax, F.lit("]"))
    return load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.lit("t1").alias("tenantId"),
        F.when((F.col("l_tax") > 0) | (F.col("l_linestatus") != "F"), text).alias("items"))


ITEM_FIELDS = [k for k in ITEM_KEYS if k not in ITEM_NESTED_KEYS] + [
    f"{p}_{k}" for p, keys in ITEM_NESTED_KEYS.items() for k in keys]


def item_sql(values: dict[str, str]) -> str:
    shown = ", ".join(f'{values.get(f, "cast(null as varchar)")} as "{f}"' for f in ITEM_FIELDS)
    return (f"select {shown}, l_orderkey as \"invoiceId\", 't1' as \"tenantId\" from lineitem "
            "where l_tax > 0 or l_linestatus <> 'F'")


ITEMS_SQL = item_sql({
    "id": "cast(l_partkey as varchar)", "quantity": "cast(cast(l_quantity as integer) as varchar)", "type": "'Material'",
    "description": "'part, ' || l_returnflag", "order": "cast(l_linenumber as varchar)", "itemGroup_name": "l_linestatus",
    "itemGroup_rootId": "cast(l_suppkey as varchar)", "generalLedgerAccount_detailType": "'Income'",
    "generalLedgerAccount_name": "l_returnflag", "generalLedgerAccount_type": "'Ledger'"}) + " union all " + item_sql({
        "id": "cast(l_suppkey as varchar)", "total": "cast(cast(round(l_tax * 100) as integer) as varchar)", "type": "'Service'",
        "costOfSaleAccount_name": "'Tax, state'", "costOfSaleAccount_number": "cast(l_linenumber as varchar)"})
registry.add("parse_items", ITEMS_SQL)(lambda spark, sf: nested.parse_items(invoice_texts(spark, sf)))


def call_records(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer as a call record: shallow entries, and deep ones as record text, some without importId."""
    c = F.col
    customer = {k: F.lit(None) for k in CALL_DEEP_KEYS["customer"]}
    customer.update(name=c("c_name"), id=c("c_custkey"), address=F.concat(F.lit("{street=Nation "), c("c_nationkey"), F.lit(", zip=1}")),
                    email=F.lit("a@example.com"), type=c("c_mktsegment"), active=c("c_acctbal") > 0, importId=F.lit("imp"))
    shorter = {k: v for k, v in customer.items() if k != "importId"}
    deep = {
        "customer": F.when(c("c_mktsegment") == "MACHINERY", record_text(shorter)).otherwise(record_text(customer)),
        "campaign": record_text({"name": F.lit('Spring "24"'), "active": F.lit("true"), "modifiedOn": F.lit("m"),
                                 "id": c("c_nationkey"), "category": F.lit("{id=7, name=web}")}),
        "reason": F.when(c("c_acctbal") > 0, record_text({"name": c("c_mktsegment"), "active": F.lit("true"),
                                                          "id": c("c_custkey"), "lead": F.lit("false")})),
        "agent": record_text({"name": F.lit("Ann\tLee"), "externalId": F.lit(None), "id": c("c_nationkey")}),
    }
    entries = {**{k: F.concat(F.lit(f"{k}:"), c("c_custkey")) for k in CALL_SHALLOW_KEYS if k != "voiceMailUrl"}, **deep}
    call = F.map_from_arrays(F.array(*[F.lit(k) for k in entries]), F.array(*entries.values()))
    label = F.create_map(F.lit("name"), c("c_mktsegment"))
    return load(spark, sf, "customer").select(
        call.alias("leadCall"), label.alias("businessUnit"), c("c_custkey").alias("id"), c("c_name").alias("jobNumber"),
        c("c_nationkey").cast("bigint").alias("projectId"), F.lit("t1").alias("tenantId"), label.alias("type"))


CALL_SQL = {
    **{f"leadCall_{k}": f"'{k}:' || cast(c_custkey as varchar)" for k in CALL_SHALLOW_KEYS if k != "voiceMailUrl"},
    **{f"leadCall_customer_{k}": "'null'" for k in CALL_DEEP_KEYS["customer"]},
    "leadCall_customer_name": "c_name", "leadCall_customer_id": "cast(c_custkey as varchar)",
    "leadCall_customer_address": "'{street=Nation ' || cast(c_nationkey as varchar) || ', zip=1}'",
    "leadCall_customer_email": "'a@example.com'", "leadCall_customer_type": "c_mktsegment",
    "leadCall_customer_active": "cast(c_acctbal > 0 as varchar)",
    "leadCall_customer_importId": "case when c_mktsegment <> 'MACHINERY' then 'imp' end",
    "leadCall_campaign_name": "'Spring ''''24'''''", "leadCall_campaign_active": "'true'", "leadCall_campaign_modifiedOn": "'m'",
    "leadCall_campaign_id": "cast(c_nationkey as varchar)", "leadCall_campaign_category": "'{id=7, name=web}'",
    "leadCall_reason_name": "case when c_acctbal > 0 then c_mktsegment end",
    "leadCall_reason_active": "case when c_acctbal > 0 then 'true' end",
    "leadCall_reason_id": "case when c_acctbal > 0 then cast(c_custkey as varchar) end",
    "leadCall_reason_lead": "case when c_acctbal > 0 then 'false' end",
    "leadCall_agent_name": "'AnnLee'", "leadCall_agent_externalId": "'null'", "leadCall_agent_id": "cast(c_nationkey as varchar)",
}
CALL_COLUMNS = [f"leadCall_{k}" for k in CALL_SHALLOW_KEYS] + [
    f"leadCall_{p}_{k}" for p, keys in CALL_DEEP_KEYS.items() for k in keys]
CALL_ROWS_SQL = ("select c_custkey as id, c_name as \"jobNumber\", cast(c_nationkey as bigint) as \"projectId\", 't1' as \"tenantId\", "
                 + ", ".join(f'{CALL_SQL.get(k, "cast(null as varchar)")} as "{k}"' for k in CALL_COLUMNS) + " from customer")

registry.add("map_shallow_keys", "select c_custkey as id, " + ", ".join(
    f'{CALL_SQL.get(f"leadCall_{k}", "cast(null as varchar)")} as "leadCall_{k}"' for k in CALL_SHALLOW_KEYS) + " from customer")(
    lambda spark, sf: nested.shallow_keys(call_records(spark, sf)).select("id", *[f"leadCall_{k}" for k in CALL_SHALLOW_KEYS]))

registry.add("parse_ordered_struct", CALL_ROWS_SQL)(
    lambda spark, sf: nested.parse_calls(call_records(spark, sf)).select("id", "jobNumber", "projectId", "tenantId", *CALL_COLUMNS))
