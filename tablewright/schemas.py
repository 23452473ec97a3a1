"""Record schemas, the dataset registry and its lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Record layouts, key orders and names that stored data already uses.
ITEM_KEYS = (
    "itemGroup", "assetAccount", "cost", "quantity", "serviceDate", "taxable", "displayName", "description",
    "soldHours", "inventory", "type", "membershipTypeId", "costOfSaleAccount", "skuName", "modifiedOn", "total",
    "price", "inventoryLocation", "id", "skuId", "totalCost", "order", "generalLedgerAccount",
)
ACCOUNT_KEYS = ("detailType", "name", "number", "type")
ITEM_NESTED_KEYS = {
    "itemGroup": ("name", "rootId"),
    "assetAccount": ACCOUNT_KEYS,
    "costOfSaleAccount": ACCOUNT_KEYS,
    "generalLedgerAccount": ACCOUNT_KEYS,
}
CALL_SHALLOW_KEYS = (
    "duration", "createdOn", "receivedOn", "direction", "to", "id", "callType", "recordingUrl", "from", "createdBy",
    "voiceMailUrl", "modifiedOn", "active",
)
CALL_DEEP_KEYS = {
    "customer": (
        "phoneSettings", "address", "customFields", "active", "doNotMail", "type", "createdOn", "memberships",
        "hasActiveMembership", "modifiedOn", "doNotService", "importId", "balance", "createdBy", "name", "id",
        "contacts", "email",
    ),
    "campaign": ("name", "active", "modifiedOn", "id", "category"),
    "reason": ("name", "active", "id", "lead"),
    "agent": ("name", "externalId", "id"),
}
INVOICE_MAP_KEYS = {
    "customer": ("id", "name"),
    "businessUnit": ("id", "name"),
    "batch": ("id", "name", "number"),
    "job": ("id", "number", "type"),
    "employeeInfo": ("id", "name", "modifiedOn"),
}
INVOICE_TYPED_KEYS = {
    "businessUnit_id": "int", "batch_number": "int", "job_number": "int",
    "customer_id": "bigint", "batch_id": "bigint", "job_id": "bigint", "employeeInfo_id": "bigint",
}
JOB_FILLED_IDS = ("recallForId", "warrantyId", "leadCallId", "bookingId", "soldById")
LEAD_SOURCE_KEYS = {"jobId": "generatedFromId", "employeeId": "generatedById"}

APPOINTMENT_DDL = """
    id bigint not null, jobId bigint, appointmentNumber string, start string, `end` string,
    arrivalWindowStart string, arrivalWindowEnd string, status string, specialInstructions string,
    createdOn string, modifiedOn string, tenantId string not null
"""
CUSTOMER_DDL = """
    id bigint not null, active boolean, name string, type string, address map<string,string>,
    customFields array<map<string,string>>, balance string, doNotMail boolean, doNotService boolean,
    createdOn string, createdById bigint, modifiedOn string, mergedToId bigint, tenantId string
"""
INVOICE_HEAD_DDL = """
    id bigint not null, syncStatus string, summary string, referenceNumber string, invoiceDate string,
    dueDate string, subTotal string, salesTax string, salesTaxCode map<string,string>, total string, balance string
"""
INVOICE_RAW_DDL = INVOICE_HEAD_DDL + """,
    customer map<string,string>, customerAddress map<string,string>, locationAddress map<string,string>,
    businessUnit map<string,string>, termName string, createdBy string, batch map<string,string>, modifiedOn string,
    adjustmentToId string, job map<string,string>, projectId string, royalty map<string,string>,
    employeeInfo map<string,string>, commissionEligibilityDate string, items string,
    customFields array<map<string,string>>, tenantId string not null
"""
INVOICE_DDL = INVOICE_HEAD_DDL + """,
    customerAddress map<string,string>, locationAddress map<string,string>, termName string, createdBy string,
    modifiedOn string, adjustmentToId string, projectId string, royalty map<string,string>,
    commissionEligibilityDate string, items string, customFields array<map<string,string>>, tenantId string not null,
    customer_name string, customer_id bigint, businessUnit_name string, businessUnit_id int, batch_name string,
    batch_number int, batch_id bigint, job_id bigint, job_number int, job_type string, employeeInfo_id bigint,
    employeeInfo_name string, employeeInfo_modifiedOn string
"""
JOB_RAW_DDL = """
    id bigint not null, jobNumber string not null, customerId bigint not null, locationId bigint not null,
    jobStatus string not null, completedOn string, businessUnitId bigint not null, jobTypeId bigint not null,
    priority string not null, campaignId bigint not null, summary string,
    customFields array<map<string,string>> not null, appointmentCount smallint not null,
    firstAppointmentId bigint not null, lastAppointmentId bigint not null, recallForId bigint, warrantyId bigint,
    jobGeneratedLeadSource map<string,string>, noCharge boolean not null, notificationsEnabled boolean not null,
    createdOn string not null, createdById bigint not null, modifiedOn string not null,
    tagTypeIds array<bigint> not null, leadCallId bigint, bookingId bigint, soldById bigint,
    externalData array<map<string,string>>, tenantId string not null
"""
JOB_DDL = JOB_RAW_DDL + ", generatedFromId string, generatedById string"
JOB_TAG_DDL = "jobId bigint not null, tenantId string not null, tagTypeId bigint not null"
TAG_TYPE_DDL = "id bigint not null, name string, active boolean, tenantId string not null"
CONTROL_DDL = "file_name string not null, file_location string, table_name string, date string"
CALL_RAW_DDL = """
    leadCall map<string,string> not null, businessUnit map<string,string>, id bigint not null, jobNumber string,
    projectId bigint not null, tenantId string not null, type map<string,string>
"""

DATASET_ALIASES = {
    "a": "appointments", "c": "calls", "cm": "memberships", "cr": "customers", "i": "invoices",
    "ii": "invoice-items", "invoice items": "invoice-items", "j": "jobs", "jtt": "job-tag-types",
    "m": "memberships", "tt": "tag-types", "tag types": "tag-types",
}
DATASET_TABLES = {
    "appointments": "appointment", "calls": "call", "customers": "customer", "invoices": "invoice",
    "invoice-items": "invoice_item", "jobs": "job", "job-tag-types": "job_tagtype", "memberships": "membership",
    "tag-types": "tagtype",
}
BUDGET_LIST_COLUMNS = (
    "RECORDNO", "BUDGETID", "DESCRIPTION", "SYSTEMGENERATED", "DEFAULT_BUDGET", "USER", "STATUS", "WHENCREATED",
    "WHENMODIFIED", "CREATEDBY", "MODIFIEDBY", "ISCONSOLIDATED", "CURRENCY", "ISPABUDGET", "MEGAENTITYKEY",
    "MEGAENTITYID", "MEGAENTITYNAME", "EXTERNALID", "RECORD_URL",
)
LAYERS = ("bronze", "silver", "gold")
# End of fixed values.


def from_ddl(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(" ".join(ddl.split()))


def _strings(names: list[str], required: tuple[str, ...] = ()) -> list[T.StructField]:
    return [T.StructField(n, T.StringType(), n not in required) for n in names]


def invoice_item_schema() -> T.StructType:
    plain = [k for k in ITEM_KEYS if k not in ITEM_NESTED_KEYS]
    nested = [f"{parent}_{k}" for parent, keys in ITEM_NESTED_KEYS.items() for k in keys]
    ids = [T.StructField("invoiceId", T.LongType(), False), T.StructField("tenantId", T.StringType(), False)]
    return T.StructType(_strings(plain + nested, ("id",)) + ids)


def call_schema() -> T.StructType:
    shallow = [f"leadCall_{k}" for k in CALL_SHALLOW_KEYS]
    deep = [f"leadCall_{parent}_{k}" for parent, keys in CALL_DEEP_KEYS.items() for k in keys]
    return T.StructType(from_ddl(CALL_RAW_DDL).fields + _strings(shallow + deep))


# memberships carries no declared layout: its frame keeps whatever types the pages have.
DATASET_SCHEMAS = {
    "appointments": lambda: from_ddl(APPOINTMENT_DDL),
    "calls": call_schema,
    "customers": lambda: from_ddl(CUSTOMER_DDL),
    "invoices": lambda: from_ddl(INVOICE_DDL),
    "invoice-items": invoice_item_schema,
    "jobs": lambda: from_ddl(JOB_DDL),
    "job-tag-types": lambda: from_ddl(JOB_TAG_DDL),
    "tag-types": lambda: from_ddl(TAG_TYPE_DDL),
}
RAW_SCHEMAS = {
    "invoices": lambda: from_ddl(INVOICE_RAW_DDL),
    "jobs": lambda: from_ddl(JOB_RAW_DDL),
    "calls": lambda: from_ddl(CALL_RAW_DDL),
}


def dataset_name(alias: str) -> str | None:
    key = alias.lower()
    return DATASET_ALIASES.get(key, key if key in DATASET_TABLES else None)


def dataset_schema(alias: str) -> T.StructType | None:
    build = DATASET_SCHEMAS.get(dataset_name(alias) or "")
    return build() if build else None


def raw_schema(alias: str) -> T.StructType | None:
    name = dataset_name(alias) or ""
    build = RAW_SCHEMAS.get(name) or DATASET_SCHEMAS.get(name)
    return build() if build else None


def dataset_table(alias: str) -> str | None:
    return DATASET_TABLES.get(dataset_name(alias) or "")


def _literal_map(entries: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def dataset_name_column(alias: Column) -> Column:
    """Column form of dataset_name: aliases resolve, canonical names pass, anything else is NULL."""
    entries = {**{name: name for name in DATASET_TABLES}, **DATASET_ALIASES}
    return F.try_element_at(_literal_map(entries), F.lower(alias))


def dataset_table_column(alias: Column) -> Column:
    return F.try_element_at(_literal_map(DATASET_TABLES), dataset_name_column(alias))


def page_schema(record: T.StructType) -> T.StructType:
    """Envelope of one page of a paged response."""
    relaxed = T.StructType([T.StructField(f.name, f.dataType, True) for f in record.fields])
    return T.StructType([
        T.StructField("page", T.LongType()),
        T.StructField("pageSize", T.IntegerType()),
        T.StructField("totalCount", T.LongType()),
        T.StructField("hasMore", T.BooleanType()),
        T.StructField("data", T.ArrayType(relaxed)),
    ])
