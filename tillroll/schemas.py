"""Fixed schemas of the data the jobs read and write.

Nothing is inferred: every read names its schema, and everything stays text
until the last projection of a job.
"""

# OCR output for one file: documents > fields, and documents > groups > items > fields.
EXPENSE_RESPONSE = """
    ExpenseDocuments ARRAY<STRUCT<
        SummaryFields: ARRAY<STRUCT<
            Type: STRUCT<Text: STRING>,
            LabelDetection: STRUCT<Text: STRING, Confidence: DOUBLE>,
            ValueDetection: STRUCT<Text: STRING, Confidence: DOUBLE>>>,
        LineItemGroups: ARRAY<STRUCT<
            LineItems: ARRAY<STRUCT<
                LineItemExpenseFields: ARRAY<STRUCT<
                    Type: STRUCT<Text: STRING>,
                    ValueDetection: STRUCT<Text: STRING, Confidence: DOUBLE>>>>>>>>>
"""

# Object-created notification.
NOTIFICATION = """
    Records ARRAY<STRUCT<s3: STRUCT<
        bucket: STRUCT<name: STRING>,
        object: STRUCT<key: STRING, versionId: STRING, sequencer: STRING, eTag: STRING>>>>
"""

# An envelope is a flat JSON object whose bags are JSON text inside JSON text.
# A map keeps key case and passes unknown keys through.
ENVELOPE_MAP = "MAP<STRING, STRING>"

# Key/value bag as the receipt job reads it: nested lists become their JSON text.
KV_BAG = "Type ARRAY<STRING>, Key ARRAY<STRING>, Value ARRAY<STRING>"

# Key/value bag as the enrichment rewrites it: mixed element types stay as they are.
KV_BAG_VARIANT = """
    Type ARRAY<STRING>, Key ARRAY<STRING>, Value ARRAY<VARIANT>,
    KeyConfidence ARRAY<VARIANT>, ValueConfidence ARRAY<VARIANT>
"""

LINEITEM_BAG_VARIANT = "items VARIANT, price VARIANT, quantity VARIANT"

LINEITEM_BAG = "items ARRAY<STRING>, price ARRAY<STRING>, quantity ARRAY<STRING>"

# Extra field that receives the raw text when JSON does not parse.
CORRUPT = "_corrupt"

LINEITEM_RAW = (
    "ITEMS ARRAY<STRING>, PRICE ARRAY<STRING>, QUANTITY ARRAY<STRING>, SESSIONIDS STRING"
)

# Target tables, in column order.
KEYVALUE = (
    "TOTAL_AMOUNT DOUBLE, STOREID STRING, TENANTIDS STRING, SESSIONID STRING, "
    "NAME STRING, DATES DATE, ADDRESS STRING, MOBILE BIGINT"
)
LINEITEM = "ITEMS STRING, PRICE DOUBLE, QUANTITY DOUBLE, SESSIONID STRING"

# Labels a receipt row keeps after the pivot.
RECEIPT_LABELS = [
    "ITEMS",
    "PRICE",
    "QUANTITY",
    "TOTALAMOUNT",
    "DATE",
    "USER",
    "SESSIONIDS",
    "STOREIDS",
    "TENANTIDS",
    "ADDRESS",
    "MOBILE",
]

# Entries the enrichment appends to the key/value bag, used as Type and as Key.
APPENDED_ENTRIES = [
    "items",
    "price",
    "quantity",
    "tenant_ids",
    "session_ids",
    "store_ids",
    "total_amount",
]
