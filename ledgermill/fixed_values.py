"""Values the results depend on. They are data, not logic, and are kept together here."""

# Names and order of the nine delivered columns.
BILLING_COLUMNS = [
    "billing_document",
    "item",
    "billing_type",
    "billing_date",
    "billing_qty_in_sku",
    "material",
    "item_description",
    "material_group",
    "assignment",
]
NUMBER_COLUMNS = ["billing_document", "item", "billing_qty_in_sku", "assignment"]

# Texts that mean NULL in a delivered file, and the date pattern used there.
NULL_TOKENS = ("NULL", "null", "")
DELIVERED_DATE_FORMAT = "M/d/yyyy"

# Fixed value: number of the first load.
FIRST_BATCH_ID = 1001

# Billing types.
INVOICE_TYPES = ("ZF2",)
RETURN_TYPES = ("ZRE", "S1")
BILLING_TYPE_NAMES = {
    "ZF2": "Sales Invoice",
    "ZRE": "Return/Credit Memo",
    "S1": "Sales Adjustment",
    "ZXP": "Export Sales",
}
OTHER_BILLING_TYPE = "Other"

# Product categories, in order of precedence.
CATEGORY_RULES = [
    (("BROILER",), "Broiler Feed"),
    (("LAYER",), "Layer Feed"),
    (("CATTLE", "CALF"), "Cattle Feed"),
    (("FISH",), "Fish Feed"),
    (("PIG",), "Pig Feed"),
    (("DESHI",), "Deshi Feed"),
]
OTHER_CATEGORY = "Other"

# Data-quality flags, in order of precedence.
MISSING_DOC_ID = "MISSING_DOC_ID"
INVALID_DATE = "INVALID_DATE"
INVALID_QUANTITY = "INVALID_QUANTITY"
MISSING_MATERIAL = "MISSING_MATERIAL"
VALID = "VALID"
