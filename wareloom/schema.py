"""Shapes and fixed values of the listing data model."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
WHOLE = T.LongType()
REAL = T.DoubleType()
FLAG = T.BooleanType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


NAMED = struct(id=TEXT, name=TEXT)

# One nested listing document per JSON line. The schema is explicit because
# inference reorders fields and the "keep the first column" rules depend on order.
LISTING_SCHEMA = struct(
    id=TEXT,
    title=TEXT,
    condition=TEXT,
    base_price=REAL,
    price=REAL,
    initial_quantity=WHOLE,
    sold_quantity=WHOLE,
    available_quantity=WHOLE,
    seller_id=WHOLE,
    site_id=TEXT,
    category_id=TEXT,
    currency_id=TEXT,
    listing_type_id=TEXT,
    buying_mode=TEXT,
    status=TEXT,
    accepts_mercadopago=FLAG,
    automatic_relist=FLAG,
    date_created=TEXT,
    last_updated=TEXT,
    start_time=TEXT,  # the two clock times come as text or as milliseconds
    stop_time=TEXT,
    sub_status=T.ArrayType(TEXT),
    deal_ids=T.ArrayType(TEXT),
    tags=T.ArrayType(TEXT),
    descriptions=T.ArrayType(TEXT),
    permalink=TEXT,
    thumbnail=TEXT,
    seller_address=struct(country=NAMED, state=NAMED, city=NAMED),
    shipping=struct(
        local_pick_up=FLAG,
        free_shipping=FLAG,
        mode=TEXT,
        free_methods=T.ArrayType(struct(id=WHOLE, rule=struct(value=TEXT, free_mode=TEXT))),
    ),
    non_mercado_pago_payment_methods=T.ArrayType(struct(id=TEXT, description=TEXT, type=TEXT)),
    variations=T.ArrayType(
        struct(
            id=WHOLE,
            attribute_combinations=T.ArrayType(struct(id=TEXT, name=TEXT, value_id=TEXT, value_name=TEXT)),
        )
    ),
    attributes=T.ArrayType(
        struct(
            id=TEXT,
            name=TEXT,
            attribute_group_id=TEXT,
            attribute_group_name=TEXT,
            value_id=TEXT,
            value_name=TEXT,
        )
    ),
    pictures=T.ArrayType(struct(id=TEXT, url=TEXT, size=TEXT)),
)

# --- fixed values -----------------------------------------------------------

# String lists that become one comma-joined text column.
TEXT_LISTS = ["sub_status", "deal_ids", "tags", "descriptions"]

# Lists of structs that multiply rows, with the prefix their fields receive.
STRUCT_LISTS = {
    "non_mercado_pago_payment_methods": "nmp_pm",
    "variations": "var",
    "attributes": "attr",
    "pictures": "pic",
}

# Structs whose fields become columns prefixed by the struct's own name.
PLAIN_STRUCTS = ["seller_address", "shipping"]

# Address parts that keep only their name.
NAMED_PARTS = ["seller_address_country", "seller_address_state", "seller_address_city"]

# Texts that mean "no value", compared exactly and before trimming.
NULL_TOKENS = ["ERROR", "", "None", "n/a", "N/A", "NULL", "NA", "NAN", "none", "null"]

# Flattened name -> business name.
BUSINESS_NAMES = {
    "seller_address_country": "country",
    "seller_address_state": "state",
    "seller_address_city": "city",
    "condition": "target",
    "base_price": "price",
    "shipping_local_pick_up": "local_pickup",
    "shipping_free_shipping": "free_shipping",
    "shipping_mode": "shipping_mode",
    "seller_id": "seller_id",
    "site_id": "site_id",
    "listing_type_id": "listing_type",
    "attr_attribute_group_id": "attribute_group_id",
    "attr_name": "attribute_name",
    "attr_attribute_group_name": "attribute_group",
    "attr_id": "attribute_id",
    "buying_mode": "buying_mode",
    "category_id": "category_id",
    "last_updated": "last_updated",
    "product_id": "product_id",
    "accepts_mercadopago": "accepts_mercadopago",
    "currency_id": "currency",
    "title": "title",
    "automatic_relist": "automatic_relist",
    "date_created": "date_created",
    "stop_time": "stop_time",
    "status": "status",
    "initial_quantity": "initial_quantity",
    "start_time": "start_time",
    "sold_quantity": "sold_quantity",
    "available_quantity": "available_quantity",
}

# Columns reduced to their most frequent value per entity (source -> output).
MODAL_COLUMNS = {
    "target": "condition",
    "state": "state",
    "city": "city",
    "local_pickup": "local_pickup",
    "free_shipping": "free_shipping",
    "shipping_mode": "shipping_mode",
    "listing_type": "listing_type",
    "buying_mode": "buying_mode",
    "attribute_group_id": "attribute_group_id",
    "attribute_group": "attribute_group",
    "attribute_id": "attribute_id",
    "status": "status",
    "accepts_mercadopago": "accepts_mercadopago",
    "currency": "currency",
    "automatic_relist": "automatic_relist",
    "title": "title",
}

# Columns of which an entity keeps one representative value.
FIRST_COLUMNS = ["last_updated", "date_created", "start_time", "stop_time"]

# Quantities summed per entity (source -> output).
SUM_COLUMNS = {
    "sold_quantity": "total_quantity",
    "initial_quantity": "stock_quantity",
    "available_quantity": "available_quantity",
}

# Intermediate columns the stored entity table does not keep.
HELPER_COLUMNS = ["unit_price", "total_quantity", "date_created", "last_updated", "start_time", "stop_time"]

TIME_COLUMNS = ["date_created", "last_updated", "start_time", "stop_time"]

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

WEEKDAY_LABELS = {
    "Monday": "Lunes",
    "Tuesday": "Martes",
    "Wednesday": "Miércoles",
    "Thursday": "Jueves",
    "Friday": "Viernes",
    "Saturday": "Sábado",
    "Sunday": "Domingo",
}
