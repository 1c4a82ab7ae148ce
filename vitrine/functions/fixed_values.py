"""Values that results depend on and that no rule can derive."""

# The file name of each raw table of the public Brazilian marketplace dataset.
RAW_FILES = {
    "orders": "olist_orders_dataset",
    "order_items": "olist_order_items_dataset",
    "order_payments": "olist_order_payments_dataset",
    "order_reviews": "olist_order_reviews_dataset",
    "customers": "olist_customers_dataset",
    "sellers": "olist_sellers_dataset",
    "products": "olist_products_dataset",
    "geolocation": "olist_geolocation_dataset",
    "category_translation": "product_category_name_translation",
}

# Raw table, label in the grain audit, columns its grain is checked on.
GRAIN_AUDIT = [
    ("orders", "olist_orders", ["order_id"]),
    ("order_items", "olist_order_items", ["order_id", "order_item_id"]),
    ("order_payments", "olist_order_payments", ["order_id", "payment_sequential"]),
    ("order_reviews", "olist_order_reviews", ["review_id"]),
    ("customers", "olist_customers", ["customer_id"]),
    ("products", "olist_products", ["product_id"]),
    ("sellers", "olist_sellers", ["seller_id"]),
    ("category_translation", "product_category_translation", ["product_category_name"]),
    ("geolocation", "olist_geolocation", ["geolocation_zip_code_prefix"]),
]

# Dataset and key column of the ten unique and ten not-null tests.
KEY_TESTS = [
    ("raw_orders", "order_id"),
    ("raw_customers", "customer_id"),
    ("raw_sellers", "seller_id"),
    ("raw_products", "product_id"),
    ("stg_orders", "order_id"),
    ("stg_customers", "customer_id"),
    ("stg_sellers", "seller_id"),
    ("stg_geolocation", "zip_code_prefix"),
    ("mart_orders_wide", "order_id"),
    ("mart_sellers_wide", "seller_id"),
]

# Statuses an order may have in the public dataset, and those that bring no revenue.
ORDER_STATUSES = [
    "approved", "canceled", "created", "delivered",
    "invoiced", "processing", "shipped", "unavailable",
]
UNRECOGNIZED_STATUSES = ["canceled", "unavailable"]
REVIEW_SCORES = [1, 2, 3, 4, 5]
SATISFIED_FROM = 4

# First incomplete year of the dataset, left out of the monthly series.
INCOMPLETE_YEARS = (2016,)

# Centre of each Brazilian state (state, latitude, longitude).
STATE_CENTRES = [
    ("AC", -8.77, -70.55),
    ("AL", -9.71, -35.73),
    ("AM", -3.47, -65.10),
    ("AP", 1.41, -51.77),
    ("BA", -12.96, -38.51),
    ("CE", -3.71, -38.54),
    ("DF", -15.83, -47.86),
    ("ES", -19.19, -40.34),
    ("GO", -16.64, -49.31),
    ("MA", -2.55, -44.30),
    ("MT", -12.64, -55.42),
    ("MS", -20.51, -54.54),
    ("MG", -18.10, -44.38),
    ("PA", -5.53, -52.29),
    ("PB", -7.06, -36.07),
    ("PR", -24.89, -51.55),
    ("PE", -8.28, -35.07),
    ("PI", -8.28, -43.68),
    ("RJ", -22.84, -43.15),
    ("RN", -5.81, -36.59),
    ("RS", -30.04, -51.14),
    ("RO", -10.83, -63.34),
    ("RR", 1.99, -61.33),
    ("SC", -27.33, -49.44),
    ("SP", -23.55, -46.64),
    ("SE", -10.90, -37.07),
    ("TO", -10.25, -48.25),
]
