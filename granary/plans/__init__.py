from granary.plans.bundle import import_bundle
from granary.plans.maintenance import layout_tables, snapshot_text
from granary.plans.preflight import preflight_products
from granary.plans.products import import_products
from granary.plans.verify import verify_database

__all__ = [
    "import_bundle", "import_products", "layout_tables", "preflight_products", "snapshot_text",
    "verify_database",
]
