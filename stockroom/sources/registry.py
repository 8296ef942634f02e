"""The nine operational entities and the columns each one carries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Fields every entity carries.
COMMON_FIELDS = "created_at timestamp, updated_at timestamp"


@dataclass(frozen=True)
class EntitySpec:
    """How one entity is fetched, keyed, bounded and typed."""

    name: str
    columns: str
    key: str = "id"
    cursor: str = "updated_at"

    @property
    def endpoint(self) -> str:
        return self.name

    @property
    def schema(self) -> T.StructType:
        """Typed columns after flattening."""
        return T.StructType.fromDDL(f"{self.columns}, {COMMON_FIELDS}")


# Entity columns as the models read them.
ENTITIES: dict[str, EntitySpec] = {
    spec.name: spec
    for spec in (
        EntitySpec(
            "stores",
            "id string, name string, city string, state string, address string, phone string, "
            "manager_name string, opened_date date",
        ),
        EntitySpec(
            "employees",
            "id string, store_id string, first_name string, last_name string, email string, "
            "role string, hired_date date, is_deleted boolean",
        ),
        EntitySpec(
            "payment_methods", "id string, name string, provider string, is_digital boolean"
        ),
        EntitySpec(
            "customers",
            "id string, first_name string, last_name string, email string, phone string, "
            "address string, city string, state string, segment string, tier string, "
            "effective_from timestamp, registered_at timestamp, is_deleted boolean",
        ),
        EntitySpec(
            "products",
            "id string, name string, sku string, category string, sub_category string, "
            "brand string, supplier string, selling_price double, cost_price double, "
            "effective_from timestamp, is_deleted boolean",
        ),
        EntitySpec(
            "orders",
            "id string, customer_id string, store_id string, employee_id string, status string, "
            "discount_code string, total_amount double, discount_amount double, "
            "ordered_at timestamp, paid_at timestamp, shipped_at timestamp, "
            "delivered_at timestamp, cancelled_at timestamp",
        ),
        EntitySpec(
            "order_items",
            "id string, order_id string, product_id string, quantity bigint, unit_price double, "
            "discount_pct double, line_total double",
        ),
        EntitySpec(
            "payments",
            "id string, order_id string, customer_id string, payment_method_id string, "
            "status string, payment_type string, currency string, reference string, "
            "amount_paid double, paid_at timestamp",
        ),
        EntitySpec(
            "inventory_movements",
            "id string, product_id string, store_id string, movement_type string, "
            "reference_type string, reference_id string, notes string, quantity bigint, "
            "moved_at timestamp",
        ),
    )
}
