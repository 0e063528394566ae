"""The nine source tables: schema, key, owning system and how each is loaded."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
RATE = T.DecimalType(5, 4)

_LONG, _INT, _TEXT, _DATE, _TIME = (
    T.LongType(),
    T.IntegerType(),
    T.StringType(),
    T.DateType(),
    T.TimestampNTZType(),
)
_AUDIT = [("created_at", _TIME), ("updated_at", _TIME)]
_ADDRESS = [(name, _TEXT) for name in ("street", "city", "state", "zip_code")]


@dataclass(frozen=True)
class Table:
    name: str
    system: str
    key: tuple[str, ...]
    schema: T.StructType
    snapshot: bool = False
    # Columns whose change opens a new version (type 2 history); none: no history.
    tracked: tuple[str, ...] = ()
    # Whole-number column to split a parallel read by; none: the first key column.
    split: str | None = None

    @property
    def split_column(self) -> str:
        return self.split or self.key[0]

    @property
    def csv_columns(self) -> list[str]:
        """Columns a CSV file carries; the audit columns take defaults."""
        return [c for c in self.schema.names if c not in ("created_at", "updated_at")]


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in [*columns, *_AUDIT]])


_ALL = [
    Table("categories", "mysql", ("category_id",),
          _schema(("category_id", _LONG), ("category_name", _TEXT))),
    Table("brands", "mysql", ("brand_id",),
          _schema(("brand_id", _LONG), ("brand_name", _TEXT))),
    Table("products", "mysql", ("product_id",),
          _schema(("product_id", _LONG), ("product_name", _TEXT), ("brand_id", _LONG),
                  ("category_id", _LONG), ("model_year", _INT), ("list_price", MONEY)),
          tracked=("list_price",)),
    Table("customers", "postgres", ("customer_id",),
          _schema(("customer_id", _LONG), ("first_name", _TEXT), ("last_name", _TEXT),
                  ("phone", _TEXT), ("email", _TEXT), *_ADDRESS),
          tracked=("email", "street", "city", "state", "zip_code")),
    Table("stores", "postgres", ("store_id",),
          _schema(("store_id", _LONG), ("store_name", _TEXT), ("phone", _TEXT),
                  ("email", _TEXT), *_ADDRESS)),
    Table("staffs", "postgres", ("staff_id",),
          _schema(("staff_id", _LONG), ("first_name", _TEXT), ("last_name", _TEXT),
                  ("email", _TEXT), ("phone", _TEXT), ("active", _INT),
                  ("store_id", _LONG), ("manager_id", _LONG)),
          tracked=("store_name", "manager_first_name", "manager_last_name")),
    Table("orders", "postgres", ("order_id",),
          _schema(("order_id", _LONG), ("customer_id", _LONG), ("order_status", _INT),
                  ("order_date", _DATE), ("required_date", _DATE), ("shipped_date", _DATE),
                  ("store_id", _LONG), ("staff_id", _LONG))),
    Table("order_items", "postgres", ("order_id", "item_id"),
          _schema(("order_id", _LONG), ("item_id", _LONG), ("product_id", _LONG),
                  ("quantity", MONEY), ("list_price", MONEY), ("discount", RATE))),
    Table("stocks", "mysql", ("store_id", "product_id"),
          _schema(("store_id", _LONG), ("product_id", _LONG), ("quantity", MONEY)),
          snapshot=True, split="product_id"),
]

TABLES: dict[str, Table] = {t.name: t for t in _ALL}
