"""The eight landing sources: their columns and the file each one arrives in."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

METADATA = ("batch_id", "ingested_at_utc", "source_file_name")


@dataclass(frozen=True)
class SourceSpec:
    """One landing source.

    ``file_suffix`` is how the file name ends; any publisher prefix may precede it.
    """

    name: str
    file_suffix: str
    columns: tuple[str, ...]

    @property
    def multi_line(self) -> bool:
        """Only review texts hold line breaks."""
        return "review_comment_message" in self.columns

    @property
    def schema(self) -> T.StructType:
        """Raw columns are read as text and typed in staging: no inference pass."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


def _spec(name: str, file_suffix: str, columns: str) -> SourceSpec:
    return SourceSpec(name, file_suffix, tuple(columns.split()))


# Column names and file names of the landing contract, misspelled
# words included.
SOURCES = {
    spec.name: spec
    for spec in (
        _spec(
            "orders",
            "orders_dataset.csv",
            "order_id customer_id order_status order_purchase_timestamp order_approved_at "
            "order_delivered_carrier_date order_delivered_customer_date "
            "order_estimated_delivery_date",
        ),
        _spec(
            "order_items",
            "order_items_dataset.csv",
            "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
        ),
        _spec(
            "order_payments",
            "order_payments_dataset.csv",
            "order_id payment_sequential payment_type payment_installments payment_value",
        ),
        _spec(
            "order_reviews",
            "order_reviews_dataset.csv",
            "review_id order_id review_score review_comment_title review_comment_message "
            "review_creation_date review_answer_timestamp",
        ),
        _spec(
            "customers",
            "customers_dataset.csv",
            "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state",
        ),
        _spec(
            "sellers",
            "sellers_dataset.csv",
            "seller_id seller_zip_code_prefix seller_city seller_state",
        ),
        _spec(
            "products",
            "products_dataset.csv",
            "product_id product_category_name product_name_lenght product_description_lenght "
            "product_photos_qty product_weight_g product_length_cm product_height_cm "
            "product_width_cm",
        ),
        _spec(
            "geolocation",
            "geolocation_dataset.csv",
            "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city "
            "geolocation_state",
        ),
    )
}


def source_of_file(file_name: str) -> str | None:
    """Source a landing file belongs to, None when it is not recognised."""
    for spec in SOURCES.values():
        if file_name == spec.file_suffix:
            return spec.name
        prefix = file_name.removesuffix(f"_{spec.file_suffix}")
        if prefix != file_name and prefix.isalnum():
            return spec.name
    return None


def file_pattern(spec: SourceSpec) -> str:
    """The same rule as a regular expression over a whole file name."""
    return r"(?:[A-Za-z0-9]+_)?" + spec.file_suffix.replace(".", r"\.")
