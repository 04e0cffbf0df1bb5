"""The star-schema test tables, presented as the marketplace's raw relations.

Every attribute follows from a key or a stored value by integer arithmetic, so
the same rows can be stated in plain SQL. The result is as unclean as landed
text is: padded and upper-cased values, blanks for missing ones, numbers as
text, orders sent twice, and repeated line items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SECONDS = "yyyy-MM-dd HH:mm:ss"
ONE_BATCH = "1999-full"
CENTS = "decimal(18,2)"

# The public holidays every year gets. The second of November
# carries two, and one country is not the configured one.
HOLIDAYS = (
    (1, 1, "BR", "Ano Novo", "New Year"),
    (4, 21, "BR", "Tiradentes", "Tiradentes Day"),
    (7, 4, "US", "Independence Day", "Independence Day"),
    (9, 7, "BR", "Independencia", "Independence of Brazil"),
    (11, 2, "BR", "Finados", "All Souls"),
    (11, 2, "BR", "Dia Estadual", "State Day"),
    (12, 25, "BR", "Natal", "Christmas"),
)
PAYMENT_TYPES = {
    "1-URGENT": "credit_card",
    "2-HIGH": "boleto",
    "3-MEDIUM": "debit_card",
    "4-NOT SPECIFIED": "voucher",
    "5-LOW": "not_defined",
}
RESENT_PRIORITIES = ("1-URGENT", "2-HIGH")


def raw_relations(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    base = order_base(table("orders"))
    return {
        "orders": raw_orders(base),
        "order_items": raw_order_items(table("lineitem")),
        "order_payments": raw_order_payments(base),
        "order_reviews": raw_order_reviews(base),
        "customers": raw_customers(base, table("customer"), table("nation")),
        "sellers": raw_sellers(table("supplier"), table("nation"), table("region")),
        "products": raw_products(table("part")),
        "geolocation": raw_geolocation(table("customer"), table("nation")),
        "holidays": raw_holidays(base),
        "weather_daily": raw_weather_daily(base),
    }


def order_base(orders: DataFrame) -> DataFrame:
    """Order keys with the lifecycle each order is given."""
    k, day = F.col("k"), F.col("d")
    status = (
        F.when(F.col("o_orderstatus") == "O", "shipped")
        .when((F.col("o_orderstatus") == "P") & (k % 4 == 0), "canceled")
        .otherwise("delivered")
    )
    delivered_day = F.when(
        (F.col("status") == "delivered") & (k % 97 != 0),
        F.date_add(day, (5 + (k * 7) % 40).cast("int")),
    )
    return (
        orders.withColumn("k", F.col("o_orderkey"))
        .withColumn("d", F.to_date("o_orderdate"))
        .withColumn("status", status)
        .withColumn("delivered_day", delivered_day)
        .withColumn("due_day", F.when(k % 101 != 0, F.date_add(day, 20)))
    )


def _text(value: Column) -> Column:
    return value.cast("string")


def _lineage(batch: Column, day: Column, file_name: str) -> list[Column]:
    return [
        batch.alias("batch_id"),
        day.cast("timestamp").alias("ingested_at_utc"),
        F.lit(file_name).alias("source_file_name"),
    ]


def _at(day: Column, clock: str) -> Column:
    """Day and time of day as text, blank without a day."""
    return F.coalesce(F.concat(_text(day), F.lit(f" {clock}")), F.lit(""))


def _bought_at() -> Column:
    seconds = (F.col("k") % 86400).cast("int")
    instant = F.col("d").cast("timestamp") + F.make_dt_interval(secs=seconds)
    return F.date_format(instant, SECONDS)


def raw_orders(base: DataFrame) -> DataFrame:
    """All orders as last known; urgent and high ones also as first seen."""
    month = F.date_format("d", "yyyy-MM")
    last_known = base.select(
        F.concat(F.lit(" "), _text(F.col("k"))).alias("order_id"),
        _text(F.col("k")).alias("customer_id"),
        F.concat(F.lit("\t"), F.upper("status"), F.lit(" ")).alias("order_status"),
        _bought_at().alias("order_purchase_timestamp"),
        _at(F.when(F.col("k") % 89 != 0, F.col("d")), "23:59:59").alias("order_approved_at"),
        _at(F.when(F.col("status") != "canceled", F.date_add("d", 2)), "08:00:00").alias(
            "order_delivered_carrier_date"
        ),
        _at(F.col("delivered_day"), "15:30:00").alias("order_delivered_customer_date"),
        _at(F.col("due_day"), "00:00:00").alias("order_estimated_delivery_date"),
        *_lineage(F.concat(month, F.lit("b")), F.date_add("d", 60), "orders_dataset.csv"),
    )
    blank = F.lit("")
    first_seen = base.filter(F.col("o_orderpriority").isin(*RESENT_PRIORITIES)).select(
        _text(F.col("k")).alias("order_id"),
        _text(F.col("k")).alias("customer_id"),
        F.lit("created").alias("order_status"),
        _bought_at().alias("order_purchase_timestamp"),
        blank.alias("order_approved_at"),
        blank.alias("order_delivered_carrier_date"),
        blank.alias("order_delivered_customer_date"),
        blank.alias("order_estimated_delivery_date"),
        *_lineage(F.concat(month, F.lit("a")), F.date_add("d", 1), "orders_dataset.csv"),
    )
    return last_known.unionByName(first_seen)


def raw_order_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        _text(F.col("l_orderkey")).alias("order_id"),
        _text(F.col("l_linenumber")).alias("order_item_id"),
        _text(F.col("l_partkey")).alias("product_id"),
        _text(F.col("l_suppkey")).alias("seller_id"),
        F.date_format("l_shipdate", SECONDS).alias("shipping_limit_date"),
        _text(F.col("l_extendedprice").cast(CENTS)).alias("price"),
        _text(F.col("l_quantity").cast(CENTS)).alias("freight_value"),
        *_lineage(
            F.date_format("l_shipdate", "yyyyMMdd"),
            F.to_date("l_shipdate"),
            "order_items_dataset.csv",
        ),
    )


def raw_order_payments(base: DataFrame) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    second = F.when(F.col("k") % 3 == 0, F.floor(cents / 4).cast("bigint")).otherwise(F.lit(0))
    kind = F.coalesce(
        *[F.when(F.col("o_orderpriority") == p, F.lit(t)) for p, t in PAYMENT_TYPES.items()]
    )

    def payment(number: int, type_: Column, value: Column) -> Column:
        return F.struct(
            F.lit(str(number)).alias("payment_sequential"),
            F.concat(F.upper(type_), F.lit("  ")).alias("payment_type"),
            _text((value / 100).cast(CENTS)).alias("payment_value"),
        )

    payments = F.array_compact(
        F.array(
            payment(1, kind, cents - second),
            F.when(F.col("k") % 3 == 0, payment(2, F.lit("voucher"), second)),
        )
    )
    return (
        base.filter(F.col("k") % 50 != 0)
        .select("k", "d", F.explode(payments).alias("p"))
        .select(
            _text(F.col("k")).alias("order_id"),
            "p.payment_sequential",
            "p.payment_type",
            _text(1 + F.col("k") % 12).alias("payment_installments"),
            "p.payment_value",
            *_lineage(F.date_format("d", "yyyy-MM"), F.col("d"), "order_payments_dataset.csv"),
        )
    )


def raw_order_reviews(base: DataFrame) -> DataFrame:
    k = F.col("k")
    created = F.coalesce(
        F.date_add("delivered_day", (k % 9 - 2).cast("int")), F.date_add("d", 30)
    )

    def review(prefix: str, score: Column) -> Column:
        return F.struct(
            F.concat(F.lit(prefix), _text(k)).alias("review_id"), _text(score).alias("review_score")
        )

    reviews = F.array_compact(
        F.array(
            review("r", 1 + k % 5),
            F.when(k % 11 == 0, review("s", 1 + (k * 3) % 5)),
        )
    )
    message = (
        F.when(k % 2 == 0, F.lit(None).cast("string"))
        .when(k % 7 == 0, F.lit(" \t "))
        .otherwise(F.concat(F.lit(" about order "), _text(k), F.lit("\n")))
    )
    return (
        base.filter(k % 3 != 0)
        .select("k", "d", created.alias("created"), F.explode(reviews).alias("r"))
        .select(
            "r.review_id",
            _text(k).alias("order_id"),
            "r.review_score",
            F.lit(" ").alias("review_comment_title"),
            message.alias("review_comment_message"),
            _at(F.col("created"), "00:00:00").alias("review_creation_date"),
            _at(F.date_add("created", 1), "12:00:00").alias("review_answer_timestamp"),
            *_lineage(
                F.date_format("created", "yyyy-MM"), F.col("created"), "order_reviews_dataset.csv"
            ),
        )
    )


def raw_customers(base: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """A customer id per order, all pointing at the person who ordered.

    The hint keeps Spark from broadcasting the orders: with customers in one split, one task
    would then make and sort the rows of all orders.
    """
    people = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_mktsegment", "n_name"
    )
    return base.join(people.hint("merge"), F.col("o_custkey") == F.col("c_custkey")).select(
        _text(F.col("k")).alias("customer_id"),
        _text(F.col("o_custkey")).alias("customer_unique_id"),
        _text(F.col("c_custkey") + F.col("k") % 3).alias("customer_zip_code_prefix"),
        F.concat(F.lit("\t"), "c_mktsegment", F.lit(" ")).alias("customer_city"),
        F.lower("n_name").alias("customer_state"),
        *_lineage(F.date_format("d", "yyyy-MM"), F.col("d"), "customers_dataset.csv"),
    )


def raw_sellers(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    city = F.when(F.col("s_suppkey") % 10 == 0, F.lit(" ")).otherwise(F.col("r_name"))
    return supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        _text(F.col("s_suppkey")).alias("seller_id"),
        _text(10000 + F.col("s_suppkey")).alias("seller_zip_code_prefix"),
        city.alias("seller_city"),
        F.lower("n_name").alias("seller_state"),
        *_lineage(F.lit(ONE_BATCH), F.lit("1999-01-01").cast("date"), "sellers_dataset.csv"),
    )


def raw_products(part: DataFrame) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size").cast("bigint")

    def measure(value: Column) -> Column:
        return _text(value.cast("double"))

    return part.select(
        _text(key).alias("product_id"),
        F.when(key % 17 == 0, F.lit("")).otherwise(F.col("p_type")).alias("product_category_name"),
        measure(F.length("p_name")).alias("product_name_lenght"),
        measure(size * 10).alias("product_description_lenght"),
        measure(1 + key % 6).alias("product_photos_qty"),
        measure(size * 100).alias("product_weight_g"),
        measure(size + 0.5).alias("product_length_cm"),
        measure(size + 1).alias("product_height_cm"),
        measure(size + 2).alias("product_width_cm"),
        *_lineage(F.lit(ONE_BATCH), F.lit("1999-01-01").cast("date"), "products_dataset.csv"),
    )


def raw_geolocation(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Positions by customer; customers of one area share an observation."""
    area = F.col("c_custkey") % 500
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        _text(area).alias("geolocation_zip_code_prefix"),
        _text(-20 - area / 100).alias("geolocation_lat"),
        _text(-40 - F.col("c_nationkey") / 4).alias("geolocation_lng"),
        F.concat("c_mktsegment", F.lit(" ")).alias("geolocation_city"),
        F.lower("n_name").alias("geolocation_state"),
        *_lineage(
            F.concat(F.lit("g"), _text(F.floor(F.col("c_custkey") / 500))),
            F.date_add(F.lit("1999-01-01"), F.floor(F.col("c_custkey") / 500).cast("int")),
            "geolocation_dataset.csv",
        ),
    )


def raw_holidays(base: DataFrame) -> DataFrame:
    """The fixed holidays in every year that has orders."""
    listed = F.array(
        *[
            F.struct(
                F.lit(month).alias("month"),
                F.lit(day).alias("day"),
                F.lit(country.lower()).alias("country_code"),
                F.lit(local).alias("local_name"),
                F.lit(name).alias("holiday_name"),
            )
            for month, day, country, local, name in HOLIDAYS
        ]
    )
    years = base.select(F.year("d").alias("year")).distinct()
    return years.select("year", F.explode(listed).alias("h")).select(
        _text(F.make_date("year", "h.month", "h.day")).alias("holiday_date"),
        "h.local_name",
        F.concat(F.col("h.holiday_name"), F.lit(" ")).alias("holiday_name"),
        "h.country_code",
        F.lit("true").alias("is_global"),
        F.lit(None).cast("string").alias("counties_json"),
        F.lit('["Public"]').alias("holiday_types_json"),
        F.lit(None).cast("string").alias("launch_year"),
        *_lineage(F.lit(ONE_BATCH), F.make_date("year", F.lit(1), F.lit(1)), "holidays.json"),
    )


def raw_weather_daily(base: DataFrame) -> DataFrame:
    """Days from the first to the last delivery, at the configured place and another.

    The hundredth day of each year is missing, as a gap the checks should find.
    """
    days = (
        base.agg(F.min("delivered_day").alias("first"), F.max("delivered_day").alias("last"))
        .select(F.explode(F.sequence("first", "last")).alias("day"))
        .withColumn("doy", F.dayofyear("day"))
        .filter("doy <> 100")
    )
    places = F.explode(F.array(F.lit("Sao_Paulo "), F.lit("elsewhere"))).alias("location_key")
    doy = F.col("doy")

    def measure(value: Column) -> Column:
        return _text(value.cast("double"))

    return days.select("day", "doy", places).select(
        _text(F.col("day")).alias("weather_date"),
        "location_key",
        F.lit("-23.5").alias("latitude"),
        F.lit("-46.6").alias("longitude"),
        F.lit("-03:00").alias("timezone"),
        F.lit("METRIC").alias("units"),
        measure(doy % 101).alias("cloud_cover_afternoon"),
        measure(40 + doy % 50).alias("humidity_afternoon"),
        measure(F.when(doy % 13 != 0, doy % 8)).alias("precipitation_total"),
        measure(7 + doy % 20).alias("temperature_min"),
        measure(15 + doy % 20).alias("temperature_max"),
        measure(14 + doy % 20).alias("temperature_afternoon"),
        measure(9 + doy % 20).alias("temperature_night"),
        measure(12 + doy % 20).alias("temperature_evening"),
        measure(8 + doy % 20).alias("temperature_morning"),
        measure(1000 + doy % 30).alias("pressure_afternoon"),
        measure(doy % 17).alias("wind_max_speed"),
        measure(doy % 360).alias("wind_max_direction"),
        *_lineage(F.date_format("day", "yyyy-MM"), F.col("day"), "weather.json"),
    )
