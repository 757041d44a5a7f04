"""The five hotel feeds as Spark derives them from the provided tables.

The rules (dirty values, duplicates, date shift) are written down in
FIXTURES.md; each function returns an all-text RAW frame in file order, or, with
``spread``, in any order from tasks on all cores.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from innlake.sources.provided import table
from innlake.sources.schemas import RAW_COLUMNS

DAY_SHIFT = 10400


def _text(value) -> Column:
    return F.lit(value).cast("string")


def _tagged(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _day(start: Column, days: Column | int) -> Column:
    return F.date_add(start.cast("date"), F.lit(days) if isinstance(days, int) else days)


def _room_count(spark: SparkSession, sf_dir: str) -> Column:
    return table(spark, sf_dir, "part").agg(F.count(F.lit(1))).scalar()


def _arrange(df: DataFrame, domain: str) -> DataFrame:
    return df.select(*RAW_COLUMNS[domain])


def guests(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    k = F.col("c_custkey")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    customer = table(spark, sf_dir, "customer", "c_custkey" if spread else None)
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    main = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        _tagged("G", k).alias("guest_id"),
        F.col("c_name").alias("name"),
        F.when(k % 31 == 0, "31/12/1980")
        .otherwise(F.date_add(F.lit("1950-01-01").cast("date"), (k * 7).cast("int")).cast("string"))
        .alias("dob"),
        F.when(k % 2 == 0, "F").otherwise("M").alias("gender"),
        F.when(k % 37 == 0, "not-an-email")
        .when(k % 41 == 0, _text(None))
        .when(k % 43 == 0, "ab@x.com")
        .otherwise(F.concat(_tagged("guest", k), F.lit("@mail.example")))
        .alias("email"),
        _tagged("+1555", 1000000 + k).alias("phone"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit(" Main St")).alias("address"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Gold")
        .when(F.col("c_mktsegment") == "MACHINERY", "Silver")
        .otherwise("Bronze")
        .alias("loyalty_tier"),
        F.date_add(F.lit("2018-01-01").cast("date"), k.cast("int")).cast("string").alias("registration_date"),
    )
    nothing = _text(None)
    second = customer.filter(k % 20 == 0).select(
        _tagged("G", k).alias("guest_id"),
        F.concat("c_name", F.lit(" (dup)")).alias("name"),
        nothing.alias("dob"),
        nothing.alias("gender"),
        F.concat(_tagged("dup", k), F.lit("@mail.example")).alias("email"),
        *[nothing.alias(c) for c in ("phone", "address", "city", "country")],
        _text("Gold").alias("loyalty_tier"),
        nothing.alias("registration_date"),
    )
    keyless = spark.range(2).select(
        F.when(F.col("id") == 0, "  ").alias("guest_id"),
        F.when(F.col("id") == 0, "blank key").otherwise("null key").alias("name"),
        _text("x@y.zz").alias("email"),
        *[nothing.alias(c) for c in RAW_COLUMNS["guests"] if c not in ("guest_id", "name", "email")],
    )
    return _arrange(main, "guests").unionByName(second).unionByName(keyless)


def rooms(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    price = F.col("p_retailprice").cast("decimal(10,2)") - F.lit(850).cast("decimal(10,2)")
    return table(spark, sf_dir, "part", "p_partkey" if spread else None).select(
        _tagged("RM", k).alias("room_id"),
        _tagged("H", k % 20).alias("hotel_id"),
        F.col("p_type").alias("room_type"),
        F.when(k % 29 == 0, "G").otherwise(size.cast("string")).alias("floor"),
        F.when(k % 53 == 0, "0")
        .when(k % 59 == 0, "2.5")
        .otherwise((1 + size % 4).cast("string"))
        .alias("capacity"),
        F.col("p_name").alias("amenities"),
        F.when(k % 3 == 0, " available")
        .when(k % 3 == 1, "OCCUPIED ")
        .otherwise("out_of_order")
        .alias("status"),
        F.when(k % 61 == 0, "-5").otherwise(price.cast("string")).alias("base_price"),
    )


def reservations(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    k, c, day, status = (F.col(f"o_{n}") for n in ("orderkey", "custkey", "orderdate", "orderstatus"))
    orders = table(spark, sf_dir, "orders", "o_orderkey" if spread else None)
    in_burst = (c % 10 == 0) & ~((c % 20 == 0) & (k % 5 == 0))
    burst = F.concat(F.lit("2026-03-01 "), F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":15:00"))
    stray = F.concat(_day(day, (DAY_SHIFT - c % 9).cast("int")).cast("string"), F.lit(" 12:00:00"))
    main = orders.select(
        _tagged("RS", k).alias("reservation_id"),
        F.when(k % 101 == 0, _text(None))
        .when(k % 97 == 0, "G999999999")
        .otherwise(_tagged("G", c))
        .alias("guest_id"),
        _tagged("RM", (k * 7 + c) % _room_count(spark, sf_dir)).alias("room_id"),
        F.when(k % 103 == 0, "2025-02-30")
        .otherwise(_day(day, DAY_SHIFT).cast("string"))
        .alias("check_in_date"),
        _day(day, (DAY_SHIFT + k % 15).cast("int")).cast("string").alias("check_out_date"),
        F.col("o_orderpriority").alias("booking_channel"),
        F.concat(_day(day, (DAY_SHIFT - c % 60).cast("int")).cast("string"), F.lit(" 09:30:00")).alias("booking_time"),
        F.when((status == "P") & (k % 4 != 0), F.when(in_burst, burst).otherwise(stray)).alias("cancellation_time"),
        F.when(status == "F", " confirmed ")
        .when(status == "O", "CONFIRMED")
        .when(k % 4 == 0, "no_show")
        .otherwise("Cancelled")
        .alias("status"),
    )
    second = orders.filter(k % 50 == 0).select(
        _tagged("RS", k).alias("reservation_id"),
        _tagged("G", c).alias("guest_id"),
        _text("RM0").alias("room_id"),
        _text("2025-01-01").alias("check_in_date"),
        _text("2025-01-03").alias("check_out_date"),
        _text("DUP").alias("booking_channel"),
        _text(None).alias("booking_time"),
        _text(None).alias("cancellation_time"),
        _text("Confirmed").alias("status"),
    )
    return main.unionByName(second)


def housekeeping(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    k, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    second = F.substring(F.col("ts").cast("string"), 1, 19).cast("timestamp_ntz")

    def later(start: Column, minutes: Column, seconds: Column = F.lit(0)) -> Column:
        return start + F.make_dt_interval(
            F.lit(0), F.lit(0), minutes.cast("int"), seconds.cast("decimal(18,6)")
        )

    start = later(second, k % 30)
    took = later(second, k % 30, F.floor(F.col("value") * 60))
    return table(spark, sf_dir, "events", "event_id" if spread else None).select(
        _tagged("HK", k).alias("task_id"),
        F.when(k % 89 == 0, "RM999999999")
        .otherwise(_tagged("RM", (user * 13 + k) % _room_count(spark, sf_dir)))
        .alias("room_id"),
        F.when(kind.isin("click", "view"), " cleaning")
        .when(kind == "error", "Maintenance")
        .otherwise("inspection")
        .alias("task_type"),
        _tagged("ST", user % 25).alias("assigned_staff"),
        F.when(k % 67 == 0, "n/a").otherwise(second.cast("string")).alias("scheduled_time"),
        start.cast("string").alias("start_time"),
        F.when(k % 23 == 0, _text(None))
        .when(k % 41 == 0, later(second, F.lit(-1440)).cast("string"))
        .otherwise(took.cast("string"))
        .alias("end_time"),
        F.when(k % 7 == 0, "y").when(k % 11 == 0, _text(None)).otherwise("N").alias("issue_detected_flag"),
        F.when(k % 5 == 0, "IN PROGRESS").otherwise("completed ").alias("status"),
    )


def billing(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    orders = table(spark, sf_dir, "orders", "o_orderkey" if spread else None)
    part = table(spark, sf_dir, "part")
    room = (k * 7 + c) % _room_count(spark, sf_dir)
    money = "decimal(10,2)"
    taxes, discounts = (c % 90).cast(money), (c % 40).cast(money)
    amount = (
        (F.col("p_retailprice").cast(money) - 850) * (k % 15).cast("decimal(4,0)")
        + taxes
        - discounts
        + F.when(k % 17 == 0, F.lit("55.50").cast(money)).otherwise(F.lit(0).cast(money))
    )
    return orders.withColumn("room", room).join(part, F.col("room") == F.col("p_partkey")).select(
        _tagged("BL", k).alias("bill_id"),
        _tagged("RS", k).alias("reservation_id"),
        _tagged("G", c).alias("guest_id"),
        F.when(k % 71 == 0, "abc")
        .otherwise(amount.cast("decimal(12,2)").cast("string"))
        .alias("total_amount"),
        taxes.cast("string").alias("taxes"),
        F.when(k % 73 == 0, "-1").otherwise(discounts.cast("string")).alias("discounts"),
        F.col("o_orderpriority").alias("payment_mode"),
        F.when(
            k % 19 != 0,
            F.concat(_day(F.col("o_orderdate"), DAY_SHIFT).cast("string"), F.lit(" 18:45:30")),
        ).alias("payment_time"),
        F.when(k % 13 == 0, "y ").otherwise("N").alias("is_flagged"),
    )


FEEDS: dict[str, Callable[..., DataFrame]] = {
    "guests": guests,
    "reservations": reservations,
    "rooms": rooms,
    "housekeeping": housekeeping,
    "billing": billing,
}
