"""Daily sales reports: W2 P3 P7 P8, W4 J2, A1-A7.

Every aggregate is a ``sum`` of decimal money; Spark plans it as a partial
(map-side) aggregate, a shuffle on the group key, and a final aggregate, so
a day that holds a third of all orders is reduced inside each map task
before anything is shuffled. The nested and long reports are built from
the already-aggregated cells, whose groups are bounded by the number of
provinces and allow-listed cities per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.casts import sales
from tidemill.schemas import SALES
from tidemill.operators.clean import drop_empty, message_text, parse_report_input
from tidemill.operators.geo import BROADCAST_MAX_BYTES, table_bytes

# Hash-store key prefixes and the total's field name.
PREFIX_TOTAL = "orders:money:total"
PREFIX_PROVINCE = "orders:money:province"
PREFIX_CITY = "orders:money:city"
FIELD_GLOBAL = "global"

# The reference's nine allow-listed cities.
REFERENCE_CITIES = ["北京市", "上海市", "深圳市", "广州市", "杭州市", "成都市", "南京市", "武汉市", "西安市"]

# Long-report dimension names (total, province, city) and the chart's total label.
DIMENSION_TOTAL = "总销售额"
DIMENSION_PROVINCE = "省份销售额"
DIMENSION_CITY = "城市销售额"
SERIES_TOTAL_LABEL = "Total"

WATERMARK_DELAY = "10 minutes"


def report_input(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """P1 -> W2 -> P3: enriched messages to report rows (plus any ``keep`` columns)."""
    return parse_report_input(drop_empty(message_text(messages, keep)), keep=keep)


def _watermarked(orders: DataFrame, watermark: str | None) -> DataFrame:
    # Declared on order_timestamp as in the reference. Grouping is on
    # order_date, so (as there) it neither drops late rows nor evicts state.
    return orders.withWatermark("order_timestamp", watermark) if watermark else orders


def to_cells(agg: DataFrame, prefix: str, field, keep: tuple[str, ...] = ()) -> DataFrame:
    """key = prefix:yyyy-MM-dd (a NULL date leaves the bare prefix), value = sum as text."""
    return agg.select(
        *keep,
        F.concat_ws(":", F.lit(prefix), F.col("order_date").cast("string")).alias("key"),
        field.alias("field"),
        F.col("total_amt").cast("string").alias("value"),
    )


def allow_cities(orders: DataFrame, cities: list[str]) -> DataFrame:
    """Keep allow-listed cities; a NULL city drops."""
    return orders.filter(F.col("city").isin(cities))


def allow_cities_semi(orders: DataFrame, city_table: DataFrame) -> DataFrame:
    """The allow-list as a one-column table ``city``, applied as a left-semi join.

    Broadcast when the table is measured small, a shuffled semi join otherwise.
    """
    table = city_table.select("city").filter(F.col("city").isNotNull())
    small = table_bytes(table) <= BROADCAST_MAX_BYTES
    return orders.join(F.broadcast(table) if small else table.distinct(), "city", "left_semi")


def daily_total(orders: DataFrame, watermark: str | None = None) -> DataFrame:
    """A1: cells ``orders:money:total:<date>`` / ``global``."""
    agg = _watermarked(orders, watermark).groupBy("order_date").agg(F.sum("money").alias("total_amt"))
    return to_cells(agg, PREFIX_TOTAL, F.lit(FIELD_GLOBAL))


def daily_by_province(orders: DataFrame, watermark: str | None = None) -> DataFrame:
    """A2: cells ``orders:money:province:<date>`` / province."""
    agg = (
        _watermarked(orders, watermark)
        .groupBy("order_date", "province")
        .agg(F.sum("money").alias("total_amt"))
    )
    return to_cells(agg, PREFIX_PROVINCE, F.col("province"))


def daily_by_city(
    orders: DataFrame,
    cities: list[str] | None = None,
    watermark: str | None = None,
    city_table: DataFrame | None = None,
) -> DataFrame:
    """A3: cells ``orders:money:city:<date>`` / city, allow-listed by list (W4) or table."""
    kept = allow_cities_semi(orders, city_table) if city_table is not None else allow_cities(orders, cities)
    agg = _watermarked(kept, watermark).groupBy("order_date", "city").agg(F.sum("money").alias("total_amt"))
    return to_cells(agg, PREFIX_CITY, F.col("city"))


def daily_sets(orders: DataFrame, cities: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """A4: the three reports in one pass with GROUPING SETS, so all three agree.

    Returns ``grain`` ('total' | 'province' | 'city'), the ``by`` columns,
    ``order_date``, ``category`` and ``total_amt`` (decimal(20,2)). The
    allow-list applies to the city set only. ``by`` columns (e.g. a
    micro-batch id) are added to every grouping set.
    """
    df = orders.select(
        *by, "order_date", "province", F.when(F.col("city").isin(cities), F.col("city")).alias("_city"), "money"
    )
    keys = [*by, "order_date"]
    agg = df.groupingSets(
        [keys, [*keys, "province"], [*keys, "_city"]], *keys, "province", "_city"
    ).agg(
        F.sum("money").alias("total_amt"),
        (F.grouping("province") * 2 + F.grouping("_city")).alias("_gid"),
    )
    # grouping bits (province, _city): 3 = total, 1 = by province, 2 = by city.
    grain = F.when(F.col("_gid") == 3, "total").when(F.col("_gid") == 1, "province").otherwise("city")
    category = (
        F.when(F.col("_gid") == 3, F.lit(FIELD_GLOBAL))
        .when(F.col("_gid") == 1, F.col("province"))
        .otherwise(F.col("_city"))
    )
    return agg.filter(~((F.col("_gid") == 2) & F.col("_city").isNull())).select(
        grain.alias("grain"), *by, "order_date", category.alias("category"), sales("total_amt").alias("total_amt")
    )


def sets_to_cells(sets: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """A4 as hash cells: (grain, key, field, value), plus any ``keep`` columns."""
    prefix = (
        F.when(F.col("grain") == "total", F.lit(PREFIX_TOTAL))
        .when(F.col("grain") == "province", F.lit(PREFIX_PROVINCE))
        .otherwise(F.lit(PREFIX_CITY))
    )
    return sets.select(
        *keep,
        "grain",
        F.concat_ws(":", prefix, F.col("order_date").cast("string")).alias("key"),
        F.col("category").alias("field"),
        F.col("total_amt").cast("string").alias("value"),
    )


def cells_to_sets(cells: DataFrame) -> DataFrame:
    """Hash cells (key, field, value) back to report rows (grain, order_date, category, total_amt).

    This is how the exports read the live store: the grain comes from the key
    prefix, the day from the key suffix. Cells of other prefixes are ignored.
    """
    grain = (
        F.when(F.col("key").startswith(PREFIX_TOTAL + ":"), F.lit("total"))
        .when(F.col("key").startswith(PREFIX_PROVINCE + ":"), F.lit("province"))
        .when(F.col("key").startswith(PREFIX_CITY + ":"), F.lit("city"))
    )
    day = F.substring_index(F.col("key"), ":", -1).try_cast("date")
    return cells.select(
        grain.alias("grain"),
        day.alias("order_date"),
        F.col("field").alias("category"),
        F.col("value").try_cast(SALES).alias("total_amt"),
    ).filter(F.col("grain").isNotNull())


def report_long(sets: DataFrame) -> DataFrame:
    """A5: (date, dimension, category, sales), the long table of the CSV report."""
    dimension = (
        F.when(F.col("grain") == "total", F.lit(DIMENSION_TOTAL))
        .when(F.col("grain") == "province", F.lit(DIMENSION_PROVINCE))
        .otherwise(F.lit(DIMENSION_CITY))
    )
    return sets.select(
        F.col("order_date").alias("date"),
        dimension.alias("dimension"),
        "category",
        sales("total_amt").alias("sales"),
    )


def report_document(sets: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """One nested document per day, or per requested day (``days``: a column ``date``).

    A requested day without sales gets total 0 and empty lists.

    ``date, total_sales (0 when absent), province_sales array<struct<province, sales>>,
    city_sales array<struct<city, sales>>``; arrays sorted for stable output.
    One aggregation over the cells; each group holds one day's provinces and cities.
    """
    g = F.col("grain")
    amount = sales("total_amt")
    found = sets.groupBy(F.col("order_date").alias("date")).agg(
        F.coalesce(F.max(F.when(g == "total", amount)), F.lit(0).cast("decimal(20,2)")).alias("total_sales"),
        F.sort_array(
            F.collect_list(
                F.when(g == "province", F.struct(F.col("category").alias("province"), amount.alias("sales")))
            )
        ).alias("province_sales"),
        F.sort_array(
            F.collect_list(F.when(g == "city", F.struct(F.col("category").alias("city"), amount.alias("sales"))))
        ).alias("city_sales"),
    )
    if days is None:
        return found
    empty = {f.name: f.dataType for f in found.schema.fields if f.name.endswith("_sales") and f.name != "total_sales"}
    asked = days.select("date").distinct().join(found, "date", "left")
    return asked.select(
        "date",
        F.coalesce("total_sales", F.lit(0).cast(SALES)).alias("total_sales"),
        *[F.coalesce(F.col(c), F.array().cast(t)).alias(c) for c, t in empty.items()],
    )


def flatten_document(doc: DataFrame) -> DataFrame:
    """The document with each list spelled out as ``name=sales`` pairs joined by ';'."""

    def pairs(column: str, name: str):
        return F.array_join(
            F.transform(F.col(column), lambda x: F.concat(x[name], F.lit("="), x["sales"].cast("string"))), ";"
        )

    return doc.select(
        "date",
        "total_sales",
        F.size("province_sales").alias("n_provinces"),
        pairs("province_sales", "province").alias("province_sales"),
        F.size("city_sales").alias("n_cities"),
        pairs("city_sales", "city").alias("city_sales"),
    )


def report_series(doc: DataFrame) -> DataFrame:
    """Chart series per day: ('Total', total) at ordinal 0, then provinces in name order."""
    entries = F.concat(
        F.array(F.struct(F.lit(SERIES_TOTAL_LABEL).alias("label"), F.col("total_sales").alias("value"))),
        F.transform(
            F.col("province_sales"), lambda x: F.struct(x["province"].alias("label"), x["sales"].alias("value"))
        ),
    )
    return doc.select("date", F.posexplode(entries).alias("ordinal", "entry")).select(
        "date", "ordinal", F.col("entry.label").alias("label"), F.col("entry.value").alias("value")
    )
