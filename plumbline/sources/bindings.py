"""The trips, sales, pages and grid models over a star schema in Parquet.

``folder`` holds one Parquet table per name. Every model covers its whole source
tables; derived columns stand in for what the source does not record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.numbers import net_of_discount
from plumbline.operators import cleaning

SALES_ORDER = ("quantity", "unit_price", "discount_pct", "part_key")
# The region that counts as missing in raw sales, for the cleaner to find.
MISSING_REGION = "ASIA"
# Order lines that one task sorts.
TASK_LINES = 1_000_000
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


# The columns of the source tables. Declared, so that reading needs no look into the files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def raw_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Trips from ``events``, under the names and in the spelling a raw file might have."""
    seconds = ((F.col("event_id") * 7) % 20000).cast("int")
    return table(spark, folder, "events").select(
        F.col("ts").alias("LPEP_pickup_datetime"),
        (F.col("ts") + F.make_dt_interval(secs=seconds)).alias(" lpep_dropoff_datetime"),
        F.col("value").alias("Fare"),
        (F.lit(0.05) + (F.col("event_id") % 400).cast("double") / F.lit(10.0)).alias("distance "),
        F.col("event_type").alias("payment_type"),
        (F.col("user_id") % 25).alias("PULocationID"),
        (F.col("event_id") % 25).alias("DOLocationID"),
    )


def trips(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_trips(raw_trips(spark, folder))


def order_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Pickup time and fare from ``orders``, which span years."""
    return table(spark, folder, "orders").select(
        F.col("o_orderdate").alias("tpep_pickup_datetime"), F.col("o_totalprice").alias("fare_amount")
    )


def _sale_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as sale facts, before any join."""
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_quantity").alias("quantity"),
        F.try_divide(price, F.col("l_quantity")).alias("unit_price"),
        discount.alias("discount_pct"),
        net_of_discount(price, discount).alias("revenue"),
    )


def _order_facts(spark: SparkSession, folder: str, missing_region: str | None = None) -> DataFrame:
    """Orders with customer, channel and region: the joins that need no order line."""
    region = F.col("r_name") if missing_region is None else F.nullif(F.col("r_name"), F.lit(missing_region))
    regions = (
        table(spark, folder, "nation")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", region.alias("region"))
    )
    customers = (
        table(spark, folder, "customer")
        .join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("channel"), "region")
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderdate").alias("date"), F.col("o_custkey").alias("customer_id")
    )
    return orders.join(customers, "customer_id")


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(F.col("p_partkey").alias("part_key"), F.col("p_brand").alias("product"))


def line_tasks(spark: SparkSession, folder: str) -> int | None:
    """Tasks for the order lines where the session's shuffle partitions would get more than :data:`TASK_LINES` each; else None."""
    tasks = -(-table(spark, folder, "lineitem").count() // TASK_LINES)
    return tasks if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def _by_order(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines dealt by order: the partitioning that finding copies and joining the orders share."""
    tasks = line_tasks(spark, folder)
    return _sale_lines(spark, folder).repartition(*([tasks] if tasks else []), "order_key")


def _identified(lines: DataFrame) -> DataFrame:
    order_id = F.concat_ws("-", F.col("order_key").cast("string"), F.col("line_no").cast("string"))
    return lines.withColumn("order_id", order_id).drop("order_key", "line_no")


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales with repeated order lines and one missing region, before cleaning; the part stands for the product."""
    return _by_order(spark, folder).join(_order_facts(spark, folder, MISSING_REGION), "order_key")


def cleaned_raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """``clean_sales`` over :func:`raw_sales`, with products added last."""
    cleaned = cleaning.clean_sales(raw_sales(spark, folder), ("order_key", "line_no"), SALES_ORDER)
    return _identified(cleaned).join(products(spark, folder), "part_key").drop("part_key")


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned sales of all regions, with ``part_key`` in place of the product.

    The order lines, by far the largest table, are shuffled once: by order. Copies
    are removed and orders joined on that partitioning; customers and regions are
    joined to the orders, which have no line's columns. No join is hinted.
    """
    first = cleaning.dedupe(_by_order(spark, folder), ["order_key", "line_no"], SALES_ORDER)
    return _identified(cleaning.finish_sales(first.join(_order_facts(spark, folder), "order_key")))


def sales_with_product(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`sales` for results that show the product of single sales."""
    return sales(spark, folder).join(products(spark, folder), "part_key").drop("part_key")


def cells(spark: SparkSession, folder: str) -> DataFrame:
    """A square grid with one cell per part; walls and costs follow from the part size."""
    part = table(spark, folder, "part")
    side = part.agg(F.ceil(F.sqrt(F.max("p_partkey") + 1)).cast("bigint").alias("side")).scalar()
    return part.select(
        F.floor(F.try_divide(F.col("p_partkey"), side)).cast("int").alias("row"),
        (F.col("p_partkey") % side).cast("int").alias("col"),
        (F.col("p_size") % 5 == 0).alias("wall"),
        (F.col("p_size") % 3 + 1).alias("cost"),
    )


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """The crawl as it is; no fetch error is on record."""
    crawl = table(spark, folder, "pages").select("url", "html")
    return crawl.withColumn("error", F.lit(None).cast("string"))


def catalog_pages(spark: SparkSession, folder: str, failures: bool = False) -> DataFrame:
    """A product page per part with pictures, a table, structured data and a pager; ``failures`` marks some as failed."""
    key, name = F.col("p_partkey").cast("string"), F.col("p_name")
    item = F.concat(F.lit('{"sku": '), key, F.lit(', "name": "'), name, F.lit('"}'))
    variant = F.col("p_partkey") % 3
    json_ld = (
        F.when(variant == 0, item)
        .when(variant == 1, F.concat(F.lit("["), item, F.lit(', {"offers": '), key, F.lit("}]")))
        .otherwise(F.concat(item, F.lit(",")))
    )
    pager = F.when(
        F.col("p_partkey") % 5 != 0,
        F.concat(F.lit('<ul><li>1</li><li class="pager next"><a href="/part/'), key, F.lit('?next=1">more</a></li></ul>')),
    ).otherwise(F.lit("<ul><li>1</li></ul>"))
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><title>"),
        name,
        F.lit(' &amp; more</title><meta name="description" content="'),
        F.col("p_type"),
        F.lit(' &lt; all"><script type="application/ld+json">'),
        json_ld,
        F.lit("</script><style>td{color:red}</style></head><body><h1>"),
        name,
        F.lit('</h1><noscript><img src="/off.png">off</noscript><img src="/img/'),
        key,
        F.lit('.png" alt=" '),
        name,
        F.lit(' "><img src="thumb/'),
        key,
        F.lit('.png"><img src="http://cdn.example.com/'),
        key,
        F.lit('.png" alt="front"><img src="data:image/png;base64,AA"><img src="">'),
        F.lit("<table><tr><th>Field</th><th>Value</th></tr><tr><td>Size</td><td>"),
        F.col("p_size").cast("string"),
        F.lit("</td></tr><tr><td>Brand<td><b>"),
        F.col("p_brand"),
        F.lit("</b> &copy;</tr><tr><td>odd</td></tr></table>"),
        pager,
        F.lit("</body></html>"),
    )
    failed = F.col("p_size") % 10 == 0 if failures else F.lit(False)
    columns = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]
    return table(spark, folder, "part").select(*columns).select(
        F.concat(F.lit("http://catalog.example.com/part/"), key).alias("url"),
        F.when(failed, F.lit("")).otherwise(html).alias("html"),
        F.when(failed, F.lit("timeout")).alias("error"),
    )
