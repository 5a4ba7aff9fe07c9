"""Customer transactions: clean, transform, merge, aggregate, report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import scalars as X
from tidemark.functions.sizing import durable, shuffles_dropped
from tidemark.operators import aggregates as A, cleaning as P, joins as J, statistics as T
from tidemark.operators.ordering import value_counts
from tidemark.sources.tables import write_csv, write_parquet

CUSTOMER, ORDER, PRODUCT, PRICE = "CustomerID", "OrderNumber", "ProductNr", "Price"
PRODUCT_KEYS = ("ProductNr", "ProductID", "Product_ID")
GROUP_KEYS = (CUSTOMER, "CustomerGroup", "AgeGroup")
PARALLEL_AXES = ("AgeGroup", "CustomerGroup_num", "Sum_Price", "Unique_ProductNr")
#: Columns that the pivot of basket sizes may have.
MOST_TYPES = 1000


def clean(system: DataFrame, order: Sequence[str], crop_rows: int = 0, crop_cols: int = 0) -> DataFrame:
    """Crop, keep the first row per customer, fill missing ages with the mean.

    ``order`` names the (untrimmed) columns that give the row order.
    """
    cropped = P.crop(system, crop_rows, crop_cols, [f"`{c}`" for c in order])
    unique = P.dedupe(cropped, [CUSTOMER], [c.strip() for c in order])
    return P.impute(unique, "Age", "mean")


def transform(customers: DataFrame) -> DataFrame:
    """Age bracket, country text, id parts, email, newsletter; absent columns are skipped."""
    out = customers
    if "Age" in out.columns:
        out = out.withColumn("AgeGroup", X.age_group(F.col("Age")))
    if "Country" in out.columns:
        out = out.withColumn("Country", X.commas_to_spaces(F.col("Country").cast("string")))
    if CUSTOMER in out.columns:
        group, number = X.split_once(F.col(CUSTOMER).cast("string"))
        out = out.withColumns({"CustomerGroup": group, CUSTOMER: number})
    out = P.fallback(out, "Email", "CorporateEmail")
    if "Newsletter" in out.columns:
        out = out.withColumn("Newsletter", F.col("Newsletter").cast("string"))
    return out


def enrich(transactions: DataFrame, stores: DataFrame, prices: DataFrame) -> DataFrame:
    """Append the store type and the product price; unmatched rows keep a missing value."""
    out = J.lookup(transactions, stores, "StoreID", "StoreType")
    key = J.common_key(out, prices, PRODUCT_KEYS)
    return J.lookup(out, prices, key, PRICE) if key else out


def merge(customers: DataFrame, enriched: DataFrame) -> DataFrame:
    """Join by customer."""
    return J.join_on_id(customers, enriched, CUSTOMER)


def total_per_customer(merged: DataFrame) -> DataFrame:
    return A.sum_per_key(merged, [CUSTOMER], PRICE, "TotalPrice_per_Customer")


def basket_sizes(merged: DataFrame) -> DataFrame:
    return A.count_per_key(merged, [ORDER, "StoreType"], PRODUCT, "BasketSize")


def basket_pivot(merged: DataFrame, store_types: Sequence[str]) -> DataFrame:
    return A.pivot_counts(basket_sizes(merged), "BasketSize", "StoreType", store_types, ORDER)


def per_customer(merged: DataFrame) -> DataFrame:
    return A.sum_and_distinct(
        merged, GROUP_KEYS, PRICE, PRODUCT, ("Sum_Price", "Unique_ProductNr")
    )


def parallel_frame(summary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Encoded and scaled customer rows as (group, axis, value), and the group medians.

    The rows are read several times (codes, bounds, medians), so they are stored once.
    """
    columns = ["CustomerGroup", "AgeGroup", "Sum_Price", "Unique_ProductNr"]
    rows = durable(summary.select(*columns).na.drop())
    coded = P.encode_sorted(rows, "CustomerGroup", "CustomerGroup_num").withColumn(
        "AgeGroup", P.encode_fixed("AgeGroup", X.AGE_LABELS)
    )
    scaled = P.scale_unit(coded, PARALLEL_AXES)
    return T.parallel_axes(scaled, "CustomerGroup", PARALLEL_AXES)


def scatter_frame(summary: DataFrame) -> DataFrame:
    return summary.select("CustomerGroup", "Unique_ProductNr", "Sum_Price")


def group_counts(summary: DataFrame) -> DataFrame:
    return value_counts(summary, ["CustomerGroup"]).orderBy("CustomerGroup")


def run(
    system1: DataFrame,
    system2: DataFrame,
    stores: DataFrame,
    transactions: DataFrame,
    prices: DataFrame,
    out: str,
    order: str = "row_no",
    crop_rows: int = 1,
    crop_cols: int = 1,
) -> dict[str, DataFrame]:
    """The whole flow. The merged table is written once, and so is the summary per customer, whose
    shuffle takes nearly all of its rows; the reports read them back. Rows of the merged table are
    written in order of their customers, whose cells repeat and so take little of the disk; the enriched transactions, text as large as all
    else together, are written compressed."""
    with shuffles_dropped(transactions.sparkSession):
        return _run(system1, system2, stores, transactions, prices, out, order, crop_rows, crop_cols)


def _run(
    system1: DataFrame,
    system2: DataFrame,
    stores: DataFrame,
    transactions: DataFrame,
    prices: DataFrame,
    out: str,
    order: str,
    crop_rows: int,
    crop_cols: int,
) -> dict[str, DataFrame]:
    spark = transactions.sparkSession
    spaced = next(c for c in system1.columns if c.strip() == order)
    first = transform(clean(system1, [spaced], crop_rows, crop_cols))
    second = transform(clean(system2, [order]))
    customers = J.stack_tables(first, second)
    enriched = enrich(transactions, stores, prices)
    write_parquet(merge(customers, enriched).sortWithinPartitions(CUSTOMER), f"{out}/merged", compression="zstd")
    write_csv(enriched, f"{out}/enriched_transactions", compression="gzip")
    merged = spark.read.parquet(f"{out}/merged")
    summary = durable(per_customer(merged))
    lines, medians = parallel_frame(summary)
    types = [r[0] for r in stores.select("StoreType").distinct().orderBy("StoreType").limit(MOST_TYPES + 1).collect()]
    if len(types) > MOST_TYPES:
        raise ValueError(f"more than {MOST_TYPES} store types: their pivot has a column for each")
    reports = {
        "total_per_customer": total_per_customer(merged).orderBy(CUSTOMER),
        "basket_pivot": basket_pivot(merged, types).orderBy("BasketSize"),
        "customer_summary": summary.orderBy(*GROUP_KEYS),
        "scatter": scatter_frame(summary),
        "group_counts": group_counts(summary),
        "parallel_lines": lines,
        "parallel_medians": medians,
        "customers": customers,
    }
    for name, frame in reports.items():
        write_csv(frame, f"{out}/{name}")
    return reports
