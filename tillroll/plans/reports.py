"""Sales dashboard datasets and widget projections.

Each dataset is one aggregation over the sales-orders fact table; revenue is
DECIMAL(18,4), so sums are exact and independent of row order, and are
returned as DOUBLE after ROUND(…, 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _revenue_total():
    return F.round(F.sum("revenue"), 2).cast("double").alias("total_revenue")


def revenue_by_category(orders: DataFrame) -> DataFrame:
    return (orders.groupBy("category")
            .agg(_revenue_total(), F.count(F.lit(1)).alias("order_count"))
            .orderBy(F.desc("total_revenue"), "category"))


def revenue_by_region(orders: DataFrame) -> DataFrame:
    return (orders.groupBy("region")
            .agg(_revenue_total(), F.count(F.lit(1)).alias("order_count"))
            .orderBy(F.desc("total_revenue"), "region"))


def monthly_trend(orders: DataFrame) -> DataFrame:
    """Completed orders by calendar month (month as DATE)."""
    return (orders.filter(F.col("status") == "Completed")
            .groupBy(F.trunc(F.to_date("order_date"), "month").alias("month"))
            .agg(_revenue_total(), F.count(F.lit(1)).alias("order_count"))
            .orderBy("month"))


def order_status_summary(orders: DataFrame) -> DataFrame:
    return (orders.groupBy("status")
            .agg(F.count(F.lit(1)).alias("order_count"), _revenue_total())
            .orderBy(F.desc("order_count"), "status"))


def kpi_totals(orders: DataFrame) -> DataFrame:
    """Global KPIs of completed orders (one row, a two-phase global aggregate)."""
    return (orders.filter(F.col("status") == "Completed")
            .agg(F.count(F.lit(1)).alias("total_orders"),
                 _revenue_total(),
                 F.round(F.avg("revenue"), 2).cast("double").alias("avg_order_value"),
                 F.sum("quantity").alias("total_units")))


# Widget → (dataset, fields): which named fields of which dataset a widget shows.
WIDGETS = {
    "total_revenue_counter": ("kpi_totals", ["total_revenue"]),
    "total_orders_counter": ("kpi_totals", ["total_orders"]),
    "avg_order_value_counter": ("kpi_totals", ["avg_order_value"]),
    "revenue_by_category_bar": ("revenue_by_category", ["category", "total_revenue"]),
    "revenue_by_region_pie": ("revenue_by_region", ["region", "total_revenue"]),
    "monthly_trend_line": ("monthly_trend", ["month", "total_revenue"]),
    "order_status_table": ("order_status_summary", ["status", "order_count", "total_revenue"]),
}

# Dimensions and status that a dataset needs of the sales fact.
NEEDS = {
    "revenue_by_category": (("category",), None),
    "revenue_by_region": (("region",), None),
    "monthly_trend": ((), "Completed"),
    "order_status_summary": ((), None),
    "kpi_totals": ((), "Completed"),
}

DATASETS = {
    "revenue_by_category": revenue_by_category,
    "revenue_by_region": revenue_by_region,
    "monthly_trend": monthly_trend,
    "order_status_summary": order_status_summary,
    "kpi_totals": kpi_totals,
}


def widget(datasets: dict[str, DataFrame], name: str) -> DataFrame:
    """Project the fields a widget displays from its dataset."""
    ds, fields = WIDGETS[name]
    return datasets[ds].select(*fields)


# grouping_id() of each grouping set over (category, region, month, status):
# a bit is set for every column NOT grouped, first column = highest bit.
_GID = {"category": 0b0111, "region": 0b1011, "month": 0b1101, "status": 0b1110, "all": 0b1111}


def dashboard_rollup(orders: DataFrame) -> DataFrame:
    """All dashboard aggregates in ONE pass over the fact table: grouping
    sets (category), (region), (month), (status), () with exact DECIMAL
    revenue sums, counts, and completed-only measures as conditional sums.
    Spark plans one Expand + partial aggregate before a single shuffle."""
    done = F.col("status") == "Completed"
    return (orders.withColumn("month", F.trunc(F.to_date("order_date"), "month"))
            .groupingSets([["category"], ["region"], ["month"], ["status"], []],
                          "category", "region", "month", "status")
            .agg(F.grouping_id().alias("gid"),
                 F.sum("revenue").alias("rev"), F.count(F.lit(1)).alias("n"),
                 F.sum(F.when(done, F.col("revenue"))).alias("rev_done"),
                 F.count_if(done).alias("n_done"),
                 F.sum(F.when(done, F.col("quantity"))).alias("units_done")))


def _rollup_fields() -> dict[str, tuple[str, Column | None, dict[str, Column]]]:
    """dataset → (grouping set, row condition, field → expression over the rollup)."""
    def rev(c):
        return F.round(F.col(c), 2).cast("double")

    has_done = F.col("n_done") > 0
    avg = F.when(has_done, F.round(F.col("rev_done") / F.col("n_done"), 2)).cast("double")
    return {
        "revenue_by_category": ("category", None, {"category": F.col("category"), "total_revenue": rev("rev"),
                                                   "order_count": F.col("n")}),
        "revenue_by_region": ("region", None, {"region": F.col("region"), "total_revenue": rev("rev"),
                                               "order_count": F.col("n")}),
        "monthly_trend": ("month", has_done, {"month": F.col("month"), "total_revenue": rev("rev_done"),
                                              "order_count": F.col("n_done")}),
        "order_status_summary": ("status", None, {"status": F.col("status"), "order_count": F.col("n"),
                                                  "total_revenue": rev("rev")}),
        "kpi_totals": ("all", None, {"total_orders": F.col("n_done"), "total_revenue": rev("rev_done"),
                                     "avg_order_value": avg, "total_units": F.col("units_done")}),
    }


def datasets_from_rollup(r: DataFrame) -> dict[str, DataFrame]:
    """The five datasets as row subsets of the rollup (equal to the direct
    queries: months without completed orders are absent, as in a filtered
    GROUP BY)."""
    out = {}
    for name, (g, cond, fields) in _rollup_fields().items():
        rows = r.filter(F.col("gid") == _GID[g])
        if cond is not None:
            rows = rows.filter(cond)
        out[name] = rows.select(*[e.alias(f) for f, e in fields.items()])
    return out


def dashboard_widgets(orders: DataFrame) -> DataFrame:
    """All widgets in one long frame: (widget, label, measure, value).

    One pass over the fact table (``dashboard_rollup``); each rollup row then
    emits the widget rows it feeds through a single ``explode`` — one plan
    branch, so the fact table is joined, aggregated and shuffled once."""
    fields_of = _rollup_fields()
    measures_all = ("total_revenue", "order_count", "total_orders", "avg_order_value")
    entries = None
    by_gid: dict[int, list] = {}
    conds: dict[int, Column | None] = {}
    for name, (ds, fields) in WIDGETS.items():
        g, cond, exprs = fields_of[ds]
        dims = [f for f in fields if f not in measures_all]
        label = exprs[dims[0]].cast("string") if dims else F.lit(None).cast("string")
        for m in [f for f in fields if f not in dims]:
            by_gid.setdefault(_GID[g], []).append(
                F.struct(F.lit(name).alias("widget"), label.alias("label"), F.lit(m).alias("measure"),
                         exprs[m].cast("double").alias("value")))
        conds[_GID[g]] = cond
    for gid, items in by_gid.items():
        ok = F.col("gid") == gid
        if conds[gid] is not None:
            ok = ok & conds[gid]
        entries = F.when(ok, F.array(*items)) if entries is None else entries.when(ok, F.array(*items))
    return (dashboard_rollup(orders)
            .select(F.explode(entries).alias("w"))
            .select("w.widget", "w.label", "w.measure", "w.value"))
