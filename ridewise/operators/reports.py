"""Quality-report aggregates.

Each report is one aggregate pass over the ride table; the JSON report (E6)
stitches the small results together with scalar subqueries and
``to_json`` — nothing is collected to the driver to build it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridewise.functions.columns import round_np
from ridewise.functions.quantiles import column_quantiles

STAT_COLUMNS = ["wait_time_min", "surge_multiplier", "distance_km", "fare_inr", "driver_rating",
                "demand_pressure", "fare_per_km", "hourly_ride_volume"]
DESCRIBE_COLUMNS = ["wait_time_min", "surge_multiplier", "distance_km", "fare_inr", "driver_rating"]
DIST_COLUMNS = ["city", "vehicle_type", "weather", "season", "surge_band", "wait_band"]
FLAG_COLUMNS = ["is_peak_hour", "is_weekend", "is_raining", "is_festival", "is_ipl_day",
                "is_high_surge", "is_high_demand", "is_event_day", "is_completed"]


def _rows(wide: DataFrame, items: Sequence[str], fields: dict[str, str], key: str = "column") -> DataFrame:
    """Lay a one-row aggregate ``{item}__{field}`` out as one row per item."""
    structs = [F.struct(F.lit(i).alias(key),
                        *[F.col(f"`{i}__{f}`").cast(t).alias(f) for f, t in fields.items()])
               for i in items]
    return wide.select(F.inline(F.array(*structs)))


# E1 ------------------------------------------------------------------------------
def final_stats(df: DataFrame, columns: Sequence[str] = STAT_COLUMNS, digits: int = 3) -> DataFrame:
    """mean, exact median, sample std, min, max per column (round 3).

    One aggregate; the medians come from histogram refinement, which runs jobs.
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [round_np(F.avg(x), digits).alias(f"{c}__mean"),
                 round_np(F.stddev_samp(x), digits).alias(f"{c}__std"),
                 round_np(F.min(x), digits).alias(f"{c}__min"),
                 round_np(F.max(x), digits).alias(f"{c}__max")]
    fields = {f: "double" for f in ("mean", "median", "std", "min", "max")}
    q = column_quantiles(df, columns, [0.5])
    wide = df.agg(*aggs).withColumn("_q", q)
    return _rows(wide.withColumns({f"{c}__median": round_np(F.col("_q")[f"{c}|0.5"], digits) for c in columns}), columns, fields)


# E2 ------------------------------------------------------------------------------
def describe_numeric(df: DataFrame, columns: Sequence[str] = DESCRIBE_COLUMNS, digits: int = 4) -> DataFrame:
    """count, mean, std, min, 25/50/75 %, max — exact (interpolated) quartiles by histogram refinement (runs jobs)."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"{c}__count"),
                 round_np(F.avg(x), digits).alias(f"{c}__mean"),
                 round_np(F.stddev_samp(x), digits).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs).withColumn("_q", column_quantiles(df, columns, [0.25, 0.5, 0.75]))
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"{c}__count").alias("count"),
                        F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"),
                        F.col(f"{c}__min").alias("min"),
                        round_np(F.col("_q")[f"{c}|0.25"], digits).alias("p25"),
                        round_np(F.col("_q")[f"{c}|0.5"], digits).alias("p50"),
                        round_np(F.col("_q")[f"{c}|0.75"], digits).alias("p75"),
                        F.col(f"{c}__max").alias("max"))
               for c in columns]
    return wide.select(F.inline(F.array(*structs)))


# E3 / E4 ----------------------------------------------------------------------------
def feature_distributions(df: DataFrame, columns: Sequence[str] = DIST_COLUMNS) -> DataFrame:
    """Value counts of several categoricals in one pass (nulls dropped like pandas)."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]) \
             .unpivot([], list(columns), "feature", "value")
    return (long.where(F.col("value").isNotNull())
                .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count")))


def raw_summary(df: DataFrame, dimensions: Sequence[str] = ("city", "vehicle_type")) -> DataFrame:
    """(section, name, rows, pct): rows by value of each dimension, and null cells by column; % of all rows.

    GROUPING SETS over the dimensions and the whole table: one pass, one
    exchange of partial counts. Null values of a dimension and columns without
    nulls are left out, as in the reference's printout.
    """
    dims, last = list(dimensions), 2 ** len(dimensions) - 1
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in df.columns]
    g = df.groupingSets([*([d] for d in dims), []], *dims).agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("rows"), *nulls)

    def row(section, name, rows):
        return F.struct(F.lit(section).alias("section"), name.alias("name"), rows.cast("long").alias("rows"))

    whole = F.array(*(row("nulls", F.lit(c), F.col(f"_null_{c}")) for c in df.columns))
    pick = F.when(F.col("_set") == last, F.filter(whole, lambda x: x["rows"] > 0))
    for i, d in enumerate(dims):
        pick = pick.when(F.col("_set") == last - 2 ** (len(dims) - 1 - i), F.array(row(d, F.col(d).cast("string"), F.col("rows"))))
    total = F.sum("rows").over(Window.partitionBy("_set"))                # a handful of rows
    long = g.select(total.alias("_n"), pick.alias("_r")).select("_n", F.inline("_r")).where("name is not null")
    return long.select("section", "name", "rows", round_np(F.col("rows") * 100.0 / F.col("_n"), 4).alias("pct"))


def value_counts_share(df: DataFrame, columns: Sequence[str] = ("city", "vehicle_type")) -> DataFrame:
    """Count and % of all rows per value (window over the small aggregate only)."""
    counts = feature_distributions(df, columns)
    total = F.sum("count").over(Window.partitionBy("feature"))
    return counts.withColumn("pct", round_np(F.col("count") * 100.0 / total, 4))


# E5 ------------------------------------------------------------------------------
def flag_rates(df: DataFrame, flags: Sequence[str] = FLAG_COLUMNS, digits: int = 4) -> DataFrame:
    wide = df.agg(*[round_np(F.avg(F.col(f).cast("double")), digits).alias(f) for f in flags])
    return wide.unpivot([], list(flags), "flag", "rate")


# E7 ------------------------------------------------------------------------------
def dataset_summary(df: DataFrame) -> DataFrame:
    """Generator summary: key statistics of a raw ride table in one row (``raw_summary`` has the rest).

    The exact medians come from histogram refinement, which runs jobs.
    """
    n = F.count(F.lit(1))
    fare = F.col("fare_inr")
    wide = df.agg(
        n.alias("rows"),
        F.min(F.to_date("ts")).alias("first_date"),
        F.max(F.to_date("ts")).alias("last_date"),
        round_np(F.avg("surge_multiplier"), 4).alias("mean_surge"),
        round_np(F.avg(F.col("is_completed").cast("double")) * 100, 4).alias("completion_pct"),
        F.count_if("is_festival").alias("festival_rides"),
        round_np(F.avg(F.col("is_festival").cast("double")) * 100, 4).alias("festival_pct"),
        F.count_if("is_ipl_day").alias("ipl_rides"),
        round_np(F.avg(F.col("is_ipl_day").cast("double")) * 100, 4).alias("ipl_pct"),
        F.count_if((fare <= 0) | (fare > 5000)).alias("outlier_fares"),
    ).withColumn("_q", column_quantiles(df, ["fare_inr", "wait_time_min"], [0.5]))
    return wide.withColumns({"median_fare": round_np(F.col("_q")["fare_inr|0.5"], 4),
                             "median_wait": round_np(F.col("_q")["wait_time_min|0.5"], 4)}).drop("_q")


# E6 ------------------------------------------------------------------------------
def _as_array(small: DataFrame) -> Column:
    """A small result (≤ a few dozen rows) as one array-of-struct scalar."""
    return small.agg(F.collect_list(F.struct(*small.columns))).scalar()


def quality_report(enriched: DataFrame, validation: DataFrame | None = None,
                   cleaning: DataFrame | None = None, encodings: DataFrame | None = None) -> DataFrame:
    """The pipeline's JSON report as one row (column ``report``)."""
    shape = enriched.agg(F.count(F.lit(1)).alias("rows"),
                         F.min(F.to_date("ts")).cast("string").alias("start"),
                         F.max(F.to_date("ts")).cast("string").alias("end"))
    parts = {
        "final_shape": F.struct(F.col("rows"), F.lit(len(enriched.columns)).alias("columns")),
        "date_range": F.struct("start", "end"),
        "final_columns": F.array(*[F.lit(c) for c in enriched.columns]),
        "final_stats": _as_array(final_stats(enriched)),
        "feature_distributions": _as_array(feature_distributions(enriched)),
        "flag_rates": _as_array(flag_rates(enriched)),
    }
    if validation is not None:
        parts["validation"] = _as_array(validation)
    if cleaning is not None:
        parts["cleaning"] = _as_array(cleaning)
    if encodings is not None:
        parts["encodings"] = _as_array(encodings.select("column", F.explode("codes").alias("value", "code")))
    return shape.select(F.current_timestamp().cast("string").alias("generated_at"),
                        F.to_json(F.struct(*[v.alias(k) for k, v in parts.items()])).alias("report"))


def report_rows(report: DataFrame, column: str = "report") -> DataFrame:
    """(section, item, field, number): every section of a stored JSON report as rows.

    The text is parsed as VARIANT. A section is an object or a list of them;
    an object's texts name the item ('key=text', by key, joined with ';'), and
    each of its numbers is a row (one row without field if it has none). A list
    of texts gives their places, from 0.
    """
    top = report.select(F.parse_json(column).alias("_v"))
    sections = top.select(F.explode(F.map_entries(F.variant_get("_v", "$", "map<string,variant>"))).alias("_s")).select(
        F.col("_s.key").alias("section"), F.col("_s.value").alias("_v"))
    listed = F.schema_of_variant("_v").startswith("ARRAY")
    parts = F.when(listed, F.try_variant_get("_v", "$", "array<variant>")).otherwise(F.array("_v"))
    parts = sections.select("section", F.posexplode(parts).alias("_pos", "_v"))
    pairs = F.array_sort(F.transform(F.map_entries(F.try_variant_get("_v", "$", "map<string,variant>")), lambda e: F.struct(
        e["key"].alias("key"), F.schema_of_variant(e["value"]).alias("kind"), F.try_variant_get(e["value"], "$", "string").alias("text"))))
    parts = parts.withColumn("_o", F.schema_of_variant("_v").startswith("OBJECT")).withColumn("_p", F.when(F.col("_o"), pairs))
    texts = F.filter("_p", lambda e: e["kind"] == "STRING")
    item = F.when(F.col("_o"), F.array_join(F.transform(texts, lambda e: F.concat(e["key"], F.lit("="), e["text"])), ";")).otherwise(F.try_variant_get("_v", "$", "string"))
    place = F.array(F.struct(F.lit("position").alias("field"), F.col("_pos").cast("double").alias("number")))
    numbers = F.transform(F.filter("_p", lambda e: e["kind"] != "STRING"), lambda e: F.struct(e["key"].alias("field"), e["text"].cast("double").alias("number")))
    rows = parts.select("section", item.alias("item"), F.when(F.col("_o"), numbers).otherwise(place).alias("_n"))
    return rows.select("section", "item", F.explode_outer("_n").alias("_n")).select("section", "item", "_n.field", "_n.number")
