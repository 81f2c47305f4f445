"""Feature preparation: order history, lags, imputation, clipping, scaling, labels."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.functions import constants as k
from patronage.functions.expr import days_between, ladder, ratio, ratio0, zero_to_one
from patronage.operators.asof import as_of_features
from patronage.operators.profiling import label_mode
from patronage.operators.quantiles import exact_quantiles


# ---- choosing and completing columns -------------------------------------------------

def select_available(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ("customer_id",)) -> tuple[DataFrame, list[str]]:
    """The wanted columns that exist, and the names of those that do not."""
    present = [c for c in columns if c in df.columns]
    return df.select(*keep, *present), [c for c in columns if c not in df.columns]


def default_for(name: str) -> float:
    """Stand-in for an absent feature, by what its name says it measures."""
    if "count" in name or "total" in name:
        return 0.0
    if "avg" in name or "rate" in name:
        return 1.0
    if "score" in name:
        return 50.0
    if "days" in name:
        return 365.0
    return 0.0


def default_missing(df: DataFrame, columns: Sequence[str], by_name: bool = True) -> DataFrame:
    """Add absent columns, by name pattern or as 0."""
    absent = [c for c in columns if c not in df.columns]
    return df.withColumns({c: F.lit(default_for(c) if by_name else 0.0) for c in absent})


def with_purchases(df: DataFrame) -> DataFrame:
    return df.filter(F.col("monetary_value") > 0)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def require_rows(df: DataFrame, n: int = 100) -> bool:
    """Whether there are at least ``n`` rows, without counting beyond that."""
    return df.limit(n).count() >= n


def stamp(df: DataFrame, version: str, as_of: date) -> DataFrame:
    return df.withColumns({"dataset_created_at": F.lit(as_of), "data_version": F.lit(version)})


def fill_typed(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Numbers 0 and text 'Unknown' where absent; dates and flags are left, and so are the columns to
    ``keep``. A key that cannot be absent is best kept: a filled one is a new column to Spark, so rows
    that lie together by the old one are moved again by the next join or aggregate on it."""
    filled = {}
    for f in df.schema.fields:
        if f.name in keep:
            continue
        if isinstance(f.dataType, T.NumericType):
            filled[f.name] = F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType))
        elif isinstance(f.dataType, T.StringType):
            filled[f.name] = F.coalesce(F.col(f.name), F.lit("Unknown"))
    return df.withColumns(filled)


# ---- imputation, clipping, scaling ---------------------------------------------------

def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    medians = exact_quantiles(df, columns, [0.5])
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c][0]).cast("double")) for c in columns}
    )


def impute_mode(df: DataFrame, column: str, default: str = "medium") -> DataFrame:
    """Fill a label with the most common one; ties go to the smallest."""
    common = label_mode(df, column).first()["most_common"]
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(common if common is not None else default)))


def clip_iqr(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Clip to the quartiles widened by ``factor`` interquartile ranges. NULL stays NULL."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.75])
    clipped = {}
    for c in columns:
        q1, q3 = quartiles[c]
        v = F.col(c).cast("double")
        if q1 is None:
            clipped[c] = v
            continue
        low, high = q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)
        clipped[c] = F.when(v < low, F.lit(low)).when(v > high, F.lit(high)).otherwise(v)
    return df.withColumns(clipped)


def prepare_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Median imputation, then clipping, as used before training and before scoring."""
    return clip_iqr(impute_median(df, columns), columns)


def minmax(df: DataFrame, columns: Sequence[str], suffix: str = "_normalized") -> DataFrame:
    """Scale to 0..1; NULL where all values are equal."""
    low = {c: df.agg(F.min(F.col(c).cast("double"))).scalar() for c in columns}
    high = {c: df.agg(F.max(F.col(c).cast("double"))).scalar() for c in columns}
    return df.withColumns(
        {c + suffix: F.try_divide(F.col(c).cast("double") - low[c], high[c] - low[c]) for c in columns}
    )


def standardize(df: DataFrame, columns: Sequence[str], population: bool = True) -> DataFrame:
    """Zero mean and unit variance; a constant column becomes 0."""
    spread = F.stddev_pop if population else F.stddev_samp
    out = {}
    for c in columns:
        v = F.col(c).cast("double")
        mean, std = df.agg(F.avg(v)).scalar(), df.agg(spread(v)).scalar()
        out[c] = F.coalesce(F.try_divide(v - mean, std), F.lit(0.0))
    return df.withColumns(out)


def cut_equal(df: DataFrame, column: str, labels: Sequence[str], name: str) -> DataFrame:
    """Equal-width right-closed bins over the data range, the lowest value included."""
    v = F.col(column).cast("double")
    low, high = df.agg(F.min(v), F.max(v)).first()
    n = len(labels)
    if low is None:
        return df.withColumn(name, F.lit(None).cast("string"))
    if low == high:
        pad = abs(low) * 0.001 or 0.001
        low, high = low - pad, high + pad
    step = (high - low) / n
    edges = [low + i * step for i in range(1, n)]
    return df.withColumn(
        name, F.when(v.isNotNull(), ladder([(v <= edge, label) for edge, label in zip(edges, labels)], labels[-1]))
    )


# ---- dates and lags ------------------------------------------------------------------

def calendar_features(df: DataFrame, column: str) -> DataFrame:
    """day_of_week (Monday 0), month, quarter, year."""
    return df.withColumns(
        {
            "day_of_week": F.weekday(column),
            "month": F.month(column),
            "quarter": F.quarter(column),
            "year": F.year(column),
        }
    )


# Factors of the simulated lags and moving averages
SIMULATED = [
    ("revenue_lag_1", "monetary_value", 0.95),
    ("revenue_lag_7", "monetary_value", 0.90),
    ("revenue_lag_30", "monetary_value", 0.85),
    ("revenue_ma_7", "monetary_value", 0.98),
    ("revenue_ma_30", "monetary_value", 0.95),
    ("ctr_lag_1", "avg_ctr", 0.95),
    ("ctr_ma_7", "avg_ctr", 0.98),
]


def simulated_lags(df: DataFrame) -> DataFrame:
    """Lags and averages as constant multiples of the target. They leak it; kept because
    the published model uses them. See :func:`forecast_lags` for lags from the data."""
    out = {name: F.col(source).cast("double") * factor for name, source, factor in SIMULATED}
    return df.withColumns({**out, "ctr": F.col("avg_ctr")})


def daily_revenue(orders: DataFrame) -> DataFrame:
    """Revenue and orders per customer and day. At most one row per day is left of a
    customer, however many orders they have, so windows per customer stay small."""
    return orders.groupBy("customer_id", F.to_date("order_date").alias("order_day")).agg(
        F.sum("total_amount").alias("revenue"), F.count(F.lit(1)).alias("orders")
    )


def revenue_lags(orders: DataFrame, as_of: date | None = None) -> DataFrame:
    """Per customer and order day: revenue 1, 7 and 30 days earlier, and the mean over the
    last 7 and 30 days. Days without orders count as 0; range frames stand for them, so
    no calendar is generated."""
    daily = daily_revenue(orders if as_of is None else orders.filter(F.col("order_date") <= F.lit(as_of)))
    day = F.unix_date("order_day")
    per_customer = Window.partitionBy("customer_id").orderBy(day)

    def total(start: int, end: int):
        within = F.sum("revenue").over(per_customer.rangeBetween(start, end))
        return F.coalesce(within.cast("double"), F.lit(0.0))

    return daily.select(
        "customer_id",
        "order_day",
        F.col("revenue").cast("double").alias("revenue"),
        *[total(-n, -n).alias(f"revenue_lag_{n}") for n in (1, 7, 30)],
        *[(total(1 - n, 0) / n).alias(f"revenue_ma_{n}") for n in (7, 30)],
    )


def latest_lags(lags: DataFrame) -> DataFrame:
    """The row of each customer's last order day."""
    rest = [c for c in lags.columns if c not in ("customer_id", "order_day")]
    last = lags.groupBy("customer_id").agg(F.max(F.struct("order_day", *rest)).alias("l"))
    return last.select("customer_id", *[f"l.{c}" for c in rest])


def daily_clicks(performance: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Clicks and impressions per target audience and day. Rows of a campaign are summed per day
    before they meet the campaign, so a large campaign is one row per day in the join."""
    per_campaign = performance.groupBy("campaign_id", F.to_date("date").alias("click_day")).agg(
        F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions")
    )
    audiences = campaigns.select("campaign_id", "target_audience")
    return per_campaign.join(audiences, "campaign_id").groupBy("target_audience", "click_day").agg(
        F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions")
    )


def label_days(df: DataFrame, as_of: date, at_last_order: bool) -> DataFrame:
    """customer_id, target_audience and ``label_day``, before which lags are taken: the day of the
    last order for training, ``as_of`` for scoring."""
    day = F.date_sub(F.lit(as_of), F.col("recency_days").cast("int")) if at_last_order else F.lit(as_of)
    return df.select("customer_id", "target_audience", day.alias("label_day"))


def forecast_lags(labels: DataFrame, orders: DataFrame, performance: DataFrame, campaigns: DataFrame) -> DataFrame:
    """:func:`lags_of_days` from orders and campaign rows."""
    return lags_of_days(labels, daily_revenue(orders), daily_clicks(performance, campaigns))


def lags_of_days(labels: DataFrame, revenue: DataFrame, clicks: DataFrame) -> DataFrame:
    """Lags and averages of :data:`SIMULATED` from the data, for each row of :func:`label_days`.

    ``revenue_lag_n`` is the revenue of the customer's latest order day at least n days before the
    label, ``revenue_ma_n`` the mean per day over the n days before it; the click rates are those of
    the customer's audience. Nothing of the label day or later is seen. A lag without an earlier
    day is NULL. ``revenue`` is of :func:`daily_revenue`, ``clicks`` of :func:`daily_clicks`.
    """
    spent = as_of_features(
        revenue, labels, "customer_id", "order_day", "label_day", ["revenue"], [1, 7, 30], [7, 30]
    )
    named = labels.filter(F.col("target_audience").isin(*sorted(set(k.SEGMENT_AUDIENCE.values()))))
    clicked = as_of_features(
        clicks, named, "target_audience", "click_day", "label_day",
        ["clicks", "impressions"], [1], [7],
    )
    rates = clicked.select(
        "target_audience",
        "label_day",
        F.when(F.col("clicks_lag_1").isNotNull(), ratio0("clicks_lag_1", "impressions_lag_1")).alias("ctr_lag_1"),
        ratio0("clicks_sum_7", "impressions_sum_7").alias("ctr_ma_7"),
    )
    # at most one row per day for each audience that the fixed mapping names
    return (
        labels.join(spent, ["customer_id", "label_day"], "left")
        .join(F.broadcast(rates), ["target_audience", "label_day"], "left")
        .select(
            "customer_id",
            "label_day",
            *[F.col(f"revenue_lag_{n}").cast("double").alias(f"revenue_lag_{n}") for n in (1, 7, 30)],
            *[(F.col(f"revenue_sum_{n}").cast("double") / n).alias(f"revenue_ma_{n}") for n in (7, 30)],
            "ctr_lag_1",
            "ctr_ma_7",
        )
    )


def order_gaps(orders: DataFrame) -> DataFrame:
    """Days between consecutive order days of a customer; NULL for the first."""
    previous = F.lag("order_day").over(Window.partitionBy("customer_id").orderBy("order_day"))
    return (
        daily_revenue(orders)
        .select("customer_id", "order_day", "orders")
        .withColumn("previous_order_day", previous)
        .withColumn("gap_days", F.datediff("order_day", "previous_order_day"))
    )


def order_history_features(orders: DataFrame, as_of: date, windows: Sequence[int] = (30, 90, 365)) -> DataFrame:
    """Orders and revenue in trailing windows, first order, and the mean gap between orders.

    The mean of consecutive gaps is (last - first) / (orders - 1), so no sort is needed.
    """
    day = F.to_date("order_date")
    columns = []
    for n in windows:
        recent = day >= F.date_sub(F.lit(as_of), n)
        columns += [
            F.count_if(recent).alias(f"order_count_{n}d"),
            F.coalesce(F.sum(F.when(recent, F.col("total_amount"))), F.lit(0)).cast("double").alias(f"revenue_{n}d"),
        ]
    grouped = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.min(day).alias("_first"),
        F.max(day).alias("_last"),
        *columns,
    )
    span = F.datediff("_last", "_first")
    return grouped.withColumns(
        {
            "days_since_first_order": days_between("_first", F.lit(as_of)),
            "avg_days_between_orders": ratio(span, F.col("total_orders") - 1),
        }
    ).drop("_first", "_last")


# ---- journey features and labels -----------------------------------------------------

def journey_stage():
    orders = F.col("frequency")
    return ladder(
        [
            (orders >= 5, "loyal_customer"),
            (orders >= 2, "repeat_customer"),
            (orders > 0, "first_time_buyer"),
            (F.col("cart_adds") > 0, "cart_abandoner"),
            (F.col("product_views") > 0, "product_browser"),
        ],
        "visitor",
    )


def additive_conversion_probability(score_bounds: Sequence[tuple[float, float]] = ((80, 0.3), (60, 0.2), (40, 0.1))):
    """Base rate plus a step per sign of interest, at most 0.95. The score bounds were made
    for a 0-100 score; a three-digit RFM score always takes the first step."""

    def step(column: str, bound: float, gain: float):
        return F.when(F.col(column) > bound, F.lit(gain)).otherwise(F.lit(0.0))

    by_score = ladder([(F.col("rfm_score") > bound, F.lit(gain)) for bound, gain in score_bounds], F.lit(0.0))
    return F.least(
        F.lit(0.1)
        + by_score
        + step("total_page_views", 10, 0.1)
        + step("total_events", 5, 0.1)
        + step("total_interactions", 3, 0.1)
        + step("product_views", 5, 0.1)
        + step("cart_adds", 0, 0.2),
        F.lit(0.95),
    )


def journey_features(df: DataFrame, as_of: date) -> DataFrame:
    """Stage, conversion probability and behaviour ratios; divisors of 0 count as 1."""

    def per(num, den):
        return ratio(num, zero_to_one(den))

    views, sessions = F.col("total_page_views"), F.col("total_sessions")
    with_age = df.withColumn("days_since_first_visit", F.datediff(F.lit(as_of), F.to_date("registration_date")))
    return with_age.withColumns(
        {
            "journey_stage": journey_stage(),
            "conversion_probability": additive_conversion_probability(),
            "avg_session_duration": per(sessions, views),
            "bounce_rate": per(sessions - views, sessions),
            "engagement_score": views * 0.3 + F.col("total_events") * 0.4 + F.col("total_interactions") * 0.3,
            "visit_frequency": per(sessions, "days_since_first_visit"),
            "avg_product_views": per("product_views", sessions),
            "cart_add_rate": per("cart_adds", "product_views"),
            "purchase_rate": per("frequency", "cart_adds"),
        }
    )


def label_campaign_success(df: DataFrame) -> DataFrame:
    roas, ctr = F.col("avg_roas"), F.col("avg_ctr")
    label = ladder([((roas > 3.0) & (ctr > 0.05), "high"), ((roas > 2.0) & (ctr > 0.03), "medium")], "low")
    return df.withColumn("campaign_success", label)


def label_optimal_budget(df: DataFrame) -> DataFrame:
    """Audience revenue weighted by half its ROAS, within 100 and 1000."""
    weighted = F.col("total_campaign_revenue").cast("double") * (F.col("avg_roas") / 2.0)
    bounded = F.least(F.greatest(weighted, F.lit(100.0)), F.lit(1000.0))
    return df.withColumn("optimal_budget", F.when(weighted.isNotNull(), bounded))


def label_history(df: DataFrame) -> DataFrame:
    """Labels of the order-history model variant: success above both medians, 10 % of
    lifetime value, revenue grown by frequency, bounded click rate, stage 0-4, and
    above-median value."""
    medians = exact_quantiles(df, ["avg_roas", "avg_ctr", "monetary_value"], [0.5])

    def above(column: str):
        return F.col(column).cast("double") > F.lit(medians[column][0]).cast("double")

    frequency = F.col("frequency").cast("double")
    grown = F.lit(1.0) + frequency / 10

    def flag(condition):
        return F.coalesce(condition, F.lit(False)).cast("int")

    return df.withColumns(
        {
            "label_success": flag(above("avg_roas") & above("avg_ctr")),
            "label_budget": F.col("customer_lifetime_value").cast("double") * 0.1,
            "label_revenue": F.col("monetary_value").cast("double") * grown,
            "label_ctr": F.least(F.greatest(F.lit(0.05) * grown, F.lit(0.01)), F.lit(0.15)),
            "label_stage": F.least(F.greatest(F.floor(frequency / 2), F.lit(0)), F.lit(4)).cast("int"),
            "label_conversion": flag(above("monetary_value")),
        }
    )


# ---- plan and forecast formulas ------------------------------------------------------

def roi_estimate(budget: str):
    return F.col(budget) * 0.15


def expected_value(probability: str):
    return F.col(probability) * 100


def campaign_plan(df: DataFrame, budget: str = "budget", audience_size: str = "target_audience_size") -> DataFrame:
    """Budget raised by a fifth, 5 % of the audience as conversions, and the usual channels."""
    return df.withColumns(
        {
            "recommended_budget": F.col(budget).cast("double") * 1.2,
            "expected_roas": F.lit(3.5),
            "predicted_conversions": F.floor(F.col(audience_size) * F.lit(0.05)).cast("bigint"),
            "optimal_channels": F.array(*[F.lit(c) for c in k.CAMPAIGN_PLAN_CHANNELS]),
        }
    )


def journey_path(df: DataFrame, steps: int, journey: str = "journey") -> DataFrame:
    """Typical path of a journey, cut to ``steps``, with its conversion and revenue."""
    paths = F.create_map(
        *[x for name, path in k.JOURNEY_PATHS.items() for x in (F.lit(name), F.array(*[F.lit(p) for p in path]))]
    )
    default = F.array(*[F.lit(p) for p in k.JOURNEY_PATH_DEFAULT])
    buys = F.coalesce(F.col(journey) == "purchase", F.lit(False))
    return df.withColumns(
        {
            "predicted_path": F.slice(F.coalesce(F.try_element_at(paths, F.col(journey)), default), 1, steps),
            "path_conversion_probability": F.when(buys, 0.3).otherwise(0.1),
            "expected_revenue": F.when(buys, 150.0).otherwise(0.0),
        }
    )


def forecast_band(df: DataFrame, column: str, as_of: date, horizon: int) -> DataFrame:
    """A forecast's date and a band of 20 % around it."""
    return df.withColumns(
        {
            "forecast_date": F.date_add(F.lit(as_of), horizon),
            "confidence_lower": F.col(column) * 0.8,
            "confidence_upper": F.col(column) * 1.2,
        }
    )
