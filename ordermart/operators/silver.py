"""Silver layer: clean, classify, enrich and derive the order fact.

Each step is a DataFrame -> DataFrame function; nothing runs until a sink or
an action. Narrow steps (fill, normalise, recompute, cast, classify, bands)
fuse into one whole-stage-codegen projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import rules
from ..functions.calendar import is_weekend, local_load_time
from ..functions.text import normalise_city
from ..session import materialize
from ..schemas import CORRUPT_COL, CUSTOMER_DIM_COLS, PARTNER_DIM_COLS, RESTAURANT_DIM_COLS
from . import quality
from .history import (HEAVY_ROWS, OUT_COLS, customer_history, customer_history_hybrid,
                      customer_history_window)
from .skew_join import data_bytes, left_join


# ---------------------------------------------------------------- cleaning --

def dedup(orders: DataFrame, key: str = "order_id",
          order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per ``key``: the first row by ``order_by`` (ascending).

    ``row_number() = 1`` per key. Spark plans this as a WindowGroupLimit in
    two steps: a PARTIAL limit sorts each input partition and keeps one row per
    key BEFORE the shuffle, a final one after it. So a key with millions of
    copies sends at most one row per map task through the exchange, like a
    partial aggregate, and the survivor is deterministic (the pipeline's
    ``dropDuplicates`` kept an arbitrary row). ``order_by`` defaults to all
    other columns (then the survivor is the smallest row). NULL keys collapse
    into one row, like ``dropDuplicates``.
    """
    rest = [c for c in orders.columns if c != key]
    order_by = list(order_by) if order_by is not None else rest
    w = Window.partitionBy(key).orderBy(*order_by)
    return (orders.withColumn("_dup_rn", F.row_number().over(w))
            .filter(F.col("_dup_rn") == 1).drop("_dup_rn"))


def fill_defaults(orders: DataFrame, columns: Sequence[str] = rules.FILL_ZERO_COLUMNS,
                  value: float = 0.0) -> DataFrame:
    return orders.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in columns})


def normalise_cities(orders: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    return orders.withColumn("delivery_city", normalise_city("delivery_city", aliases))


def recompute_final(orders: DataFrame) -> DataFrame:
    """``final_amount = round(order_amount - discount + tip, 2)`` (source value dropped)."""
    return orders.withColumn("final_amount", F.round(
        F.col("order_amount") - F.col("discount_amount") + F.col("tip_amount"), 2))


def enforce_types(orders: DataFrame) -> DataFrame:
    """ANSI-safe casts: malformed values become NULL instead of failing the job."""
    types = {f.name: f.dataType for f in orders.schema.fields}
    out = {}
    if not isinstance(types.get("order_date"), T.DateType):
        out["order_date"] = F.col("order_date").try_cast("date")
    if not isinstance(types.get("order_timestamp"), (T.TimestampType, T.TimestampNTZType)):
        out["order_timestamp"] = F.col("order_timestamp").try_cast("timestamp_ntz")
    for c, t in (("order_amount", "double"), ("final_amount", "double"),
                 ("delivery_time_minutes", "int")):
        if types.get(c) != T._parse_datatype_string(t):
            out[c] = F.col(c).try_cast(t)
    return orders.withColumns(out) if out else orders


def clean(orders: DataFrame, key: str = "order_id", order_by: Sequence[str] | None = None,
          city_aliases: Mapping[str, str] | None = None,
          drop: Sequence[str] = ()) -> DataFrame:
    """dedup -> fill -> normalise city -> recompute final -> types."""
    d = dedup(orders, key, order_by)
    if drop:
        d = d.drop(*drop)
    return _normalise(d, city_aliases)


def _normalise(orders: DataFrame, city_aliases: Mapping[str, str] | None = None) -> DataFrame:
    return enforce_types(recompute_final(normalise_cities(fill_defaults(orders), city_aliases)))


# -------------------------------------------------------------- enrichment --

BROADCAST_MAX_BYTES = 64 << 20


def _dim(df: DataFrame, cols: Sequence[str], broadcast: bool | int) -> DataFrame:
    """Projected dimension; with ``broadcast`` the hint is added only after a
    pass over it proves its bytes within the bound (True = BROADCAST_MAX_BYTES)."""
    d = df.select(*cols)
    if broadcast is False or broadcast is None:
        return d
    bound = BROADCAST_MAX_BYTES if broadcast is True else int(broadcast)
    return F.broadcast(d) if data_bytes(d) <= bound else d


def unique_dimension(dim: DataFrame, key: str) -> DataFrame:
    """One row per key (the smallest row), so a duplicated dimension key can
    not fan out the fact in the join. Map-side group limit, like ``dedup``."""
    return dedup(dim, key)


def normalise_dimension_city(dim: DataFrame, col: str = "city",
                             aliases: Mapping[str, str] | None = None) -> DataFrame:
    """The fact's ``upper(trim(city))`` (and alias map) applied to a dimension."""
    return dim.withColumn(col, normalise_city(col, aliases)) if col in dim.columns else dim


HISTORY_FIRST = ("customer_id", "restaurant_id", "delivery_partner_id")
# without the history: restaurants, the smallest dimension, last (mostly broadcast, so no
# shuffle moves their columns); customers after partners, so the rows of a customer are
# together in what is stored, and aggregates by customer collapse before their shuffle
HISTORY_UNREAD = ("delivery_partner_id", "customer_id", "restaurant_id")


def enrich(clean_orders: DataFrame, customers: DataFrame, restaurants: DataFrame,
           partners: DataFrame, broadcast_dims: bool | int = False,
           dedup_dims: bool = False, normalise_dims: bool = False,
           salt_rows: int | None = None, counts_from: DataFrame | None = None,
           joins: Sequence[str] = HISTORY_FIRST) -> DataFrame:
    """Three LEFT joins to the dimensions (orphans keep NULL attributes).

    ``salt_rows``: joins to dimensions beyond the broadcast threshold deal the
    rows of heavier keys, and those without a key, over many tasks
    (``skew_join``); ``counts_from`` is the stored form of the fact, where its
    keys are counted. Without it the skew is left to AQE.

    ``broadcast_dims=False`` leaves the strategy to Spark: a dimension below
    ``spark.sql.autoBroadcastJoinThreshold`` (estimated from its scan size) or
    found small at runtime by AQE is broadcast; a large one is joined by
    shuffle (AQE splits skewed fact partitions). ``True`` (or a bound in
    bytes) measures each dimension and hints a broadcast only for those within
    the bound; the rest are still left to Spark.

    The customer join comes first: after the history window the fact is
    already hash-partitioned by customer, so a shuffle join on customer_id
    only moves the dimension. The windows run BEFORE the joins on purpose:
    with heavy customers present the history is a union (plain + bucketed)
    and the customer join re-shuffles the fact, but AQE can then split a hot
    customer's join partition, because the restaurant join re-shuffles
    anyway. Joining customers first would leave the hot customer in one join
    task: the window above it needs customer clustering, so AQE would not
    split it. ``joins`` names another order of the keys, for a fact whose history
    nobody reads (then nothing is partitioned by customer yet).

    ``dedup_dims`` keeps one row per dimension key first (the pipeline does
    not, so a duplicated key multiplies fact rows); ``normalise_dims`` applies
    the fact's city normalisation to the dimensions' ``city`` columns.
    """
    if normalise_dims:
        customers = normalise_dimension_city(customers)
        restaurants = normalise_dimension_city(restaurants)
        partners = normalise_dimension_city(partners)
    if dedup_dims:
        customers = unique_dimension(customers, "customer_id")
        restaurants = unique_dimension(restaurants, "restaurant_id")
        partners = unique_dimension(partners, "delivery_partner_id")
    out = clean_orders
    dims = {"customer_id": (customers, CUSTOMER_DIM_COLS), "restaurant_id": (restaurants, RESTAURANT_DIM_COLS),
            "delivery_partner_id": (partners, PARTNER_DIM_COLS)}
    for key in joins:
        dim, cols = dims[key]
        if salt_rows and not broadcast_dims:
            out = left_join(out, dim.select(*cols), key, ["order_id"], salt_rows, counts_from)
        else:
            out = out.join(_dim(dim, cols, broadcast_dims), on=key, how="left")
    return out


def speed_band(minutes: str = "delivery_time_minutes"):
    expr = None
    for bound, label in rules.SPEED_BANDS:
        cond = F.col(minutes) <= bound
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(rules.SPEED_OTHERWISE))


def derive(silver: DataFrame) -> DataFrame:
    """Speed band, high-value flag and weekend flag (one projection)."""
    return silver.withColumns({
        "delivery_speed_category": speed_band(),
        "high_value_order": F.when(F.col("final_amount") >= rules.HIGH_VALUE_FROM, F.lit(1))
        .otherwise(F.lit(0)),
        "is_weekend": is_weekend("order_date"),
    })


def with_history(silver: DataFrame, skew_safe: bool = True, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Customer history; ``skew_safe`` splits customers above ``heavy_rows``
    rows over many tasks (``heavy_rows=0`` sends every customer that way)."""
    if not skew_safe:
        return customer_history_window(silver)
    if heavy_rows <= 0:
        return customer_history(silver)
    return customer_history_hybrid(silver, heavy_rows=heavy_rows)


# ------------------------------------------------------------------ build --

def flagged_orders(raw_orders: DataFrame, null_policy: str = "pass", **clean_kw) -> DataFrame:
    """Clean, classified orders. Records that the raw scan could not parse
    (``CORRUPT_COL``) are flagged MALFORMED and take no part in dedup, where
    their NULL ids would merge them."""
    if CORRUPT_COL not in raw_orders.columns:
        return quality.classify(clean(raw_orders, **clean_kw), null_policy)
    broken = F.col(CORRUPT_COL).isNotNull()
    good = quality.classify(clean(raw_orders.filter(~broken), **clean_kw), null_policy)
    bad = _normalise(raw_orders.filter(broken).drop(*clean_kw.get("drop", ())),
                     clean_kw.get("city_aliases"))
    return good.unionByName(bad.withColumn("dq_flag", F.lit(rules.MALFORMED_FLAG)))


def clean_orders_of(raw_orders: DataFrame, columns: Sequence[str], null_policy: str = "pass",
                    key: str = "order_id", order_by: Sequence[str] | None = None,
                    city_aliases: Mapping[str, str] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """Some columns of the clean rows of ``flagged_orders``, with less to shuffle.

    A row is normalised and classified by itself, so both come before the dedup, which
    then moves these columns only, and of a row that would go to quarantine no more
    than its key and its place in the order (it may still be the one that is kept).
    With the default order (all columns) nothing can be left out."""
    broken = CORRUPT_COL in raw_orders.columns
    if order_by is None or key in _NORMALISED:
        return quality.split(flagged_orders(
            raw_orders, null_policy, key=key, order_by=order_by, city_aliases=city_aliases, drop=drop))[0].select(*columns)
    # records that could not be parsed take no part in the dedup
    rows = raw_orders.filter(F.col(CORRUPT_COL).isNull()) if broken else raw_orders
    places = {f"_by{i}": c for i, c in enumerate(order_by)}
    rows = quality.classify(_normalise(rows.withColumns({p: F.col(c) for p, c in places.items()}), city_aliases), null_policy)
    ok = F.col("_ok")
    rows = rows.withColumn("_ok", F.col("dq_flag") == rules.OK_FLAG).select(
        key, *[F.when(ok, F.col(c)).alias(c) for c in columns if c != key], "_ok", *places)
    return dedup(rows, key, list(places)).filter(ok).select(*columns)


# columns that the cleaning steps change
_NORMALISED = (*rules.FILL_ZERO_COLUMNS, "delivery_city", "final_amount", "order_date", "order_timestamp",
               "order_amount", "delivery_time_minutes")
# order columns that the joins, the history and the derived columns read
_DERIVED_FROM = ("order_id", "customer_id", "restaurant_id", "delivery_partner_id", "order_date",
                 "final_amount", "delivery_time_minutes")


def build_silver(raw_orders: DataFrame, customers: DataFrame, restaurants: DataFrame,
                 partners: DataFrame, now=None, broadcast_dims: bool = False,
                 skew_safe: bool = True, null_policy: str = "pass",
                 stage: bool = True, heavy_rows: int = HEAVY_ROWS,
                 dedup_dims: bool = False, normalise_dims: bool = False,
                 **clean_kw) -> tuple[DataFrame, DataFrame]:
    """(silver_orders, quarantine_orders); see ``build_silver_parts``."""
    parts = build_silver_parts(raw_orders, customers, restaurants, partners, now,
                               broadcast_dims, skew_safe, null_policy, stage, heavy_rows,
                               dedup_dims, normalise_dims, **clean_kw)
    return parts["silver"], parts["quarantine"]


def build_silver_parts(raw_orders: DataFrame, customers: DataFrame, restaurants: DataFrame,
                       partners: DataFrame, now=None, broadcast_dims: bool = False,
                       skew_safe: bool = True, null_policy: str = "pass",
                       stage: bool = True, heavy_rows: int = HEAVY_ROWS,
                       dedup_dims: bool = False, normalise_dims: bool = False,
                       salt_rows: int | None = None, columns: Sequence[str] | None = None,
                       **clean_kw) -> dict[str, DataFrame]:
    """``silver``, ``quarantine`` and the (staged) classified ``flagged`` orders.

    ``salt_rows``: see ``enrich``; None leaves skewed joins to AQE.

    ``columns``: the silver columns that a caller reads. Then only the clean rows
    are staged, in the order columns that these come from; silver has no others,
    and the quarantine and the flagged orders are not staged.

    With ``stage=True`` the deduplicated, classified orders are written once
    to the shared scratch folder: the quarantine, the history windows and its
    summary aggregates all read that copy, so the dedup shuffle runs once.
    The customer-history windows run on the clean fact BEFORE the dimension
    joins, so they shuffle only the order columns.
    """
    flagged = flagged_orders(raw_orders, null_policy, **clean_kw)
    if stage and columns is None:
        flagged = materialize(flagged, "flagged-orders")
    clean_rows, quarantine = quality.split(flagged)
    if columns is not None:
        clean_rows = clean_orders_of(raw_orders, [c for c in clean_rows.columns if c in {*columns, *_DERIVED_FROM}],
                                     null_policy, **clean_kw)
        if stage:
            clean_rows = materialize(clean_rows, "clean-orders")
    hist = with_history(clean_rows, skew_safe, heavy_rows=heavy_rows)
    silver = derive(enrich(hist, customers, restaurants, partners, broadcast_dims,
                           dedup_dims, normalise_dims,
                           salt_rows=salt_rows, counts_from=clean_rows if stage else None,
                           joins=HISTORY_UNREAD if columns is not None and not {*columns} & {*OUT_COLS} else HISTORY_FIRST))
    silver = silver.withColumn("silver_load_time", local_load_time(now))
    return {"silver": silver.select(*[c for c in silver_column_order(silver.columns)
                                      if columns is None or c in columns]),
            "quarantine": quarantine, "flagged": flagged}


def silver_column_order(cols: Sequence[str]) -> list[str]:
    """Join keys first (as the pipeline's joins produce them), then the order
    columns, dimension attributes, derived columns, history, load time."""
    keys = ["delivery_partner_id", "restaurant_id", "customer_id"]
    dims = [c for c in CUSTOMER_DIM_COLS + RESTAURANT_DIM_COLS + PARTNER_DIM_COLS
            if c not in keys]
    tail = ["delivery_speed_category", "high_value_order", "is_weekend",
            "customer_order_number", "previous_order_amount", "running_customer_revenue",
            "silver_load_time"]
    first = [c for c in keys if c in cols]
    middle = [c for c in cols if c not in first and c not in dims and c not in tail]
    return first + middle + [c for c in dims if c in cols] + [c for c in tail if c in cols]
