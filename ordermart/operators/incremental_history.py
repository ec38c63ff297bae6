"""Customer history kept up to date by new orders only.

``HistoryStore`` holds, below one folder,

* ``rows``: history rows, appended batch by batch (never rewritten);
* ``state``: one row a customer: number of orders, last day, last order's amount,
  cents so far; a new version a batch;
* ``rebuilt``: (customer, batch): rows of an earlier batch of that customer are void.

A batch falls into two parts by its customers:

* **ahead**: all new orders of the customer are on later days than the state's last
  one (or the customer is new). Their history is that of the new rows alone, moved
  by the state: only new rows and their customers' states are read.
* **late**: some order is on the last day or before. Those customers' stored rows and
  new ones are taken together and their history is computed anew; the old rows become
  void. Same-day orders count as late, since a running total holds the whole day.

A day-by-day run gives the rows of one full build over all orders, whatever the
order of arrival. Orders without a customer are one customer more, as in the full
build. A repeated ``order_id`` must be removed before (``silver.dedup``), within and
between batches.

Each batch writes its files first; the commit is one file that names them, made
by an atomic create, so a failing batch leaves the store as it was.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import units, units_to_double
from ..session import delete_path
from ..sinks.manifests import read_text, write_once
from .history import HEAVY_ROWS, OUT_COLS, customer_history_hybrid

BATCH = "_batch"


def _same(a: DataFrame, b: DataFrame, key: str, name: str) -> Column:
    return a[key].eqNullSafe(b[name])


class HistoryStore:
    """A stored customer history; ``advance`` adds a batch of clean orders."""

    def __init__(self, spark: SparkSession, folder: str, cust: str = "customer_id", date: str = "order_date",
                 oid: str = "order_id", amount: str = "final_amount", heavy_rows: int = HEAVY_ROWS) -> None:
        self.spark, self.folder, self.heavy_rows = spark, folder.rstrip("/"), heavy_rows
        self.cust, self.date, self.oid, self.amount = cust, date, oid, amount

    # ------------------------------------------------------------- reading --

    def _commits(self) -> list[dict]:
        """The committed batches, in order."""
        return [json.loads(text) for _, text in read_text(self.spark, self.folder, "batch-")]

    def _stored(self, name: str, commits: list[dict]) -> DataFrame | None:
        paths = [f"{self.folder}/{c[name]}" for c in commits if c.get(name)]
        return self.spark.read.parquet(*paths) if paths else None

    def rows(self) -> DataFrame | None:
        """The present history: all orders with ``history.OUT_COLS``; None if empty."""
        return self._rows(self._commits())

    def _rows(self, commits: list[dict]) -> DataFrame | None:
        rows = self._stored("rows", commits)
        if rows is None:
            return None
        void = self._stored("rebuilt", commits)
        if void is not None:
            void = void.groupBy(F.col(self.cust).alias("_c")).agg(F.max(BATCH).alias("_from"))
            rows = (rows.join(void, _same(rows, void, self.cust, "_c"), "left")
                    .filter(F.col("_from").isNull() | (F.col(BATCH) >= F.col("_from"))))
        return rows.drop(BATCH, "_c", "_from")

    def state(self) -> DataFrame | None:
        commits = self._commits()
        return self._stored("state", commits[-1:])

    # ------------------------------------------------------------- writing --

    def _state_of(self, rows: DataFrame) -> DataFrame:
        """One row a customer from its rows."""
        amount = units(self.amount)
        return rows.groupBy(self.cust).agg(
            F.count(F.lit(1)).alias("n"), F.max(self.date).alias("last_day"),
            F.max_by(F.col(self.amount), F.struct(self.date, self.oid)).alias("last_amount"),
            F.sum(amount).alias("cents"))

    def advance(self, orders: DataFrame) -> dict[str, int]:
        """Add a batch; returns the numbers of rows (ahead, rebuilt)."""
        commits = self._commits()
        number, tag = len(commits), uuid.uuid4().hex[:12]
        place = lambda name: f"{name}/{number:06d}-{tag}"
        path = lambda name: f"{self.folder}/{place(name)}"
        columns = [c for c in orders.columns]
        orders.write.parquet(path("new"))
        new = self.spark.read.parquet(path("new"))
        try:
            commit = {"rows": place("rows")}
            if not commits:
                self._history(new, number).write.parquet(path("rows"))
                rows = self.spark.read.parquet(path("rows"))
                self._state_of(rows).write.parquet(path("state"))
                counts = {"ahead": rows.count(), "rebuilt": 0}
            else:
                counts = self._merge(new, columns, commits, number, path)
                if counts["rebuilt"]:
                    commit["rebuilt"] = place("rebuilt")
            commit["state"] = place("state")
            if not write_once(self.spark, f"{self.folder}/batch-{number:06d}", json.dumps(commit)):
                raise RuntimeError(f"{self.folder}: another writer has added batch {number}")
        finally:
            delete_path(self.spark, path("new"))
        return counts

    def _history(self, rows: DataFrame, number: int) -> DataFrame:
        out = customer_history_hybrid(rows, self.cust, self.date, self.oid, self.amount, heavy_rows=self.heavy_rows)
        return out.withColumn(BATCH, F.lit(number))

    def _merge(self, new: DataFrame, columns: list[str], commits: list[dict], number: int, path) -> dict[str, int]:
        cust, spark = self.cust, self.spark
        state = self._stored("state", commits[-1:])
        met = new.groupBy(F.col(cust).alias("_c")).agg(F.min(self.date).alias("_first"), F.count_if(F.col(self.date).isNull()).alias("_open"))
        old = state.join(met, _same(state, met, cust, "_c"))
        # days are compared null-safe: an order without a day sorts before all
        late = old.filter((F.col("_open") > 0) | ~F.coalesce(F.col("_first") > F.col("last_day"), F.col("last_day").isNull()))
        late.select(F.col("_c").alias(cust)).withColumn(BATCH, F.lit(number)).write.parquet(path("rebuilt"))
        late = spark.read.parquet(path("rebuilt")).select(F.col(cust).alias("_l"))
        is_late = lambda df: _same(df, late, cust, "_l")

        ahead = new.join(late, is_late(new), "left_anti")
        s = state.select(F.col(cust).alias("_c"), F.col("n").alias("_n"), F.col("cents").alias("_cents"),
                         F.col("last_amount").alias("_last"))
        fresh = self._history(ahead, number)
        moved = fresh.join(s, _same(fresh, s, cust, "_c"), "left")
        first = F.col("customer_order_number") == 1
        run = F.col("running_customer_revenue")
        both = units_to_double(units(F.coalesce(run, F.lit(0.0))) + F.coalesce("_cents", F.lit(0)))
        moved = moved.withColumns({
            "previous_order_amount": F.when(first & F.col("_n").isNotNull(), F.col("_last")).otherwise(F.col("previous_order_amount")),
            "customer_order_number": (F.col("customer_order_number") + F.coalesce("_n", F.lit(0))).cast("int"),
            "running_customer_revenue": F.when(run.isNull() & F.col("_cents").isNull(), F.lit(None).cast("double")).otherwise(both),
        }).drop("_c", "_n", "_cents", "_last")

        kept = self._rows(commits)
        again = kept.join(late, is_late(kept), "left_semi").select(*columns).unionByName(
            new.join(late, is_late(new), "left_semi").select(*columns))
        moved.select(*columns, *OUT_COLS, BATCH).write.parquet(path("rows"))
        n_ahead = spark.read.parquet(path("rows")).count()
        n_again = 0
        if not late.isEmpty():
            self._history(again, number).select(*columns, *OUT_COLS, BATCH).write.mode("append").parquet(path("rows"))
            n_again = spark.read.parquet(path("rows")).count() - n_ahead
        rows = spark.read.parquet(path("rows"))
        self._next_state(state, rows, late).write.parquet(path("state"))
        return {"ahead": n_ahead, "rebuilt": n_again}

    def _next_state(self, state: DataFrame, rows: DataFrame, late: DataFrame) -> DataFrame:
        """The states of unchanged customers, moved ones and rebuilt ones: the
        new rows summed up and added to the old state of those not rebuilt."""
        cust = self.cust
        base = state.join(late, _same(state, late, cust, "_l"), "left_anti")
        part = base.withColumn("_new", F.lit(False)).unionByName(self._state_of(rows).withColumn("_new", F.lit(True)))
        newest = F.max_by("last_amount", "_new")
        return part.groupBy(cust).agg(F.sum("n").alias("n"), F.max("last_day").alias("last_day"),
                                      newest.alias("last_amount"), F.sum("cents").alias("cents"))


def empty_rows(orders: DataFrame) -> T.StructType:
    """The schema of a store's rows over ``orders``."""
    kinds = {"customer_order_number": T.IntegerType(), "previous_order_amount": T.DoubleType(),
             "running_customer_revenue": T.DoubleType()}
    return T.StructType([*orders.schema.fields, *[T.StructField(c, kinds[c]) for c in OUT_COLS]])
