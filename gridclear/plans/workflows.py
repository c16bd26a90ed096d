"""The regular jobs: load activations, load bids, price the activated quarter-hours, keep views of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclear.operators import cleaning as cl
from gridclear.operators import price_curve as pc
from gridclear.operators import profile_state as ps
from gridclear.operators.merit_order import active_bids, date_range, marginal_prices
from gridclear.schema import ACTIVATIONS, ACTIVE_BIDS, BIDS, MARGINAL_PRICES
from gridclear.sources.bid_import import BidImport
from gridclear.sources.delimited import scan_activation_csv
from gridclear.sources.landing import read_binary
from gridclear.sources.period_table import PeriodTable
from gridclear.sources.stored_view import Range, Source, StoredView
from gridclear.sources.workbooks import scan_sheets


class InvalidActivations(ValueError):
    """Activation files failed a check; nothing was loaded."""


def activation_table(spark: SparkSession, root: str) -> PeriodTable:
    return PeriodTable(spark, root, ACTIVATIONS, ["year", "month"], sort_by=["date", "quarter_no"])


def bid_table(spark: SparkSession, root: str) -> PeriodTable:
    return PeriodTable(spark, root, BIDS, ["delivery_date"], sort_by=["product", "energy_price_eur_mwh"])


def price_table(spark: SparkSession, root: str) -> PeriodTable:
    return PeriodTable(spark, root, MARGINAL_PRICES, ["date"], sort_by=["timestamp"])


def bid_profile_view(spark: SparkSession, root: str, bids: PeriodTable, columns: list[str]) -> StoredView:
    """Profile states of the bids by delivery day; ``profile_state.profile_of`` merges those of any days."""

    def build(found: dict[str, DataFrame]) -> DataFrame:
        return ps.profile_states(found["bids"], "delivery_date", columns)

    table = PeriodTable(spark, root, build({"bids": bids.read()}).schema, ["delivery_date"])
    return StoredView(table, {"bids": Source(bids, "delivery_date")}, build)


def active_bid_view(spark: SparkSession, root: str, activations: PeriodTable, bids: PeriodTable) -> StoredView:
    """Every bid whose block covers an activated quarter-hour; a load is taken over by ``refresh``, which computes its days only."""
    month = F.make_date("year", "month", F.lit(1))
    sources = {"activations": Source(activations, "date", month, F.last_day(month)), "bids": Source(bids, "delivery_date")}
    table = PeriodTable(spark, root, ACTIVE_BIDS, ["date"], sort_by=["quarter_no", "price"])
    return StoredView(table, sources, lambda rows: active_bids(rows["activations"], rows["bids"]), arranged=True)


class PriceCurve:
    """Stored price curves of all bids, and prices of any demand read off them."""

    def __init__(self, spark: SparkSession, root: str, bids: PeriodTable):
        levels = PeriodTable(spark, f"{root}/levels", pc.CURVE_LEVELS, ["date"], sort_by=["quarter_no", "band", "price"])
        bands = PeriodTable(spark, f"{root}/bands", pc.CURVE_BANDS, ["date"], sort_by=["quarter_no", "band"])
        self.levels = StoredView(levels, {"bids": Source(bids, "delivery_date")}, lambda rows: pc.curve_levels(rows["bids"]))
        self.bands = StoredView(bands, {"levels": Source(levels, "date")}, lambda rows: pc.curve_bands(rows["levels"]))

    def refresh(self) -> list[Range]:
        """Takes over what was loaded since the last refresh; returns the ranges of days computed anew."""
        changed = self.levels.refresh()
        self.bands.refresh()
        return changed

    def prices(self, demand: DataFrame, on_short: str = "null") -> DataFrame:
        return pc.look_up(demand, self.bands.read(), self.levels.read(), on_short)

    def what_if(self, activations: DataFrame, factors: dict[str, float], absolute_mw: dict[str, float] | None = None, on_short: str = "null") -> DataFrame:
        return pc.what_if_from_curve(activations, self.bands.read(), self.levels.read(), factors, absolute_mw, on_short)


def load_activations(
    spark: SparkSession, path: str, table: PeriodTable, month: tuple[int, int] | None = None, zone: str = cl.ZONE_COLUMN
) -> int:
    """Replaces the months found in the files; ``month`` as (year, month) admits no other one."""
    raw = scan_activation_csv(spark, path)
    checked = cl.validate_activations(cl.clean_activations(cl.select_activation_columns(raw, zone), zone), zone).first()
    if not checked["valid"]:
        raise InvalidActivations(checked["message"])
    rows = cl.to_activations(raw, zone)
    if month and not cl.outside_month(rows, month[1], month[0]).isEmpty():
        raise InvalidActivations(f"rows outside {month[0]}-{month[1]:02d}")
    return table.replace_partitions(rows, "activation_load", [path])


def load_bids(spark: SparkSession, path: str, table: PeriodTable, all_or_nothing: bool = False) -> tuple[DataFrame, DataFrame]:
    """Replaces the days from the first to the last of the valid sheets; returns the summary and the errors.

    Sheets that cannot be loaded are errors; an unreadable one, or one without the required columns, fails an ``all_or_nothing`` import.
    Bids that cannot be read go to ``quarantine`` next to the table, and are counted in the errors.  Neither empties a stored day.
    """
    found = BidImport(spark, scan_sheets(spark, path), read_binary(spark, path, "*", recursive=True).select("path"))
    if all_or_nothing:
        first = found.first_unreadable
        if first:
            raise cl.InvalidSheets(f"{first['source_file']} [{first['sheet']}]: {first['error']}")
        cl.route_invalid_sheets(found.rows, all_or_nothing=True)
    found.refused().write.mode("append").parquet(f"{table.root}/quarantine")
    found.store(table, "bid_load", [path])
    return found.summary(), found.errors()


def update_marginal_prices(
    activations: PeriodTable, bids: PeriodTable, prices: PeriodTable, start: str, end: str | None = None, **options
) -> DataFrame:
    """Prices the days ``start``..``end`` (one day without ``end``) anew and returns them.

    Without activations in the range nothing changes and the result is empty.
    """
    last = end or start
    wanted = date_range(activations.read(), "date", start, last)
    if not wanted.isEmpty():
        found = marginal_prices(wanted, date_range(bids.read(), "delivery_date", start, last), **options)
        prices.replace_range(found, "ANALYSIS")
    return date_range(prices.read(), "date", start, last).filter(F.col("date").isNotNull())
