"""Canonical tables, spellings accepted on input, and columns every input must have."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE = T.DecimalType(18, 3)
POWER = T.DecimalType(18, 3)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


ACTIVATIONS = _struct(
    date=T.DateType(),
    quarter_no=T.IntegerType(),
    interval_start=T.TimestampNTZType(),
    quarter_hour_start=T.StringType(),
    quarter_hour_end=T.StringType(),
    activated_volume_mw=POWER,
    time_zone=T.StringType(),
    month=T.IntegerType(),
    year=T.IntegerType(),
)

# Raw bid columns keep the spelling of the workbooks; every value is text until it is cleaned.
BIDS_RAW = T.StructType(
    [
        T.StructField(name, T.StringType(), True)
        for name in (
            "DELIVERY_DATE",
            "PRODUCT",
            "ENERGY_PRICE_[EUR/MWh]",
            "ENERGY_PRICE_PAYMENT_DIRECTION",
            "ALLOCATED_CAPACITY_[MW]",
            "OFFERED_CAPACITY_[MW]",
            "TYPE_OF_RESERVES",
            "COUNTRY",
            "NOTE",
            "source_file",
            "sheet",
        )
    ]
)

BIDS = _struct(
    delivery_date=T.DateType(),
    product=T.StringType(),
    energy_price_eur_mwh=PRICE,
    payment_direction=T.StringType(),
    allocated_capacity_mw=POWER,
    offered_capacity_mw=POWER,
    type_of_reserves=T.StringType(),
    country=T.StringType(),
    note=T.StringType(),
    block_start=T.TimestampNTZType(),
    block_end=T.TimestampNTZType(),
    source_file=T.StringType(),
    load_timestamp=T.TimestampType(),
)

MARGINAL_PRICES = _struct(
    date=T.DateType(),
    timestamp=T.TimestampNTZType(),
    quarter_hour_start=T.StringType(),
    quarter_hour_end=T.StringType(),
    activated_volume_mw=POWER,
    available_capacity_mw=POWER,
    cleared_capacity_mw=POWER,
    marginal_price=PRICE,
    product_code=T.StringType(),
    match_tier=T.IntegerType(),
    is_short=T.BooleanType(),
    time_zone=T.StringType(),
)

ACTIVE_BIDS = _struct(
    date=T.DateType(),
    quarter_no=T.IntegerType(),
    activated_volume_mw=POWER,
    block_index=T.IntegerType(),
    product=T.StringType(),
    price=PRICE,
    capacity_mw=POWER,
)

# The columns a bid sheet must have, and those of an activation file.
REQUIRED_BID_COLUMNS = [
    "DELIVERY_DATE",
    "PRODUCT",
    "ENERGY_PRICE_[EUR/MWh]",
    "ENERGY_PRICE_PAYMENT_DIRECTION",
    "ALLOCATED_CAPACITY_[MW]",
]
ACTIVATION_COLUMNS = ["Datum", "von", "bis", "50Hertz (Negativ)"]

# Other spellings of the raw bid columns found in inputs.
BID_COLUMN_ALIASES = {
    "ENERGY_PRICE_EUR_MWh": "ENERGY_PRICE_[EUR/MWh]",
    "ENERGY_PRICE__EUR_MWh_": "ENERGY_PRICE_[EUR/MWh]",
    "PAYMENT_DIRECTION": "ENERGY_PRICE_PAYMENT_DIRECTION",
    "ALLOCATED_CAPACITY_MW": "ALLOCATED_CAPACITY_[MW]",
    "ALLOCATED_CAPACITY__MW_": "ALLOCATED_CAPACITY_[MW]",
    "OFFERED_CAPACITY_MW": "OFFERED_CAPACITY_[MW]",
    "OFFERED_CAPACITY__MW_": "OFFERED_CAPACITY_[MW]",
}


def quoted(name: str) -> Column:
    """A column by its literal name, whatever brackets, dots or blanks it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def sanitized(name: str) -> str:
    """Runs of characters other than letters, digits and ``_`` become one ``_``."""
    return re.sub(r"\W+", "_", name)


def clean_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[sanitized(name) for name in df.columns])


def trim_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def apply_aliases(df: DataFrame, aliases: dict[str, str] = BID_COLUMN_ALIASES) -> DataFrame:
    """Rename known other spellings unless the canonical column is there already."""
    present = set(df.columns)
    renames = {old: new for old, new in aliases.items() if old in present and new not in present}
    return df.withColumnsRenamed(renames)


def conform_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, in its order: absent ones NULL, others dropped, bad values NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (quoted(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )
