"""Which quarter-hour a product code means, and how good the match is.

A code can mean one quarter-hour only, so matching needs no product list and no join:

* tier 1: exactly ``NEG_001``;
* tier 2: ``NEG-001``, ``NEG001``, ``neg_001`` or ``NEG_1``;
* tier 3: any other code that begins with ``NEG`` or ``neg`` and ends in the three digits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclear.functions.timecode import QUARTERS_PER_DAY

UNMATCHED = 9


def with_match(df: DataFrame, product: str = "product") -> DataFrame:
    """Adds ``quarter_no`` and ``tier`` of the product; 0 and ``UNMATCHED`` if it means no quarter-hour.

    Both are never NULL, so that joins on them add no NULL filter, which would be evaluated on every bid
    once more.  Steps are separate columns, so each is computed once per row.
    """
    code = F.col(product)
    length = F.length(code)
    negative = code.startswith("NEG") | code.startswith("neg")
    # Texts are checked before they are cast, because a cast that fails costs an exception per row.
    digits = (
        F.when(negative & code.rlike("[0-9]{3}$"), F.substring(code, -3, 3))
        .when(code.rlike("^NEG_[1-9][0-9]?$"), F.substring(code, 5, 2))
        .otherwise(F.lit("0"))
    )
    return (
        df.withColumn("_number", digits.try_cast("int"))
        .withColumn(
            "quarter_no",
            F.coalesce(F.when(F.col("_number").between(1, QUARTERS_PER_DAY), F.col("_number")), F.lit(0)),
        )
        .withColumn(
            "tier",
            F.when(F.col("quarter_no") == 0, UNMATCHED)
            .when((length == 7) & code.startswith("NEG_"), 1)
            .when((length == 7) & (code.startswith("NEG-") | code.startswith("neg_")), 2)
            .when((length < 7) & code.startswith("NEG"), 2)
            .otherwise(3),
        )
        .drop("_number")
    )
