"""Views that hide columns or rows from a role, and the row-count check."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from innlake.constants import PRIVILEGED_ROLE
from innlake.functions.masking import mask_email, mask_phone


def masked_dim_guest(dim_guest: DataFrame, role: str, strict: bool = False) -> DataFrame:
    """Guest dimension as ``role`` may see it."""
    return dim_guest.withColumns({
        "email": mask_email(F.col("email"), role, strict),
        "phone": mask_phone(F.col("phone"), role),
    })


def row_access_view(df: DataFrame, grants: DataFrame, role: str) -> DataFrame:
    """Rows of the hotels granted to ``role``; the privileged role sees all.

    ``grants`` has columns (role, hotel_id) and ``df`` a hotel_id.
    """
    if role == PRIVILEGED_ROLE:
        return df
    mine = grants.filter(F.col("role") == role).select("hotel_id")
    return df.join(mine, "hotel_id", "left_semi")


def row_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """One labelled count per table."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(label).alias("layer"), "cnt")
        for label, frame in layers.items()
    ]
    return reduce(DataFrame.unionByName, counts)
