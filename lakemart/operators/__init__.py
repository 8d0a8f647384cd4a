"""Generic DataFrame operators used by the layer builders."""

from lakemart.operators.counts import row_counts
from lakemart.operators.dedup import one_row_per_key
from lakemart.operators.measures import (
    Measure,
    aggregate,
    join_then_aggregate,
    payment_measure,
    ride_measure,
    via_dimension,
)
from lakemart.operators.quarantine import read_kept, read_quarantined, repaired, union_wide, write_judged
from lakemart.operators.standardize import rejected, required_present, standardize, typed_columns

__all__ = [
    "Measure",
    "aggregate",
    "join_then_aggregate",
    "one_row_per_key",
    "payment_measure",
    "read_kept",
    "read_quarantined",
    "rejected",
    "repaired",
    "required_present",
    "ride_measure",
    "row_counts",
    "standardize",
    "typed_columns",
    "union_wide",
    "via_dimension",
    "write_judged",
]
