"""Names for how two closed time intervals lie to each other (Allen's relations)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def allen_relation(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """The relation of interval ``a`` to interval ``b``; one of the thirteen names."""
    return (
        F.when(a_end < b_start, "before")
        .when(b_end < a_start, "after")
        .when((a_start == b_start) & (a_end == b_end), "equals")
        .when(a_start == b_start, F.when(a_end < b_end, "starts").otherwise("started_by"))
        .when(a_end == b_end, F.when(a_start > b_start, "finishes").otherwise("finished_by"))
        .when(a_end == b_start, "meets")
        .when(b_end == a_start, "met_by")
        .when((a_start > b_start) & (a_end < b_end), "during")
        .when((a_start < b_start) & (a_end > b_end), "contains")
        .when(a_start < b_start, "overlaps")
        .otherwise("overlapped_by")
    )
