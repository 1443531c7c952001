"""Player lists from CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_COLUMNS = ["idx", "Player", "Age", "Team", "Pos", "Rank", "FG", "P3"]
_TYPES = {"idx": "INT", "Age": "INT", "Rank": "INT", "FG": "DOUBLE", "P3": "DOUBLE"}


def read_players(spark: SparkSession, path: str, keep_index: bool = False) -> DataFrame:
    """A UTF-8 player list; its first, nameless column is dropped by position.

    Lists without shot rates get NULLs there. ``keep_index`` keeps the first column as
    ``idx``, the list order other operators need.
    """
    layout = {"header": True, "escape": '"', "encoding": "UTF-8"}
    header = spark.read.options(**layout).csv(path).columns
    schema = ", ".join(
        f"`{c}` {_TYPES.get(c, 'STRING')}" for c in ["idx", *header[1:]]
    )
    read = spark.read.options(**layout).schema(schema).csv(path)
    missing = [c for c in _COLUMNS if c not in read.columns]
    full = read.withColumns(
        {c: F.lit(None).cast(_TYPES.get(c, "STRING")) for c in missing}
    ).select(*_COLUMNS)
    return full if keep_index else full.drop("idx")
