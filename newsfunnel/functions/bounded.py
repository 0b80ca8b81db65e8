"""Size-checked broadcast and bounded collection of dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dimension inputs (term dictionaries, gazetteers, pattern lists) are small by
# nature; these limits are the proof obligation before we broadcast them.
MAX_BROADCAST_ROWS = 200_000
MAX_COLLECT_ROWS = 1_000_000  # terms or patterns: what a driver holds with ease


def checked_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, payload: DataFrame | None = None) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows.  Where its rows hold
    arrays gathered from ``payload``, the rows of that are counted.

    Beyond the bound the plain DataFrame is returned and Spark plans a shuffle
    join instead (AQE may still convert it once it sees runtime sizes).
    """
    n = (df if payload is None else payload).limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def bounded_collect(df: DataFrame, max_rows: int = MAX_COLLECT_ROWS) -> list:
    """Collect a configuration table (e.g. regex patterns) with a hard bound."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"configuration table exceeds {max_rows} rows; refusing to collect")
    return rows
