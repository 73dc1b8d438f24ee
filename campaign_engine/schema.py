"""Campaign table schema, required-column checks and ingest normalisation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The campaign table's column names, including the source's
# spelling of the conversions column.
CONVERSIONS = "converions"
ID_COLUMNS = ["campaign_id", "category_id", "market_id", "customer_id", "publisher"]
CATEGORICAL_FEATURES = ["category_id", "market_id", "customer_id", "publisher"]
TEXT_FEATURES = ["industry"]

CAMPAIGN_SCHEMA = T.StructType([
    T.StructField("campaign_id", T.StringType(), True),
    T.StructField("category_id", T.StringType(), True),
    T.StructField("market_id", T.StringType(), True),
    T.StructField("customer_id", T.StringType(), True),
    T.StructField("publisher", T.StringType(), True),
    T.StructField("industry", T.StringType(), True),
    T.StructField("cost", T.DoubleType(), True),
    T.StructField("clicks", T.LongType(), True),
    T.StructField(CONVERSIONS, T.LongType(), True),
])


def require_columns(df: DataFrame, columns: Iterable[str], purpose: str = "") -> None:
    """Raise ValueError naming every missing column (no job is run)."""
    present = set(df.columns)
    missing = [c for c in columns if c not in present]
    if missing:
        why = f" required for {purpose}" if purpose else ""
        raise ValueError(f"Data must contain column(s) {missing}{why}.")


def normalise(df: DataFrame) -> DataFrame:
    """Ids to STRING (lookups compare strings, never int vs str) and NaN to
    NULL in floating columns (aggregates then skip them like pandas does)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in ID_COLUMNS or f.name in TEXT_FEATURES:
            c = c.cast("string")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)
