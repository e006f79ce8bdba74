"""Schemas of the tables that pass between operators."""

from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

EDGE = "src bigint, dst bigint"
NODE = "id bigint"
COUNT = "id bigint, n bigint"
RANK = "id bigint, pr double"
DIST = "source bigint, id bigint, dist int"

# Products and sums of multiplicities pass 2^63 on skewed graphs; this type holds them exactly.
EXACT = DecimalType(38, 0)


def exact(column):
    return F.col(column).cast(EXACT) if isinstance(column, str) else column.cast(EXACT)


def edges_of(df, src, dst):
    """Any two columns of a table as an edge table; rows with a missing end are no edges."""
    return df.select(
        F.col(src).cast("bigint").alias("src"), F.col(dst).cast("bigint").alias("dst")
    ).where(F.col("src").isNotNull() & F.col("dst").isNotNull())
