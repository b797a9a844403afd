"""Table layouts, and the check every loaded block table passes through."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCKS = T.StructType([
    T.StructField("blockid", T.LongType()),
    T.StructField("blockdate", T.IntegerType()),
    T.StructField("blocknumber", T.IntegerType()),
    T.StructField("blocktime", T.IntegerType()),
    T.StructField("cnlname", T.StringType()),
    T.StructField("factratebase", T.DoubleType()),
    T.StructField("forecastratebase", T.DoubleType()),
    T.StructField("isprime", T.IntegerType()),
    T.StructField("prgname", T.StringType()),
    T.StructField("pro2", T.IntegerType()),
    T.StructField("proid", T.IntegerType()),
    T.StructField("progid", T.IntegerType()),
    T.StructField("is_series", T.IntegerType()),
    T.StructField("is_movie", T.IntegerType()),
    T.StructField("tnsblockfactdur", T.IntegerType()),
    T.StructField("tnsblockfactid", T.LongType()),
    T.StructField("tnsblockfacttime", T.IntegerType()),
    T.StructField("border", T.IntegerType()),
    T.StructField("VIMB_type", T.StringType()),
])

REQUIRED = ["blockdate", "blocktime", "cnlname", "factratebase"]
SEGMENT = ["cnlname", "day_type"]


def conform(df: DataFrame, layout: T.StructType = BLOCKS) -> DataFrame:
    """Bring a block table to the fixed layout: order, types, and nulls for optional columns it lacks."""
    missing = [name for name in REQUIRED if name not in df.columns]
    if missing:
        raise ValueError(f"block table lacks required columns: {', '.join(missing)}")
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in layout
    ])
