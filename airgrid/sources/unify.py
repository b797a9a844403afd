"""One network table from the old and the new grid."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.schema import conform


def unify(
    old: DataFrame, new: DataFrame, rename_old: dict[str, str] | None = None, rename_new: dict[str, str] | None = None
) -> DataFrame:
    """Align both grids by column name, tag each row with its origin, and keep all rows, copies included."""
    tagged = [
        grid.withColumnsRenamed(renames or {}).withColumn("VIMB_type", F.lit(origin))
        for grid, renames, origin in [(old, rename_old, "old"), (new, rename_new, "new")]
    ]
    return conform(tagged[0].unionByName(tagged[1], allowMissingColumns=True))
