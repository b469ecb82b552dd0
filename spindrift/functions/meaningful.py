"""Whether a column's value says anything."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Strings that say nothing. Fixed values.
EMPTY = ["", "None", "unknown"]


def is_meaningful(value: Column, kind: T.DataType, false_counts: bool = False) -> Column:
    """False for null, '', 'None', 'unknown', zero and false, and for arrays without a meaningful element; maps and structs count if present.

    With false_counts a false or zero value on the top level counts.
    """
    if isinstance(kind, T.StringType):
        said = ~value.isin(EMPTY)
    elif isinstance(kind, T.BooleanType):
        said = F.lit(True) if false_counts else value
    elif isinstance(kind, T.NumericType):
        said = F.lit(True) if false_counts else value != 0
    elif isinstance(kind, T.ArrayType):
        said = F.exists(value, lambda x: is_meaningful(x, kind.elementType))
    else:
        said = F.lit(True)
    return value.isNotNull() & F.coalesce(said, F.lit(False))


def completeness(schema: T.StructType, columns: list[str], false_counts: bool = False) -> Column:
    """How many of the columns are meaningful."""
    out = F.lit(0)
    for c in columns:
        out = out + is_meaningful(F.col(c), schema[c].dataType, false_counts).cast("int")
    return out
