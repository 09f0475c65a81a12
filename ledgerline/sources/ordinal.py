"""File order as one number per row.

Keep-first rules need the order of rows in their files. A reader may give it as a struct (file,
split start, row in split), whose path no hash aggregate can hold. Before the source is staged,
``with_row_number`` packs it into one DECIMAL: the file's place among the input files sorted by
path, the split's start in bytes, and the row's place in its split. No row moves: the
files' places are a broadcast of one row per input file (Spark's own file index holds that list on
the driver too). A number already is left as it is.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ORDINAL

_NUMBER = T.DecimalType(38, 0)
#: Digits of a file's place, of a byte offset and of a row's place (33 bits) in the number.
_FILE_DIGITS, _SPLIT_DIGITS, _ROW_DIGITS = 10, 17, 10
_ROW_BITS = 33
_FILE, _PLACE = "_ordinal_file", "_ordinal_place"


def _one_slash(path):
    """A path as Spark's listing and its rows' metadata both write it: ``file:/x`` for ``file:///x``."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def with_row_number(df: DataFrame, ordinal: str = ORDINAL) -> DataFrame:
    """``df`` with a (file, split, row) ordinal packed into one number; any other ordinal is kept.

    Rows sort by the number as they sort by the struct. The column keeps its metadata.
    """
    if ordinal not in df.columns:
        return df
    field = df.schema[ordinal]
    if not isinstance(field.dataType, T.StructType) or field.dataType.names != ["file", "split", "row"]:
        return df
    files = sorted(set(df.inputFiles()))
    listed = df.sparkSession.createDataFrame(list(zip(files, range(len(files)))), f"{_FILE} string, {_PLACE} long")
    places = listed.withColumn(_FILE, _one_slash(F.col(_FILE)))
    file, split, row = (F.col(ordinal).getField(part) for part in field.dataType.names)
    place = F.when(F.col(_PLACE).isNotNull(), F.col(_PLACE)).otherwise(
        F.raise_error(F.concat(F.lit("no input file: "), file)).cast("long"))

    def shifted(value, digits: int, zeros: int):
        return (value.cast(T.DecimalType(digits, 0)) * F.lit(Decimal(10 ** zeros))).cast(_NUMBER)

    number = (shifted(place, _FILE_DIGITS, _SPLIT_DIGITS + _ROW_DIGITS) + shifted(split, _SPLIT_DIGITS, _ROW_DIGITS)
              + shifted(row.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)), _ROW_DIGITS, 0))
    joined = df.join(F.broadcast(places), _one_slash(file) == F.col(_FILE), "left")
    return joined.select(*[number.cast(_NUMBER).alias(c, metadata=field.metadata) if c == ordinal else F.col(f"`{c}`")
                           for c in df.columns])
