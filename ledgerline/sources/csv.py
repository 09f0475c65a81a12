"""Order-line CSV reader.

Reads the header row, keeps every field as text, then types the known
columns with ``try_*`` parsers: a value that does not parse becomes NULL and
its raw text is kept in ``_parse_errors`` for the contract check, so one bad
field never aborts a 100 TB read and is never silently dropped.

* encoding latin-1, doubled quotes inside quoted fields (``""``) as in the
  files the reference reads;
* the text spellings of a missing value (``NA``, ``nan``, ``NULL``, empty ...)
  become NULL, as pandas' reader does;
* Postal Code stays text (leading zeros survive);
* dates accept a list of patterns (the source file's format is a parameter);
* file order for keep-first rules is carried by ``_line_ordinal``:
  (file path, split start, row position inside the split), taken at the scan;
* line breaks inside quoted fields are part of the field, in files of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.text import null_tokens_to_null
from .records import file_lines, has_open_lines, records

# Month first throughout: a day-first column (another convention) is asked for with ``date_formats``, and a
# column that mixes the two has its other dates reported as dtype failures, never read as a wrong day.
DEFAULT_DATE_FORMATS = (
    "M/d/yyyy", "yyyy-M-d", "M-d-yyyy", "M/d/yy", "yyyy-M-d H:mm:ss", "yyyy-M-d'T'H:mm:ss", "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm", "M-d-yyyy H:mm:ss", "yyyy/M/d",
)

_TYPED = {
    S.ORDER_DATE: "date",
    S.SHIP_DATE: "date",
    S.SALES: S.SOURCE_MONEY,
    S.QUANTITY: "int",
    S.DISCOUNT: S.SOURCE_RATE,
    S.PROFIT: S.SOURCE_MONEY,
}

PARSE_ERRORS = "_parse_errors"
CORRUPT = "_corrupt_record"


def _parse_date(raw: Column, formats: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.try_to_date(F.trim(raw), f) for f in formats])


def _parse(raw: Column, target, formats: tuple[str, ...]) -> Column:
    if target == "date":
        return _parse_date(raw, formats)
    return F.trim(raw).try_cast(target)


def read_orders_csv(spark: SparkSession, path: str | list[str], *, encoding: str = "ISO-8859-1",
                    date_formats: tuple[str, ...] = DEFAULT_DATE_FORMATS,
                    null_tokens: list[str] | None = None, multiline: bool | None = None) -> DataFrame:
    """Typed order lines from CSV file(s), in source column names, plus ``_line_ordinal``.

    Lines whose field count does not match the header keep their raw text in
    ``_corrupt_record`` (PERMISSIVE mode) and are reported by the contract check.
    The CSV parser's column pruning is turned off for this read: with it on,
    whether a line counts as malformed depends on which columns a query
    selects. The pipeline reads every column once (extract) anyway.

    Line breaks inside quoted fields are read as pandas reads them, and large files still in
    splits (``records.py``). By default one pass over the lines finds out whether there are any;
    ``multiline`` says it beforehand (False: none, each line is a record).
    """
    header = csv_header(spark, path, encoding)
    text_schema = T.StructType([T.StructField(c, T.StringType()) for c in header]
                               + [T.StructField(CORRUPT, T.StringType())])
    if multiline is None:
        multiline = has_open_lines(file_lines(spark, path))
    options = {"encoding": encoding, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnPruning": False,
               "columnNameOfCorruptRecord": CORRUPT}
    if multiline:
        raw = _parsed_records(records(spark, path), header, text_schema, encoding, options)
    else:
        raw = (spark.read.schema(text_schema).options(**options)
               .option("header", True).option("enforceSchema", False)   # every file's header must match the first file's
               .csv(path))
        raw = raw.select("*", F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(S.ORDINAL))
    ordinal = F.col(S.ORDINAL)
    # Contract columns absent from the header travel as schema metadata (no scan needed to read them).
    header_meta = {"missing_columns": missing_columns(header),
                   "absent_columns": [c for c in S.SOURCE_COLUMNS if c not in header]}
    text = raw.select(*[null_tokens_to_null(F.col(f"`{c}`"), null_tokens).alias(c) for c in header],
                      F.col(CORRUPT), ordinal.alias(S.ORDINAL, metadata=header_meta))

    def rawcol(c: str) -> Column:
        return F.col(f"`{c}`") if c in header else F.lit(None).cast("string")

    typed: dict[str, Column] = {}
    errors: list[Column] = []
    for c in S.SOURCE_COLUMNS:
        if c in _TYPED:
            value = _parse(rawcol(c), _TYPED[c], date_formats)
            typed[c] = value
            errors += [F.lit(c), F.when(rawcol(c).isNotNull() & value.isNull(), rawcol(c))]
        else:
            typed[c] = rawcol(c)
    extras = [c for c in header if c not in S.SOURCE_COLUMNS]
    return text.select(
        *[v.alias(k) for k, v in typed.items()],
        *[F.col(f"`{c}`") for c in extras],
        F.col(S.ORDINAL),
        F.map_filter(F.create_map(*errors), lambda k, v: v.isNotNull()).alias(PARSE_ERRORS),
        F.col(CORRUPT),
    )


def _parsed_records(rows: DataFrame, header: list[str], schema: T.StructType, encoding: str, options: dict) -> DataFrame:
    """Fields of whole records, with the ordinal; a file whose first record is not ``header`` fails the read."""
    text = F.regexp_replace(F.decode("text", encoding), r"\r$", "")
    rows = rows.select("file", "split", "row", text.alias("text"))
    names = ", ".join(f"`{i}` string" for i in range(len(header)))
    found = F.array(*[F.col(f"names.`{i}`") for i in range(len(header))])
    first = (F.col("split") == 0) & (F.col("row") == 0)
    wanted = F.array(*[F.lit(c) for c in header])
    rows = rows.withColumn("names", F.when(first, F.from_csv("text", names, {"quote": '"', "escape": '"'})))
    rows = rows.where(F.when(first, F.when(found == wanted, False).otherwise(
        F.raise_error(F.concat(F.lit("CSV header does not match the first file's: "), "file")).cast("boolean"))).otherwise(True))
    ddl = ", ".join(f"`{f.name}` string" for f in schema.fields)
    parsed = F.from_csv("text", ddl, {k: str(v) for k, v in options.items()})
    return rows.select(parsed.alias("r"), F.struct("file", "split", "row").alias(S.ORDINAL)).select("r.*", S.ORDINAL)


def csv_header(spark: SparkSession, path: str | list[str], encoding: str = "ISO-8859-1") -> list[str]:
    """Column names of the file header (reads the first line only)."""
    return list(spark.read.option("header", True).option("encoding", encoding).csv(path).columns)


def missing_columns(header: list[str]) -> list[str]:
    """Contract columns absent from a header (they read as all-NULL and fail ``not_nullable``)."""
    present = set(header)
    return [c for c, _, _ in S.CONTRACT if c not in present]
