"""JSON text to typed columns, keeping track of text that does not parse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"
# The default writes milliseconds and would cut times short.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def encode(row: Column) -> Column:
    """A struct as JSON text, times to the microsecond."""
    return F.to_json(row, TIMES)


def parse(text: Column, schema: StructType) -> Column:
    """Struct of the declared fields plus _corrupt_record, which holds the text where it is
    not JSON of that shape. Plain from_json gives a struct of NULLs there, which looks like
    an empty message."""
    widened = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return F.from_json(text, widened, {"columnNameOfCorruptRecord": CORRUPT})


def malformed(text: Column, parsed: Column) -> Column:
    """True for text that is there but did not parse."""
    return text.isNotNull() & (parsed.isNull() | parsed.getField(CORRUPT).isNotNull())


def path_text(text: Column, path: str) -> Column:
    """The value at a JSON path as text, NULL if the path or the JSON does not hold."""
    return F.try_variant_get(F.try_parse_json(text), path, "string")
