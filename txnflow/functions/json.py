"""JSON text to typed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnflow.schema import PAYLOAD_SCHEMA

CORRUPT = "_corrupt"


def payload_struct(text: Column, schema: T.StructType = PAYLOAD_SCHEMA, keep_corrupt: bool = False) -> Column:
    """Parse one payload text.

    Unknown keys are ignored, missing ones are null, and a field of the wrong
    type is null while the others survive. With `keep_corrupt` the struct also
    holds the text whenever a type did not fit or the text was no JSON object.
    """
    if not keep_corrupt:
        return F.from_json(text, schema)
    widened = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(text, widened, {"columnNameOfCorruptRecord": CORRUPT})


def metadata_variant(text: Column | str) -> Column:
    """Semi-structured value; text that is no JSON gives null."""
    return F.try_parse_json(F.col(text) if isinstance(text, str) else text)


def metadata_map(text: Column | str) -> Column:
    """`map<string,string>` with values as text; text that is no object gives null."""
    return F.from_json(F.col(text) if isinstance(text, str) else text, "map<string,string>")
