"""Reverse-geocode response parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pyspark.sql import types as T

from aerocorr.schemas import ADDRESS_FIELDS, GEOCODE_RESPONSE_SCHEMA

_PARSE_SCHEMA = T.StructType(GEOCODE_RESPONSE_SCHEMA.fields + [T.StructField("_corrupt", T.StringType())])


def parse_address(body) -> dict[str, Column]:
    """Columns extracted from a JSON response body.

    A body that is malformed or carries an ``error`` member yields the
    defaults (``osm_id = -1``, every text field ``""``) and ``geocode_ok =
    false``; a member missing from an otherwise good body is ``""``."""
    body = F.col(body) if isinstance(body, str) else body
    # one parse per body; a malformed body (or a non-object) fills _corrupt
    doc = F.from_json(body, _PARSE_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt"})
    ok = F.coalesce(doc.isNotNull() & doc["_corrupt"].isNull() & doc["error"].isNull(),
                    F.lit(False))

    def text(c: Column) -> Column:
        return F.when(ok, F.coalesce(c, F.lit(""))).otherwise(F.lit(""))

    out = {
        "osm_id": F.when(ok, F.coalesce(doc["osm_id"], F.lit(-1).cast("long")))
                   .otherwise(F.lit(-1).cast("long")),
        "osm_type": text(doc["osm_type"]),
        "display_name": text(doc["display_name"]),
    }
    for f in ADDRESS_FIELDS:
        out[f] = text(doc["address"][f])
    out["geocode_ok"] = ok
    return out
