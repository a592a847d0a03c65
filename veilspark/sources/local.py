"""Small literal frames that run entirely in the JVM.

``spark.createDataFrame(list)`` builds an RDD of pickled rows, and every
scan of it starts Python workers. Small metadata and fixture frames
(key names, group members, table lists of one chunk) are built instead
from one JSON literal (``from_json`` + ``inline``), whatever their size: no
Python in any task and a single expression to build. Values appear
in the plan text, so this is for names and metadata only, never for key
material.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _plain(v):
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    raise TypeError(f"no literal for {type(v).__name__} values")


def local_frame(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = [f.name for f in schema.fields]
    payload = json.dumps([dict(zip(names, r, strict=True)) for r in rows], default=_plain)
    parsed = F.from_json(F.lit(payload), T.ArrayType(schema), {"mode": "FAILFAST"})
    return spark.range(1, numPartitions=1).select(F.inline(parsed))
