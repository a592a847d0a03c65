"""Classification manifests: multi-line JSON documents.

One document per file; a file may hold one schema or many. The schema is
given explicitly, so tags are a MAP (absent tags are absent, not NULL
struct fields). ``read_manifest`` fails on a malformed file instead of turning
it into a NULL row; ``split_manifests`` sets broken documents aside with the
reason, and the others go on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.schemas import MANIFEST

BROKEN = "_broken"
NO_JSON, WRONG_LAYOUT = "not JSON", "not the layout of a manifest"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """All manifest documents under ``path`` (a file, directory or glob)."""
    return (
        spark.read.schema(MANIFEST)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(path)
    )


def read_documents(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(path, document) of the files under ``path``: one a file, or one a line."""
    return spark.read.text(path, wholetext=not lines).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("document"))


def split_manifests(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(manifests, rejects) of (path, document) rows.

    A document is an object or an array of objects. Its objects are taken apart as VARIANT and must fit the
    manifest's types on every level; nothing in them is turned into NULL. Manifests are rows of ``schemas``, as
    ``read_manifest`` gives them; rejects are (path, reason, document). Blank documents are no JSON.
    """
    checked = T.StructType([*MANIFEST.fields, T.StructField(BROKEN, T.StringType())])
    parsed = documents.withColumn("v", F.try_parse_json("document"))
    objects = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array("v"))
    fitted = parsed.withColumn("found", F.when(F.col("v").isNotNull(), F.transform(
        objects, lambda x: F.from_json(F.to_json(x), checked, {"columnNameOfCorruptRecord": BROKEN}))))
    # an object with another root than ``schemas`` would fit with NULL
    good = F.coalesce(F.forall("found", lambda x: x[BROKEN].isNull() & x["schemas"].isNotNull()), F.lit(False))
    reason = F.when(F.col("v").isNull(), NO_JSON).otherwise(WRONG_LAYOUT)
    return (fitted.where(good).select(F.inline(F.transform("found", lambda x: F.struct(x["schemas"].alias("schemas"))))),
            fitted.where(~good).select("path", reason.alias("reason"), "document"))
