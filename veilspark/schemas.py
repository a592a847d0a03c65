"""Frame schemas, layer naming and the fixed vocabulary of the engine.

Every operator in the package takes and returns DataFrames with the
schemas defined here, so the pieces compose without guessing columns.
"""

from __future__ import annotations

from enum import Enum

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the reference for equal results)
# ---------------------------------------------------------------------------
# Tag names and the categories that make a column sensitive.
TAG_CATEGORY = "sensitivity_category"
TAG_TYPE = "sensitivity_type"
SENSITIVE_CATEGORIES = ("pii", "pci")
# The eight sensitivity types, in the order of the sample manifest.
SENSITIVITY_TYPES = ("name", "email", "phone", "dob", "ssn", "pan", "address", "exp-date")
# Key names in the registry: prefix + sensitivity type.
KEK_NAME_PREFIX = "envlp-encryp-key-encryption-key-"
DSK_NAME_PREFIX = "envlp-encryp-data-salt-key-"
# Suffix of the salted hash column written next to each sensitive column.
HASH_SUFFIX = "_hash"
# Rotation policy of key encryption keys: expire after 365 days, rotate 30 days before.
KEK_EXPIRY_DAYS = 365
KEK_ROTATE_BEFORE_DAYS = 30
# Reason text of a manifest row whose column does not exist.
MISMATCH_REASON = (
    "The combination of schema_name, table_name, column_name does not exist in landing catalog"
)
# ---------------------------------------------------------------------------

# Tag this engine adds to hash columns so that masking and planning skip them.
TAG_DERIVED = "derived"
DERIVED_HASH = "hash"


class Layer(str, Enum):
    """Data layers; each maps to a database prefix in the session catalog."""

    CORE = "core"
    LANDING = "landing"
    VAULT = "vault"
    ANONYMIZED = "anonymized"


def database_name(layer: str | Layer, schema: str) -> str:
    """``landing`` + ``pci_pii_dataset`` -> ``landing__pci_pii_dataset``."""
    layer = layer.value if isinstance(layer, Layer) else layer
    return f"{layer}__{schema}"


def split_database(db: str) -> tuple[str, str] | None:
    """Inverse of :func:`database_name`; None for other databases."""
    if "__" not in db:
        return None
    layer, schema = db.split("__", 1)
    return layer, schema


def qualified(layer: str | Layer, schema: str, table: str) -> str:
    return f"`{database_name(layer, schema)}`.`{table}`"


def _s(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType(), True) for n in names]


TABLE_CATALOG = T.StructType(_s("catalog_name", "schema_name", "table_name", "table_type"))

COLUMN_CATALOG = T.StructType(
    _s("catalog_name", "schema_name", "table_name", "column_name", "full_data_type", "is_nullable")
    + [T.StructField("ordinal_position", T.IntegerType(), True)]
)

COLUMN_TAGS = T.StructType(
    _s("catalog_name", "schema_name", "table_name", "column_name", "tag_name", "tag_value")
)

# Tags as they are stored: with the batch of changes that they came with.
TAG_ROWS = T.StructType(COLUMN_TAGS.fields + _s("batch"))

# Batches of tag changes that a version of the tags has taken in.
TAG_FOLDS = T.StructType(_s("version", "batch"))

KEY_REGISTRY = T.StructType(_s("pci_pii_attribute_name", "kek_name", "dsk_name"))

KEK_VERSIONS = T.StructType(
    _s("kek_name", "version")
    + [
        T.StructField("created", T.TimestampType(), True),
        T.StructField("kek", T.BinaryType(), True),
    ]
)

DSK_STORE = T.StructType(
    _s("attribute", "kek_name", "dsk_name", "kek_version")
    + [T.StructField("wrapped_dsk", T.BinaryType(), True)]
)

GROUP_MEMBERS = T.StructType(_s("grp", "member"))

# status: "started" before a table's first write, "done" after data, view and tags.
LOADS = T.StructType(
    _s("source_catalog", "target_catalog", "schema_name", "table_name", "status")
    + [T.StructField("loaded_at", T.TimestampType(), True)]
)

# Files of source tables that a completed load has read; part: the partition's folders.
LOADED_FILES = T.StructType(
    _s("source_catalog", "schema_name", "table_name", "part", "path")
    + [T.StructField("bytes", T.LongType(), True), T.StructField("modified", T.TimestampType(), True)]
)

# Rows that an audited write has put into a table; batch: empty for a whole load.
LOAD_AUDITS = T.StructType(
    _s("target_catalog", "schema_name", "table_name", "batch")
    + [T.StructField("rows", T.LongType(), True), T.StructField("written_at", T.TimestampType(), True)]
)

# Columns that may not hold NULL (parquet tables don't keep that).
NOT_NULL = T.StructType(_s("catalog_name", "schema_name", "table_name", "column_name"))

_ATTRIBUTE = T.StructType(
    [
        T.StructField("attribute_name", T.StringType(), True),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType(), True), True),
    ]
)
_TABLE = T.StructType(
    [
        T.StructField("table_name", T.StringType(), True),
        T.StructField("attributes", T.ArrayType(_ATTRIBUTE, True), True),
    ]
)
_SCHEMA = T.StructType(
    [
        T.StructField("schema_name", T.StringType(), True),
        T.StructField("tables", T.ArrayType(_TABLE, True), True),
    ]
)
# One manifest document: schemas[] -> tables[] -> attributes[] -> tags{}.
MANIFEST = T.StructType([T.StructField("schemas", T.ArrayType(_SCHEMA, True), True)])
MANIFEST_ATTRIBUTE = _ATTRIBUTE
