"""Protect projections: salted hashes next to sensitive columns, and masks.

Both are a single ``select`` of built-in expressions over the source scan:
narrow (no shuffle), inside one whole-stage codegen stage, column-pruned
and filter-pushable by Catalyst. The salts of all hashed types enter as
one scalar subquery (:func:`veilspark.operators.keys.salts_struct`),
projected once and evaluated once per query.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.functions.hashing import hash_column_name, salted_hash
from veilspark.functions.masks import gated, mask_column
from veilspark.operators.keys import salts_struct

SALTS_COLUMN = "__veilspark_salts"


@dataclass(frozen=True)
class ColumnPlan:
    name: str
    data_type: str = "string"
    nullable: bool = True
    position: int = 0
    sensitivity_type: str | None = None  # set for sensitive columns
    hashed: bool = False                 # a salt key is registered for the type


@dataclass
class TablePlan:
    catalog_name: str
    schema_name: str
    table_name: str
    columns: list[ColumnPlan] = field(default_factory=list)

    @property
    def hashed(self) -> dict[str, str]:
        return {c.name: c.sensitivity_type for c in self.columns if c.hashed}

    @property
    def sensitive(self) -> dict[str, str]:
        return {c.name: c.sensitivity_type for c in self.columns if c.sensitivity_type}

    def check_names(self) -> None:
        """A source column already named ``<c>_hash`` next to a hashed ``c`` would clash."""
        names = {c.name.lower() for c in self.columns}
        for c in self.hashed:
            if hash_column_name(c).lower() in names:
                raise ValueError(
                    f"{self.schema_name}.{self.table_name}: column {hash_column_name(c)!r} "
                    f"already exists next to sensitive column {c!r}"
                )


def table_plans(rows: Iterable) -> list[TablePlan]:
    """Group collected load-plan rows (metadata, one per column) into per-table plans."""
    plans: dict[tuple[str, str, str], TablePlan] = {}
    for r in rows:
        key = (r["catalog_name"], r["schema_name"], r["table_name"])
        tp = plans.setdefault(key, TablePlan(*key))
        tp.columns.append(
            ColumnPlan(
                name=r["column_name"],
                data_type=r["full_data_type"],
                nullable=(r["is_nullable"] or "YES").strip().upper() != "NO",
                position=r["ordinal_position"],
                sensitivity_type=r["tag_value"],
                hashed=r["dsk_name"] is not None,
            )
        )
    for tp in plans.values():
        tp.columns.sort(key=lambda c: c.position)
    return sorted(plans.values(), key=lambda p: (p.catalog_name, p.schema_name, p.table_name))


def iter_table_plans(plan_df: DataFrame):
    """Yield one :class:`TablePlan` at a time from a load-plan frame.

    Rows are clustered by table and sorted by position within partitions,
    then streamed with ``toLocalIterator``: the driver holds one partition
    at a time, never the plan of every table. Freeze ``plan_df`` first
    (checkpoint) if the tables it looks at change while iterating.
    """
    keys = ["catalog_name", "schema_name", "table_name"]
    ordered = plan_df.repartition(*keys).sortWithinPartitions(*keys, "ordinal_position")
    current, rows = None, []
    for r in ordered.toLocalIterator():
        key = (r["catalog_name"], r["schema_name"], r["table_name"])
        if key != current and rows:
            yield table_plans(rows)[0]
            rows = []
        current = key
        rows.append(r)
    if rows:
        yield table_plans(rows)[0]


def plan_for_frame(df: DataFrame, sensitive: Mapping[str, str], hashed: bool = True,
                   catalog_name: str = "", schema_name: str = "", table_name: str = "") -> TablePlan:
    """A table plan from a frame's own schema and a ``{column: sensitivity_type}`` map."""
    cols = [
        ColumnPlan(
            name=f.name,
            data_type=f.dataType.simpleString(),
            nullable=f.nullable,
            position=i + 1,
            sensitivity_type=sensitive.get(f.name),
            hashed=hashed and f.name in sensitive,
        )
        for i, f in enumerate(df.schema.fields)
    ]
    tp = TablePlan(catalog_name, schema_name, table_name, cols)
    tp.check_names()
    return tp


def hash_projection(df: DataFrame, plan: TablePlan, unwrapped_keys: DataFrame,
                    num_bits: int = 512) -> DataFrame:
    """Vault layout: every column in plan order, ``<c>_hash`` right after each hashed ``c``.

    The salts of all hashed types come from one scalar subquery, projected
    once as a struct column and read field by field.
    """
    plan.check_names()
    types = sorted(set(plan.hashed.values()))
    src = df
    if types:
        src = df.select("*", salts_struct(unwrapped_keys, types).alias(SALTS_COLUMN))
    out: list[Column] = []
    for c in plan.columns:
        out.append(_not_null_checked(c, plan))
        if c.hashed:
            salt = F.col(SALTS_COLUMN).getField(c.sensitivity_type)
            out.append(salted_hash(F.col(f"`{c.name}`"), salt, num_bits).alias(hash_column_name(c.name)))
    return src.select(*out)


def add_hashes(df: DataFrame, keep: Iterable[str], hashes: Mapping[str, tuple[str, str]],
               unwrapped_keys: DataFrame, num_bits: int = 512) -> DataFrame:
    """``keep`` columns plus ``{out_name: (column, sensitivity_type)}`` salted hashes.

    Like :func:`hash_projection`, all salts come from one scalar subquery
    projected once.
    """
    types = sorted({t for _, t in hashes.values()})
    staged = df.select("*", salts_struct(unwrapped_keys, types).alias(SALTS_COLUMN))
    salts = F.col(SALTS_COLUMN)
    return staged.select(
        *[F.col(f"`{c}`") for c in keep],
        *[salted_hash(F.col(f"`{c}`"), salts.getField(t), num_bits).alias(out) for out, (c, t) in hashes.items()],
    )


def _not_null_checked(c: ColumnPlan, plan: TablePlan) -> Column:
    """The column, raising inside the same scan if a NOT NULL column holds NULL.

    Parquet does not enforce NOT NULL; checking in the projection costs no
    extra pass over the data.
    """
    col = F.col(f"`{c.name}`")
    if c.nullable:
        return col
    msg = f"NULL in NOT NULL column {plan.schema_name}.{plan.table_name}.{c.name}"
    return F.when(col.isNull(), F.raise_error(F.lit(msg))).otherwise(col).alias(c.name)


def mask_projection(df: DataFrame, sensitive: Mapping[str, str], member: Column | None = None) -> DataFrame:
    """Same columns, sensitive ones masked by type (STRING).

    ``member=None``: always masked (anonymized layer, whoever runs it).
    Otherwise masked unless ``member`` is true (role-gated view).
    Hash columns are not in ``sensitive`` and pass through, so joins on
    them still work.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        stype = sensitive.get(f.name)
        if stype is None:
            out.append(c)
        elif member is None:
            out.append(mask_column(c, stype).alias(f.name))
        else:
            out.append(gated(c, stype, member).alias(f.name))
    return df.select(*out)
