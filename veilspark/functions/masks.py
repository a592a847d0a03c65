"""Read masks for sensitive columns, as native Column expressions.

Every mask is a pure built-in expression (no Python in the row path), so
Catalyst inlines it into the scan's whole-stage codegen. NULL in gives
NULL out for all masks. Malformed values never raise. The rules are fixed
values of the data model, and some show a short value whole: an address of
ten characters or fewer, a name of one token, an email that starts with ``@``:

* ``pan``      ``X`` * (len - 4) + last 4; four chars or fewer -> all ``X``
* ``exp-date`` ``'20'`` + last 2
* ``name``     first token, space, first letter of second token, ``.``;
               one token -> ``'<tok> .'``
* ``address``  first 10 chars + ``...``
* ``email``    first char + ``*****`` + the part from ``@``; no ``@`` ->
               first char + ``*****``
* ``phone``    ``*`` * (len - 4) + last 4; four chars or fewer -> all ``*``
* ``dob``      year as text; not a date -> NULL
* ``ssn``      ``***-**-`` + last 4; four chars or fewer -> ``***-**-****``

The same rules exist as SQL bodies (``MASK_SQL``) for SQL users; tests
check that both forms agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(v: ColumnOrName) -> Column:
    return F.col(v) if isinstance(v, str) else v


def mask_pan(v: ColumnOrName) -> Column:
    v = _c(v)
    n = F.length(v)
    return F.when(n <= 4, F.repeat(F.lit("X"), n)).otherwise(
        F.concat(F.repeat(F.lit("X"), n - 4), F.right(v, F.lit(4)))
    )


def mask_exp_date(v: ColumnOrName) -> Column:
    return F.concat(F.lit("20"), F.right(_c(v), F.lit(2)))


def mask_name(v: ColumnOrName) -> Column:
    v = _c(v)
    parts = F.split(v, " ")
    second = F.coalesce(F.get(parts, 1), F.lit(""))
    return F.when(
        v.isNotNull(),
        F.concat(F.get(parts, 0), F.lit(" "), F.left(second, F.lit(1)), F.lit(".")),
    )


def mask_address(v: ColumnOrName) -> Column:
    return F.concat(F.left(_c(v), F.lit(10)), F.lit("..."))


def mask_email(v: ColumnOrName) -> Column:
    v = _c(v)
    at = F.instr(v, "@")
    head = F.concat(F.left(v, F.lit(1)), F.lit("*****"))
    return F.when(at > 0, F.concat(head, v.substr(at, F.length(v)))).otherwise(head)


def mask_phone(v: ColumnOrName) -> Column:
    v = _c(v)
    n = F.length(v)
    return F.when(n <= 4, F.repeat(F.lit("*"), n)).otherwise(
        F.concat(F.repeat(F.lit("*"), n - 4), F.right(v, F.lit(4)))
    )


def mask_dob(v: ColumnOrName) -> Column:
    return F.year(_c(v).cast("string").try_cast("date")).cast("string")


def mask_ssn(v: ColumnOrName) -> Column:
    v = _c(v)
    return F.when(F.length(v) <= 4, F.lit("***-**-****")).otherwise(
        F.concat(F.lit("***-**-"), F.right(v, F.lit(4)))
    )


# sensitivity_type -> mask. Keys are the fixed sensitivity types.
MASKS: dict[str, Callable[[ColumnOrName], Column]] = {
    "name": mask_name,
    "email": mask_email,
    "phone": mask_phone,
    "dob": mask_dob,
    "ssn": mask_ssn,
    "pan": mask_pan,
    "address": mask_address,
    "exp-date": mask_exp_date,
}


def mask_for(sensitivity_type: str) -> Callable[[ColumnOrName], Column]:
    try:
        return MASKS[sensitivity_type]
    except KeyError:
        raise KeyError(f"no mask for sensitivity type {sensitivity_type!r}") from None


def mask_column(v: ColumnOrName, sensitivity_type: str) -> Column:
    """Mask ``v`` by its sensitivity type; result is STRING whatever the input type."""
    return mask_for(sensitivity_type)(_c(v).cast("string"))


# ---------------------------------------------------------------------------
# Role gate
# ---------------------------------------------------------------------------

def is_member(group_members: DataFrame, group: str, principal: Column | None = None) -> Column:
    """Uncorrelated EXISTS over ``group_members(grp, member)``: one evaluation per query."""
    principal = F.session_user() if principal is None else principal
    return group_members.where((F.col("grp") == F.lit(group)) & (F.col("member") == principal)).exists()


def gated(v: ColumnOrName, sensitivity_type: str, member: Column) -> Column:
    """Clear value for members of the privileged group, masked value otherwise."""
    v = _c(v)
    return F.when(member, v.cast("string")).otherwise(mask_column(v, sensitivity_type))


# ---------------------------------------------------------------------------
# SQL functions for SQL users (CREATE FUNCTION ... RETURN), same rules.
# ---------------------------------------------------------------------------
MASK_SQL: dict[str, str] = {
    "pan": "CASE WHEN length(v) <= 4 THEN repeat('X', length(v)) "
           "ELSE concat(repeat('X', length(v) - 4), right(v, 4)) END",
    "exp-date": "concat('20', right(v, 2))",
    "name": "CASE WHEN v IS NOT NULL THEN concat(get(split(v, ' '), 0), ' ', "
            "left(coalesce(get(split(v, ' '), 1), ''), 1), '.') END",
    "address": "concat(left(v, 10), '...')",
    "email": "CASE WHEN instr(v, '@') > 0 THEN concat(left(v, 1), '*****', "
             "substr(v, instr(v, '@'), length(v))) ELSE concat(left(v, 1), '*****') END",
    "phone": "CASE WHEN length(v) <= 4 THEN repeat('*', length(v)) "
             "ELSE concat(repeat('*', length(v) - 4), right(v, 4)) END",
    "dob": "CAST(year(try_cast(v AS DATE)) AS STRING)",
    "ssn": "CASE WHEN length(v) <= 4 THEN '***-**-****' ELSE concat('***-**-', right(v, 4)) END",
}


def sql_function_name(sensitivity_type: str) -> str:
    return f"{sensitivity_type.replace('-', '_')}_mask"


def register_sql_functions(spark: SparkSession, database: str, group: str,
                           group_members_table: str) -> list[str]:
    """Create or replace ``<type>_mask(v STRING)`` SQL functions in ``database``.

    Each function returns the clear value when ``session_user()`` is in
    ``group`` (looked up in ``group_members_table``), else the mask. They are
    always replaced, so a changed group takes effect at once.
    """
    quoted = "'" + group.replace("\\", "\\\\").replace("'", "\\'") + "'"
    created = []
    for stype, body in MASK_SQL.items():
        name = f"`{database}`.{sql_function_name(stype)}"
        spark.sql(
            f"CREATE OR REPLACE FUNCTION {name}(v STRING) RETURNS STRING RETURN "
            f"CASE WHEN EXISTS (SELECT 1 FROM {group_members_table} g "
            f"WHERE g.grp = {quoted} AND g.member = session_user()) THEN v ELSE {body} END"
        )
        created.append(name)
    return created
