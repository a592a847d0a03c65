"""DuckDB SQL giving the expected result of each registered workload.

Written from the fixture rules directly (what the answer must be), not by
replaying the Spark operators. Views ``customer``, ``orders`` (and the
other driver tables) are registered over the same parquet files.
Dialect notes: DuckDB ``concat`` skips NULL, so ``||`` is used; DuckDB has
SHA-256 but no SHA-512, so the workloads hash with 256 bits here; lists
are 1-based.
"""

from __future__ import annotations

from veilspark.schemas import DSK_NAME_PREFIX, KEK_NAME_PREFIX, MISMATCH_REASON, SENSITIVITY_TYPES
from veilspark.sources.fixtures import PII_COLUMNS, SENSITIVE_COLUMNS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _pii_sql(i: str, src: str) -> str:
    """Fixture customers for id expression ``i`` over ``src`` (FIXTURES.md §3)."""
    v = "varchar"
    dob = f"date '1946-01-01' + cast(({i}*37)%22000 as integer)"
    return f"""select {i} as id,
 case when {i}%97=0 then 'Mononym'
      when {i}%31=0 then 'Dr. Customer ' || lpad(cast({i} as {v}),9,'0')
      else 'Customer ' || lpad(cast({i} as {v}),9,'0') end as full_name,
 case when {i}%89=0 then 'nodomain' else 'user' || cast({i} as {v}) || '@example.com' end as email,
 case when {i}%83=0 then '911'
      else '555-' || lpad(cast(({i}*7919)%1000 as {v}),3,'0') || '-' || lpad(cast(({i}*104729)%10000 as {v}),4,'0') end as phone_number,
 case when {i}%79=0 then 'unknown' else cast({dob} as {v}) end as dob,
 {_ssn_sql(i)} as ssn,
 case when {i}%71=0 then '123' else '4' || lpad(cast(({i}*1000003)%1000000000 as {v}),15,'0') end as pan,
 cast({i} as {v}) || ' Street ' || cast({i}%100 as {v}) as address,
 lpad(cast({i}%12+1 as {v}),2,'0') || '/' || lpad(cast({i}%8+24 as {v}),2,'0') as exp_date,
 'Company ' || cast({i}%25 as {v}) || ' Bank' as bank_name
from {src}"""


def _ssn_sql(i: str) -> str:
    v = "varchar"
    return (f"case when {i}%50=1 then null when {i}%73=0 then '12' else "
            f"lpad(cast(({i}*31)%900 as {v}),3,'0') || '-' || lpad(cast({i}%100 as {v}),2,'0') || '-' || "
            f"lpad(cast(({i}*17)%10000 as {v}),4,'0') end")


PII = _pii_sql("c_custkey", "customer")
TYPE_OF = {c: t for c, _, t in SENSITIVE_COLUMNS}

# Expected masks, one SQL expression per sensitivity type, over value {v}.
MASK = {
    "pan": "case when length({v})<=4 then repeat('X', length({v})) else repeat('X', length({v})-4) || right({v},4) end",
    "exp-date": "'20' || right({v},2)",
    "name": "string_split({v},' ')[1] || ' ' || left(coalesce(string_split({v},' ')[2], ''),1) || '.'",
    "address": "left({v},10) || '...'",
    "email": "case when instr({v},'@')>0 then left({v},1) || '*****' || substring({v}, instr({v},'@')) "
             "else left({v},1) || '*****' end",
    "phone": "case when length({v})<=4 then repeat('*', length({v})) else repeat('*', length({v})-4) || right({v},4) end",
    "dob": "cast(year(try_cast({v} as date)) as varchar)",
    "ssn": "case when length({v})<=4 then '***-**-****' else '***-**-' || right({v},4) end",
}


def _mask(col: str) -> str:
    return MASK[TYPE_OF[col]].format(v=col)


def _hash(col: str) -> str:
    return f"sha256('SALT-{TYPE_OF[col]}' || {col})"


def _vault_select(masked: bool) -> str:
    out = []
    for name, _, _ in PII_COLUMNS:
        if name in TYPE_OF:
            out.append(f"{_mask(name) if masked else name} as {name}")
            out.append(f"{_hash(name)} as {name}_hash")
        else:
            out.append(name)
    return ",\n ".join(out)


VAULT = f"with p as ({PII}) select {_vault_select(False)} from p"
ANONYMIZED = f"with p as ({PII}) select {_vault_select(True)} from p"

# ---------------------------------------------------------------- tenant estate
_SENS_LIST = "[" + ", ".join(
    f"{{'c': {_q(c)}, 'cat': {_q(cat)}, 'typ': {_q(t)}}}" for c, cat, t in SENSITIVE_COLUMNS) + "]"
_COLS_LIST = "[" + ", ".join(
    f"{{'c': {_q(n)}, 'dt': {_q(dt)}, 'nl': {_q(nl)}, 'pos': {i + 1}, "
    f"'typ': {(_q(TYPE_OF[n]) if n in TYPE_OF else 'null')}}}"
    for i, (n, dt, nl) in enumerate(PII_COLUMNS)) + "]"
_TYPES_LIST = "[" + ", ".join(_q(t) for t in SENSITIVITY_TYPES) + "]"

TENANTS = ("t as (select c_custkey as k, 'pci_pii_' || lower(c_mktsegment) as schema_name, "
           "'customer_records_' || cast(c_custkey as varchar) as table_name from customer), "
           f"a as (select k, schema_name, table_name, unnest({_SENS_LIST}) as s from t)")

MANIFEST_CLEAN = ("m as (select k, schema_name, table_name, s.c as column_name, 'sensitivity_category' as tag_name, "
                  "s.cat as tag_value from a union all select k, schema_name, table_name, s.c, 'sensitivity_type', s.typ from a)")

BANK_TAGS = ("select 'landing' as catalog_name, schema_name, table_name, 'bank_name' as column_name, "
             "'sensitivity_category' as tag_name, 'public' as tag_value from t where k%3<>0 and k%9=1 "
             "union all select 'landing', schema_name, table_name, 'bank_name', 'sensitivity_type', 'org' "
             "from t where k%3<>0 and k%9=1")

EXISTING_TAGS = ("have as (select 'landing' as catalog_name, schema_name, table_name, s.c as column_name, "
                 "'sensitivity_category' as tag_name, case when s.c='dob' and k%7=0 then 'pci' else s.cat end as tag_value, k "
                 "from a where k%3<>0 union all select 'landing', schema_name, table_name, s.c, 'sensitivity_type', s.typ, k "
                 "from a where k%3<>0 union all select 'landing', schema_name, table_name, 'bank_name', 'sensitivity_category', "
                 "'public', k from t where k%3<>0 and k%9=1 union all select 'landing', schema_name, table_name, "
                 "'bank_name', 'sensitivity_type', 'org', k from t where k%3<>0 and k%9=1)")

# Tenant keys: KEK 'tenant-<k>-kek-<type>', versions v1..v(1+k%3), none for k%25=0;
# DSK 'SALT-t<k>-<type>' for k%5<>0, wrapped under the latest version (even k) or v1 (odd k).
TENANT_KEYS = (f"ka as (select k, unnest({_TYPES_LIST}) as attribute from t), "
               "kk as (select k, attribute, 'tenant-' || cast(k as varchar) || '-kek-' || attribute as kek_name, "
               "'tenant-' || cast(k as varchar) || '-dsk-' || attribute as dsk_name, "
               "'v' || cast(k%3+1 as varchar) as latest_version, "
               "cast(date '2024-01-01' + cast(k%300 + (k%3)*200 as integer) as timestamp) as latest_created from ka)")


def _estate(body: str, *ctes: str) -> str:
    return "with " + ", ".join((TENANTS,) + ctes) + " " + body


_VAULT_LAYOUT_TAGGED = []
_pos = 0
for _n, _dt, _nl in PII_COLUMNS:
    _pos += 1
    _VAULT_LAYOUT_TAGGED.append((_n, _dt, _nl, _pos, False))
    if _n in TYPE_OF:
        _pos += 1
        _VAULT_LAYOUT_TAGGED.append((_n + "_hash", "string", "YES", _pos, True))


def _layout_list(rows) -> str:
    return "[" + ", ".join(
        f"{{'c': {_q(n)}, 'dt': {_q(dt)}, 'nl': {_q(nl)}, 'pos': {p}, 'h': {'true' if h else 'false'}}}"
        for n, dt, nl, p, h in rows) + "]"


_LAYOUT_TAGGED = _layout_list(_VAULT_LAYOUT_TAGGED)
_LAYOUT_PLAIN = _layout_list([(n, dt, nl, i + 1, False) for i, (n, dt, nl) in enumerate(PII_COLUMNS)])

_TABLE_TYPES = """case
 when lower(data_type) = 'varchar' then 'string'
 when lower(data_type) = 'integer' then 'int'
 when lower(data_type) = 'float[]' then 'array<float>'
 when lower(data_type) = 'timestamp' then 'timestamp_ntz'
 when lower(data_type) = 'timestamp with time zone' then 'timestamp'
 else lower(data_type) end"""

ORACLE_SQL: dict[str, str] = {
    "synthetic_pii": _pii_sql("o_orderkey", "orders"),
    "column_catalog": f"""select 'landing' as catalog_name, 'testdata' as schema_name, table_name, column_name,
 {_TABLE_TYPES} as full_data_type, 'YES' as is_nullable, cast(ordinal_position as integer) as ordinal_position
 from information_schema.columns
 where table_name in ('region','nation','customer','supplier','part','orders','lineitem','events',
                      'documents','embeddings','pages','benchmark','labels','conversations')
 union all select * from (""" + _estate(
        "select 'landing', schema_name, table_name, col.c, col.dt, col.nl, cast(col.pos as integer) from pc",
        f"pc as (select k, schema_name, table_name, unnest({_COLS_LIST}) as col from t)") + ")",
    "manifest_quarantine": _estate(
        "select document_sha256, reason, n_tags from bad, (select (select count(*) from m) + 2 * (select count(*) from t where k%11=0) as n_tags) as n",
        MANIFEST_CLEAN,
        "bad as (select sha256('{\"schemas\": [tenant ' || c_custkey) as document_sha256, 'not JSON' as reason from customer where c_custkey%10=0 "
        "union all select sha256('{\"schemas\": \"none\", \"tenant\": ' || c_custkey || '}'), 'not the layout of a manifest' from customer where c_custkey%10=1 "
        "union all select sha256('{\"schemas\": [{\"schema_name\": \"s' || c_custkey || '\", \"tables\": 5}]}'), 'not the layout of a manifest' "
        "from customer where c_custkey%10=2)"),
    "manifest_flatten": _estate(
        "select schema_name, table_name, column_name, tag_name, tag_value from m "
        "union all select schema_name, table_name, 'nickname', 'sensitivity_category', 'pii' from t where k%11=0 "
        "union all select schema_name, table_name, 'nickname', 'sensitivity_type', 'name' from t where k%11=0",
        MANIFEST_CLEAN),
    "manifest_mismatch": _estate(
        f"select schema_name, table_name, 'nickname' as column_name, {_q(MISMATCH_REASON)} as reason from t where k%11=0"),
    "missing_tags": _estate(
        "select schema_name, table_name, column_name, tag_name, tag_value from m where k%3=0 "
        "union all select schema_name, table_name, 'dob', 'sensitivity_category', 'pii' from t where k%3<>0 and k%7=0",
        MANIFEST_CLEAN),
    "apply_tags": _estate(
        f"select 'landing' as catalog_name, schema_name, table_name, column_name, tag_name, tag_value from m "
        f"union all {BANK_TAGS}", MANIFEST_CLEAN),
    "new_tables": _estate(
        "select 'landing' as catalog_name, schema_name, table_name, 'vault' as target_catalog from t where k%4<>0 "
        "union all select 'vault', schema_name, table_name, 'anonymized' from t where k%4=0 and k%8<>0"),
    "sensitive_columns": _estate(
        "select 'landing' as catalog_name, schema_name, table_name, s.c as column_name, "
        "'sensitivity_type' as tag_name, s.typ as tag_value from a where k%3<>0"),
    "load_plan": _estate(
        "select 'landing' as catalog_name, schema_name, table_name, col.c as column_name, col.dt as full_data_type, "
        "col.nl as is_nullable, cast(col.pos as integer) as ordinal_position, "
        "case when k%3<>0 and col.typ is not null then 'sensitivity_type' end as tag_name, "
        "case when k%3<>0 then col.typ end as tag_value, "
        f"case when k%3<>0 then {_q(KEK_NAME_PREFIX)} || col.typ end as kek_name, "
        f"case when k%3<>0 then {_q(DSK_NAME_PREFIX)} || col.typ end as dsk_name "
        "from pc where k%4<>0",
        f"pc as (select k, schema_name, table_name, unnest({_COLS_LIST}) as col from t)"),
    "tables_and_keys_to_load": _estate(
        "select 'table' as kind, 'landing' as catalog_name, schema_name, table_name, "
        "cast(null as varchar) as tag_value, cast(null as varchar) as kek_name, cast(null as varchar) as dsk_name "
        "from t where k%4<>0 union all select distinct 'key', null, null, null, s.typ, "
        f"{_q(KEK_NAME_PREFIX)} || s.typ, {_q(DSK_NAME_PREFIX)} || s.typ from a where k%4<>0 and k%3<>0"),
    "vault_schema": _estate(
        "select 'vault' as catalog_name, schema_name, table_name, l.c as column_name, l.dt as full_data_type, "
        "l.nl as is_nullable, cast(l.pos as integer) as ordinal_position, l.h as is_hash from lay",
        f"lay as (select schema_name, table_name, unnest(case when k%3<>0 then {_LAYOUT_TAGGED} "
        f"else {_LAYOUT_PLAIN} end) as l from t where k%4<>0)"),
    "propagate_tags": _estate(
        "select 'vault' as catalog_name, schema_name, table_name, column_name, tag_name, tag_value from have where k%4<>0 "
        "union all select 'vault', schema_name, table_name, column_name || '_hash', tag_name, tag_value "
        "from have where k%4<>0 and column_name <> 'bank_name' "
        "union all select 'vault', schema_name, table_name, s.c || '_hash', 'derived', 'hash' from a where k%4<>0 and k%3<>0",
        EXISTING_TAGS),
    "key_registry": _estate(
        f"select distinct attr as pci_pii_attribute_name, {_q(KEK_NAME_PREFIX)} || attr as kek_name, "
        f"{_q(DSK_NAME_PREFIX)} || attr as dsk_name from (select unnest({'[' + ', '.join(_q(x) for x in SENSITIVITY_TYPES[:5]) + ']'}) as attr "
        "union all select s.typ from a where k%3<>0)"),
    "kek_latest_version": _estate(
        "select kek_name, latest_version, latest_created from kk where k%25<>0", TENANT_KEYS),
    "keys_due": _estate(
        "select kek_name, latest_version as version, latest_created as created, "
        "latest_created + interval 335 day as due_at from kk "
        "where k%25<>0 and latest_created + interval 335 day <= timestamp '2025-06-01 00:00:00'", TENANT_KEYS),
    "keys_ensure": _estate(
        "select attribute, kek_name, dsk_name, case when k%25=0 then 'v1' else latest_version end as kek_version, "
        "60 as wrapped_len, true as roundtrip_ok from kk where k%5=0", TENANT_KEYS),
    "keys_unwrap": _estate(
        "select attribute, kek_name, dsk_name, case when k%2=0 then latest_version else 'v1' end as kek_version, "
        "sha256('SALT-t' || cast(k as varchar) || '-' || attribute) as dsk_fingerprint from kk where k%5<>0", TENANT_KEYS),
    "keys_rotate": _estate(
        "select attribute, kek_name, dsk_name, latest_version as kek_version, (k%2<>0 and k%3<>0) as rotated, "
        "sha256('SALT-t' || cast(k as varchar) || '-' || attribute) as dsk_fingerprint from kk where k%5<>0", TENANT_KEYS),
    "aes_roundtrip": f"with p as ({PII}) select id, ssn, pan, ssn as ssn_roundtrip, pan as pan_roundtrip, "
                     "cast(length(ssn) + 28 as integer) as ssn_cipher_len from p",
    **{
        f"mask_{t.replace('-', '_')}": f"with p as ({PII}) select id, {c}, {_mask(c)} as {c}_masked from p"
        for c, _, t in SENSITIVE_COLUMNS
    },
    "mask_role_gate": f"""with p as ({PII}), g(grp, member) as (values ('pii_readers','alice'), ('pii_readers','carol'), ('auditors','bob'))
 select id, ssn,
  case when exists (select 1 from g where grp='pii_readers' and member='alice') then ssn else {_mask('ssn')} end as ssn_as_alice,
  case when exists (select 1 from g where grp='pii_readers' and member='bob') then ssn else {_mask('ssn')} end as ssn_as_bob
 from p""",
    "hash_column": f"with p as ({PII}) select id, ssn, {_hash('ssn')} as ssn_hash from p",
    "hash_null": f"with p as ({PII}) select id, ssn is null as ssn_is_null, {_hash('ssn')} is null as hash_is_null from p",
    "hash_interleave": VAULT,
    "hash_join": f"""with p as ({PII}),
 o as (select o_orderkey, {_ssn_sql('o_custkey')} as cust_ssn from orders),
 agg as (select cust_ssn, count(*) as n_orders, cast(sum(o_orderkey) as bigint) as sum_orderkey
         from o where cust_ssn is not null group by cust_ssn)
 select p.id, {_hash('ssn')} as ssn_hash, agg.n_orders, agg.sum_orderkey from p join agg on p.ssn = agg.cust_ssn""",
    "hash_join_rows": f"""with p as ({PII})
 select o_orderkey, {_hash('ssn')} as cust_ssn_hash, id
 from (select o_orderkey, {_ssn_sql('o_custkey')} as cust_ssn from orders) o join p on p.ssn = o.cust_ssn where p.ssn <> '12'""",
    "vault_tags": "with s(c, cat, typ) as (values " + ", ".join(
        f"({_q(c)}, {_q(cat)}, {_q(t)})" for c, cat, t in SENSITIVE_COLUMNS) + """),
 src as (select 'customer_records' as table_name, * from s union all select 'order_records', 'cust_ssn', 'pii', 'ssn'),
 h as (select table_name, c as column_name, cat, typ, false as h from src
       union all select table_name, c || '_hash', cat, typ, true from src)
 select table_name, column_name, 'sensitivity_category' as tag_name, cat as tag_value from h
 union all select table_name, column_name, 'sensitivity_type', typ from h
 union all select table_name, column_name, 'derived', 'hash' from h where h""",
    "tag_log": _estate(
        "select catalog_name, schema_name, table_name, column_name, tag_name, case when column_name='bank_name' then null "
        "when column_name='dob' and tag_name='sensitivity_category' then 'pii' else tag_value end as tag_value from have "
        "union all select catalog_name, schema_name, table_name, column_name, 'reviewed', tag_value from have "
        "where column_name='dob' and tag_name='sensitivity_type'", EXISTING_TAGS),
    "masked_view": ANONYMIZED,
    "vault_load": VAULT,
    "anonymized_load": ANONYMIZED,
    "incremental_load": VAULT,
    "arrivals_load": f"with v as ({VAULT}) select v.*, {_mask('ssn')} as ssn_masked from v",
    "arrivals_audit": f"""with p as ({PII}), o as (select count(*) as n from orders),
 c as (select count(*) filter (id % 2 = 0) as old, count(*) filter (id % 2 <> 0) as late from p),
 a as (select 'vault' as target_catalog, 'customer_records' as table_name, 'load' as kind, old as rows from c
       union all select 'anonymized', 'customer_records', 'load', old from c
       union all select 'vault', 'customer_records', 'arrival', late from c
       union all select x, 'order_records', 'load', n from o, (values ('vault'), ('anonymized')) as l(x))
 select a.*, cast(61 as bigint) as n_files from a""",
    "hash_join_pruned": f"""with p as ({PII})
 select o_orderkey, {_hash('ssn')} as cust_ssn_hash, id
 from (select o_orderkey, {_ssn_sql('o_custkey')} as cust_ssn from orders) o join p on p.ssn = o.cust_ssn where id % 100 = 0""",
    "hash_joinability": f"""with p as ({PII}),
 o as (select {_ssn_sql('o_custkey')} as ssn from orders),
 h as (""" + " union ".join(
        f"select 'customer_records' as t, {_q(c + '_hash')} as c, {_q(t)} as typ, {_hash(c)} as h from p" for c, _, t in SENSITIVE_COLUMNS) + f"""
  union select 'order_records', 'cust_ssn_hash', 'ssn', {_hash('ssn')} from o
  union select 'wrong_records', 'ssn_hash', 'ssn', sha256('other' || ssn) from p),
 s as (select distinct * from h where h < '4'),
 n as (select t, c, typ, 4 * count(*) as n from s group by t, c, typ),
 k as (select a.t as at, a.c as ac, b.t as bt, b.c as bc, 4 * count(*) as common from s a join s b on a.h = b.h and (a.t, a.c) < (b.t, b.c)
       group by a.t, a.c, b.t, b.c)
 select a.t as left_table, a.c as left_column, b.t as right_table, b.c as right_column, a.n as left_distinct, b.n as right_distinct,
  coalesce(common, 0) as common, coalesce(common, 0)::double / least(a.n, b.n) as containment,
  coalesce(common, 0) = 0 and a.typ = b.typ as suspect
 from n a join n b on (a.t, a.c) < (b.t, b.c) left join k on k.at = a.t and k.ac = a.c and k.bt = b.t and k.bc = b.c
 where a.typ = b.typ or common > 0""",
}
