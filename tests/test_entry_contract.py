"""Driver contract: the survey's keys are all there, each with an oracle, and oracles have queries."""

import __spark_entry__ as E

SURVEY_KEYS = {
    "synthetic_pii", "column_catalog", "manifest_flatten", "manifest_mismatch", "missing_tags", "apply_tags",
    "new_tables", "sensitive_columns", "load_plan", "tables_and_keys_to_load", "vault_schema", "key_registry",
    "kek_latest_version", "keys_ensure", "keys_unwrap", "keys_rotate", "keys_due", "aes_roundtrip", "mask_pan",
    "mask_exp_date", "mask_name", "mask_address", "mask_email", "mask_phone", "mask_dob", "mask_ssn",
    "mask_role_gate", "hash_column", "hash_null", "hash_interleave", "hash_join", "masked_view", "propagate_tags",
    "vault_load", "anonymized_load", "incremental_load",
}


def test_queries_and_oracles_cover_survey():
    q, o = E.queries(), E.oracle_sql()
    assert set(q) >= SURVEY_KEYS
    assert set(q) >= set(o) >= SURVEY_KEYS
    assert all(callable(f) for f in q.values())
    assert all(isinstance(s, str) and s.strip() for s in o.values())
