"""DuckDB SQL for the queries that SQL can express over whole tables."""

ORACLE_SQL = {
    "op7_exact_dedup": r"""
with t as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents)
select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = min(doc_id) over g as kept, text_sha256
from t window g as (partition by text_sha256)""",
}
