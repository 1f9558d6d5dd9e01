"""DataFrame → DataFrame operators (cleaning, condensing, enrichment, merges)."""

from usagetally.operators.clean import (
    fact_rows,
    fill_missing,
    named_projects,
    numeric_defaults,
    product_filter,
    unsalt_gid,
    valid_actions,
    with_dongle,
)
from usagetally.operators.condense import (
    affected_days,
    condense_usage_rows,
    dim_condense,
    fact_condense,
    latest_present,
    usage_condense,
    usage_rows,
    user_usage_condense,
)
from usagetally.operators.merge import (
    fact_merge_full,
    fact_merge_left,
    fact_new_only,
    insert_flag,
    keyed_update,
    new_keys_only,
    usage_merge,
)
from usagetally.operators.relational import (
    dim_insert_rows,
    relational_changed_rows,
    relational_facts,
    relational_insert_rows,
    relational_update_result,
)
from usagetally.operators.summary import project_summary
from usagetally.operators.users import enrich_users, user_lookup, users_by_gid, users_by_id, written_lookup

__all__ = [
    "affected_days", "condense_usage_rows", "dim_condense", "dim_insert_rows", "enrich_users", "fact_condense",
    "fact_merge_full", "fact_merge_left", "fact_new_only", "fact_rows", "fill_missing",
    "insert_flag", "keyed_update", "latest_present", "named_projects", "new_keys_only",
    "numeric_defaults", "product_filter", "project_summary", "relational_changed_rows", "relational_facts",
    "relational_insert_rows", "relational_update_result", "unsalt_gid", "usage_condense",
    "usage_merge", "usage_rows", "user_lookup", "user_usage_condense", "users_by_gid", "users_by_id", "valid_actions",
    "with_dongle", "written_lookup",
]
