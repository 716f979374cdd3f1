"""DataFrame -> DataFrame operators."""

from .counts import (  # noqa: F401
    count_summary,
    counter,
    frequency,
    groups_over,
    key_list,
    label_document_frequency,
    latest_buckets,
    load_audit,
    non_null_frequency,
    record_totals,
    time_profile,
)
from .joins import (  # noqa: F401
    band_join,
    client_counts,
    describe,
    enrich_stream,
    in_region,
    join_buckets,
    join_facts,
    join_json_field,
    not_processed,
    relabel_all_or_none,
    scalar_lookup,
    update_from,
    with_area,
    with_exists_flag,
)
from .incremental import merge_partials, partial_facts, pivot_partials  # noqa: F401
from .lists import in_order, list_values  # noqa: F401
from .merge import (  # noqa: F401
    add_parents,
    append_values,
    drop_exact,
    insert_new,
    largest_absolute,
    merge_maps,
    read_refreshed,
    refresh,
    stored,
    replace_documents,
    unique,
    upsert,
    upsert_largest,
)
from .pivot import (  # noqa: F401
    dated_summary,
    distinct_values,
    financial_profile,
    first_for,
    hits_and_keys,
    max_for,
    nest_facts,
    only_values,
    pivot_facts,
    signed_extreme,
    value_map,
)
from .predicates import (  # noqa: F401
    above,
    complete_groups,
    in_values,
    is_long,
    lookup,
    lookup_misses,
    match_name,
    null_sentinels,
    recent,
    rename_case,
    require,
    route_by_length,
    self_consistent,
    time_range,
    unresolved,
)
from .sorting import (  # noqa: F401
    high_water_mark,
    newest_first,
    ordered_report,
    page,
    shuffled,
    top_labels,
    work_list,
)
from .trees import explode_sic, flatten_tree  # noqa: F401
from .windows import (  # noqa: F401
    latest_per_key,
    rolling_count,
    rolling_mean,
    running_mean,
    with_first_seen,
    with_position,
    with_previous,
)
