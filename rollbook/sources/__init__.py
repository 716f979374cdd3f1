"""Readers, writers and file-level checks."""

from .facts import (  # noqa: F401
    explode_fact_json,
    fact_rows,
    read_fact_csv,
    read_fact_json,
    read_fact_lines,
)
from .files import latest_snapshot, ordered_scan, pending  # noqa: F401
from .lookups import key_values, read_key_values, read_lookup  # noqa: F401
from .officers import (  # noqa: F401
    parse_fixed_width,
    read_fixed_width,
    reconcile_counts,
    split_quarantine,
)
from .sinks import write_delimited, write_documents  # noqa: F401
from .versions import current_version, publish, read_parts, write_part  # noqa: F401
from .snapshots import (  # noqa: F401
    nest_dotted,
    read_delimited,
    read_json_lines,
    read_mapped_csv,
    read_snapshot_csv,
)
