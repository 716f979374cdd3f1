"""Event streams: NDJSON landing folders in, stored tables out."""

from .change_log import ChangeLog  # noqa: F401
from .companies import (  # noqa: F401
    COMPANY_COLUMNS,
    company_log,
    diff_companies,
    flatten_company,
    read_companies,
    start_company_stream,
    store_companies,
    timepoint_block,
)
from .events import (  # noqa: F401
    backlog_age,
    dedupe_events,
    event_rate,
    mark_deleted,
    parse_or_quarantine,
    read_events,
    read_lines,
    read_rates,
    repair_frames,
    resume_after,
    store_rates,
    unknown_codes,
    with_event_key,
)
from .filings import describe_filings, describe_flat, flatten_filing  # noqa: F401
from .seen import SeenIds, new_events, save_new_events  # noqa: F401
from .runs import run_continuous, run_until_current, save_each_batch  # noqa: F401
