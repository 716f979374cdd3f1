"""Whole jobs: compositions of the operators, from landed files to stored tables."""

from .accounts import (  # noqa: F401
    account_documents_from_facts,
    account_documents_from_json,
    backfill_filings,
    build_tracker,
    load_fact_stream,
    load_facts,
    profile_rows,
)
from .accounts_view import read_wide_accounts, refresh_wide_accounts  # noqa: F401
from .events import load_company_events, load_filing_events  # noqa: F401
from .officers import load_officers, officer_rows, person_rules  # noqa: F401
from .reports import (  # noqa: F401
    account_officers,
    adviser_report,
    daily_frequency,
    hourly_frequency,
    regional_accounts,
    wide_accounts,
)
from .snapshots import (  # noqa: F401
    company_document,
    company_documents,
    companies_and_sic,
    sic_codes,
    warehouse_company,
)
