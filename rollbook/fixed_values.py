"""Texts, codes, patterns and layouts that results depend on.

Everything in this module is data, not logic. The entries have to be exactly
these for the results to be right, so they stand here plainly and together.
"""

# -- Fixed values: company type code -> text ---------------------------------
COMPANY_TYPES = {
    "private-unlimited": "Private unlimited company",
    "ltd": "Private limited company",
    "plc": "Public limited company",
    "old-public-company": "Old public company",
    "private-limited-guarant-nsc-limited-exemption": (
        "Private Limited Company by guarantee without share capital, use of 'Limited' exemption"
    ),
    "limited-partnership": "Limited partnership",
    "private-limited-guarant-nsc": "Private limited by guarantee without share capital",
    "converted-or-closed": "Converted / closed",
    "private-unlimited-nsc": "Private unlimited company without share capital",
    "private-limited-shares-section-30-exemption": (
        "Private Limited Company, use of 'Limited' exemption"
    ),
    "protected-cell-company": "Protected cell company",
    "assurance-company": "Assurance company",
    "oversea-company": "Overseas company",
    "eeig": "European economic interest grouping (EEIG)",
    "icvc-securities": "Investment company with variable capital",
    "icvc-warrant": "Investment company with variable capital",
    "icvc-umbrella": "Investment company with variable capital",
    "registered-society-non-jurisdictional": "Registered society",
    "industrial-and-provident-society": "Industrial and Provident society",
    "northern-ireland": "Northern Ireland company",
    "northern-ireland-other": "Credit union (Northern Ireland)",
    "llp": "Limited liability partnership",
    "royal-charter": "Royal charter company",
    "investment-company-with-variable-capital": "Investment company with variable capital",
    "unregistered-company": "Unregistered company",
    "other": "Other company type",
    "european-public-limited-liability-company-se": (
        "European public limited liability company (SE)"
    ),
    "uk-establishment": "UK establishment company",
    "scottish-partnership": "Scottish qualifying partnership",
    "charitable-incorporated-organisation": "Charitable incorporated organisation",
    "scottish-charitable-incorporated-organisation": (
        "Scottish charitable incorporated organisation"
    ),
    "further-education-or-sixth-form-college-corporation": (
        "Further education or sixth form college corporation"
    ),
}

# -- Fixed values: officer appointment type code -> text ----------------------
APPOINTMENT_TYPES = {
    0: "Secretary",
    1: "Director",
    4: "Non-designated LLP Member",
    5: "Designated LLP Member",
    11: "Judicial Factor",
    12: "Receiver or Manager appointed under the Charities Act",
    13: "Manager appointed under the CAICE Act",
    17: "SE Member of Administrative Organ",
    18: "SE Member of Supervisory Organ",
    19: "SE Member of Management Organ",
}

# -- Fixed values: wide accounts, (column, fact label, rule) -------------------
# rule: date / text = first value, signed = extreme value in the dominant sign
WIDE_ACCOUNTS = [
    ("balance_sheet_date", "Balance sheet date", "date"),
    ("report_end_date", "End date for period covered by report", "date"),
    ("report_start_date", "Start date for period covered by report", "date"),
    ("legal_name", "Entity current legal or registered name", "text"),
    ("accountants", "Name of entity accountants", "text"),
    ("accounting_software", "Name of production software", "text"),
    ("employees", "Average number of employees during the period", "signed"),
    ("current_assets", "Current assets", "signed"),
    ("cash_at_bank", "Cash at bank and on hand", "signed"),
    ("debtors", "Debtors", "signed"),
    ("creditors", "Creditors", "signed"),
    ("fixed_assets", "Fixed assets", "signed"),
    ("net_assets", "Net assets (liabilities)", "signed"),
    ("total_assets_less_current_liabilities", "Total assets less current liabilities", "signed"),
    ("equity", "Equity", "signed"),
    ("revenue", "Turnover / revenue", "signed"),
    ("profit", "Profit (loss)", "signed"),
]
OFFICER_LABEL = "Name of entity officer"
ACCOUNTANTS_LABEL = "Name of entity accountants"
REGISTERED_NUMBER_LABEL = "UK Companies House registered number"
EMPLOYEES_LABEL = "Average number of employees during the period"

# -- Fixed values: financial profile, (column, fact label) ---------------------
PROFILE_LABELS = [
    ("company_name", "Entity current legal or registered name"),
    ("company_number", "UK Companies House registered number"),
    ("postcode", "Postal Code / Zip"),
    ("dormant", "Entity is dormant [true/false]"),
    ("accounting_software", "Name of production software"),
    ("accountants", "Name of entity accountants"),
    ("employees", "Average number of employees during the period"),
    ("end_date", "End date for period covered by report"),
    ("balance_sheet_date", "Balance sheet date"),
    ("start_date", "Start date for period covered by report"),
    ("equity", "Equity"),
    ("total_assets_less_current_liabilities", "Total assets less current liabilities"),
    ("net_assets", "Net assets (liabilities)"),
    ("net_current_assets", "Net current assets (liabilities)"),
    ("current_assets", "Current assets"),
    ("creditors", "Creditors"),
    ("revenue", "Turnover / revenue"),
    ("profit", "Profit (loss)"),
]

# -- Fixed values: profile columns that are dates or numbers
PROFILE_DATES = ["end_date", "balance_sheet_date", "start_date"]
PROFILE_NUMBERS = [
    "employees", "equity", "total_assets_less_current_liabilities", "net_assets", "net_current_assets", "current_assets",
    "creditors", "revenue", "profit",
]

# -- Fixed values: balance-sheet-date summary, (column, label, exact or pattern)
DATED_SUMMARY = [
    ("accountants", "Name of entity accountants", "exact"),
    ("accounting_software", "Name of production software", "exact"),
    ("employees", "Average number of employees during the period", "exact"),
    ("current_assets", "Current assets", "exact"),
    ("cash_at_bank", "Cash at bank and on hand", "exact"),
    ("debtors", "Debtors", "exact"),
    ("creditors", "Creditors", "exact"),
    ("fixed_assets", "Fixed assets", "exact"),
    ("net_assets", "Net assets (liabilities)", "exact"),
    ("equity", "Equity", "exact"),
    ("profit", "Profit (loss)", "exact"),
    ("borrowings", "^Bank borrowings", "pattern"),
    ("revenue", "Turnover / revenue", "exact"),
    (
        "total_assets_less_current_liabilities",
        "Total assets less current liabilities",
        "exact",
    ),
]

# -- Fixed values: company snapshot header -> column of the flat companies table
SNAPSHOT_HEADERS = {
    "CompanyName": "name",
    "CompanyNumber": "number",
    "RegAddress.AddressLine1": "streetaddress",
    "RegAddress.County": "county",
    "RegAddress.Country": "country",
    "RegAddress.PostCode": "postcode",
    "CompanyCategory": "category",
    "CompanyStatus": "status",
    "CountryOfOrigin": "origin",
    "IncorporationDate": "date",
    "SICCode.SicText_1": "sic_text_1",
    "SICCode.SicText_2": "sic_text_2",
    "SICCode.SicText_3": "sic_text_3",
    "SICCode.SicText_4": "sic_text_4",
}

# -- Fixed values: activity code list header -> column --------------------------
SIC_HEADERS = {"SIC Code": "code", "Description": "description"}

# -- Fixed values: fact CSV header -> column ------------------------------------
SIC_HEADERS = {"SIC Code": "code", "Description": "description"}
FACT_HEADERS = {
    "Label": "label",
    "Name": "name",
    "contextRef": "context_ref",
    "Value": "value",
    "EntityIdentifier": "company_number",
    "Start": "start_date",
    "End/Instant": "end_date",
    "unitRef": "unit",
    "Dec": "decimals",
}
#: Column of a bundle of fact files that has the name of the file a line is from
FACT_BUNDLE_HEADER = "factFile"

# -- Fixed values: officer snapshot record, (field, first character from 1, length)
OFFICER_LAYOUT = [
    ("company_number", 1, 8),
    ("record_type", 9, 1),
    ("appointment_date_origin", 10, 1),
    ("appointment_type", 11, 2),
    ("person_number", 13, 12),
    ("corporate_indicator", 25, 1),
    ("appointment_date", 33, 8),
    ("resignation_date", 41, 8),
    ("post_code", 49, 8),
    ("partial_birth_date", 57, 8),
    ("full_birth_date", 65, 8),
    ("variable_length", 73, 4),
    ("variable_data", 77, None),
]
OFFICER_HEADER_PREFIX = "DDDDSNAP"
OFFICER_TAIL_PREFIX = "99999999"
OFFICER_VARIABLE_FIELDS = [
    "title",
    "forenames",
    "surname",
    "honours",
    "care_of",
    "po_box",
    "address_line_1",
    "address_line_2",
    "post_town",
    "county",
    "country",
    "occupation",
    "nationality",
    "usual_residential_country",
]
OFFICER_COLUMNS = [
    "company_number",
    "appointment_type",
    "person_number",
    "is_corporate_body",
    "appointment_date",
    "resignation_date",
    "post_code",
    "birth_date",
    "birth_date_is_accurate",
] + OFFICER_VARIABLE_FIELDS

# -- Fixed values: patterns and tokens -----------------------------------------
FACT_FILE_PATTERN = r"^([A-Z0-9]{8})_?(\d{4}-\d{2}-\d{2})?\.csv$"
FACT_JSON_PATTERN = r"^(.{8})_(\d{4}-\d{2}-\d{2})\.json$"
BULK_FILE_PATTERN = (
    r"Accounts_Monthly_Data-([a-zA-Z]+)(\d{4}).Prod\d{3}_\d{4}_([A-Z0-9]{8})_"
    r"(\d{4})(\d{2})(\d{2})\.(xml|html)$"
)
FILING_URI_PATTERN = r"^/company/([A-Z0-9]{6,8})/filing-history"
PLACEHOLDER_PATTERN = r"\{([a-z_]+)\}"
ENUMERATION_PATTERN = r"""^\s+'?([^':]+)'?\s*:\s*["'](.*?)["']\s*(#.*)?$"""
DIMENSION_LABEL_PATTERN = r"^(?:\(via targetRole\) )?(?:x-)?(.+) \[.+\]"
EMPTY_FACT_TOKENS = ["", "(reported)"]
LONG_FACT_CHARACTERS = 2000
NO_ACCOUNTS = "NO ACCOUNTS FILED"
NO_SIC = "None Supplied"
HOME_COUNTRY = "United Kingdom"
BUCKET_UNITS = ("minute", "hour", "day", "month")

# -- Fixed values: stream topic -> path of the event identifier ------------------
STREAM_IDS = {
    "companies": "data.etag",
    "filings": "resource_id",
    "officers": "resource_id",
    "persons-with-significant-control": "resource_id",
    "charges": "resource_id",
    "insolvency-cases": "data.etag",
}
