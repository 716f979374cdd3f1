"""Declared schemas: files and streams are never read with inferred types."""

from pyspark.sql import types as T

TEXT = T.StringType()


def _struct(**fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


def _texts(*names):
    return _struct(**{n: TEXT for n in names})


LOOKUP = _texts("key", "value")
SIC_MAP = _texts("code", "description")
POSTCODES = _texts("postcode", "county", "built_up_area")

FACTS = _texts(
    "company_number",
    "name",
    "label",
    "context_ref",
    "value",
    "start_date",
    "end_date",
    "unit",
    "decimals",
)

EVENT = _struct(
    fields_changed=T.ArrayType(TEXT),
    published_at=TEXT,
    timepoint=T.LongType(),
    type=TEXT,
)

ADDRESS = _texts(
    "address_line_1",
    "address_line_2",
    "care_of",
    "country",
    "locality",
    "po_box",
    "postal_code",
    "premises",
    "region",
)


def _envelope(data):
    return _struct(resource_kind=TEXT, resource_id=TEXT, resource_uri=TEXT, data=data, event=EVENT)


COMPANY_EVENT = _envelope(
    _struct(
        accounts=_struct(
            accounting_reference_date=_texts("day", "month"),
            last_accounts=_texts("made_up_to", "period_end_on", "period_start_on", "type"),
            next_accounts=_texts("due_on", "period_end_on", "period_start_on"),
            next_due=TEXT,
            next_made_up_to=TEXT,
            overdue=T.BooleanType(),
        ),
        can_file=T.BooleanType(),
        company_name=TEXT,
        company_number=TEXT,
        company_status=TEXT,
        confirmation_statement=_struct(
            last_made_up_to=TEXT, next_due=TEXT, next_made_up_to=TEXT, overdue=T.BooleanType()
        ),
        date_of_cessation=TEXT,
        date_of_creation=TEXT,
        etag=TEXT,
        foreign_company_details=_struct(originating_registry=_texts("country", "name")),
        jurisdiction=TEXT,
        previous_company_names=T.ArrayType(_texts("ceased_on", "effective_from", "name")),
        registered_office_address=ADDRESS,
        sic_codes=T.ArrayType(TEXT),
        type=TEXT,
    )
)

FILING_ITEM = _struct(
    annotations=T.ArrayType(
        _struct(
            annotation=TEXT,
            category=TEXT,
            date=TEXT,
            description=TEXT,
            description_values=T.MapType(TEXT, TEXT),
            type=TEXT,
        )
    ),
    associated_filings=T.ArrayType(_texts("date", "description", "type")),
    action_date=TEXT,
    barcode=TEXT,
    category=TEXT,
    date=TEXT,
    description=TEXT,
    description_values=T.MapType(TEXT, TEXT),
    links=_texts("document_metadata", "self"),
    pages=T.IntegerType(),
    paper_filed=T.BooleanType(),
    resolutions=T.ArrayType(
        _texts("category", "description", "document_id", "receive_date", "subcategory", "type")
    ),
    subcategory=TEXT,
    transaction_id=TEXT,
    type=TEXT,
)
FILING_EVENT = _envelope(FILING_ITEM)

INSOLVENCY_EVENT = _envelope(
    _struct(
        etag=TEXT,
        cases=T.ArrayType(
            _struct(
                dates=T.ArrayType(_texts("date", "type")),
                links=_texts("charge"),
                notes=T.ArrayType(TEXT),
                number=TEXT,
                practitioners=T.ArrayType(
                    _struct(
                        address=ADDRESS, appointed_on=TEXT, ceased_to_act_on=TEXT, name=TEXT, role=TEXT
                    )
                ),
                type=TEXT,
            )
        ),
        status=TEXT,
    )
)

CHARGE_EVENT = _envelope(
    _struct(
        acquired_on=TEXT,
        assests_ceased_released=TEXT,
        charge_code=TEXT,
        charge_number=T.LongType(),
        classification=_texts("description", "type"),
        covering_instrument_date=TEXT,
        created_on=TEXT,
        delivered_on=TEXT,
        etag=TEXT,
        id=TEXT,
        particulars=_struct(
            chargor_acting_as_bare_trustee=T.BooleanType(),
            contains_fixed_charge=T.BooleanType(),
            contains_floating_charge=T.BooleanType(),
            contains_negative_pledge=T.BooleanType(),
            description=TEXT,
            floating_charge_covers_all=T.BooleanType(),
            type=TEXT,
        ),
        persons_entitled=T.ArrayType(_texts("name")),
        resolved_on=TEXT,
        satisfied_on=TEXT,
        secured_details=_texts("description", "type"),
        status=TEXT,
    )
)

CONTROLLER_EVENT = _envelope(
    _struct(
        address=ADDRESS,
        ceased_on=TEXT,
        country_of_residence=TEXT,
        date_of_birth=_struct(day=T.IntegerType(), month=T.IntegerType(), year=T.IntegerType()),
        etag=TEXT,
        identification=_texts(
            "country_registered",
            "legal_authority",
            "legal_form",
            "place_registered",
            "registration_number",
        ),
        kind=TEXT,
        links=_texts("self", "statement"),
        name=TEXT,
        name_elements=_texts("forename", "middle_name", "surname", "title"),
        nationality=TEXT,
        natures_of_control=T.ArrayType(TEXT),
        notified_on=TEXT,
    )
)

OFFICER_EVENT = _envelope(
    _struct(
        address=ADDRESS,
        appointed_on=TEXT,
        country_of_residence=TEXT,
        date_of_birth=_struct(day=T.IntegerType(), month=T.IntegerType(), year=T.IntegerType()),
        etag=TEXT,
        former_names=T.ArrayType(_texts("forenames", "surname")),
        identification=_texts(
            "identification_type",
            "legal_authority",
            "legal_form",
            "place_registered",
            "registration_number",
        ),
        name=TEXT,
        nationality=TEXT,
        occupation=TEXT,
        officer_role=TEXT,
        resigned_on=TEXT,
    )
)

TOPICS = {
    "companies": COMPANY_EVENT,
    "filings": FILING_EVENT,
    "officers": OFFICER_EVENT,
    "persons-with-significant-control": CONTROLLER_EVENT,
    "charges": CHARGE_EVENT,
    "insolvency-cases": INSOLVENCY_EVENT,
}

FACT_JSON = "struct<factList:array<array<string>>>"
FACT_NAME = "struct<name:string>"
FACT_BODY = (
    "struct<label:string,value:string,start:string,endInstant:string,dimensions:map<string,string>>"
)
