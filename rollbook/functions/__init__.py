"""Column -> Column functions. No Python UDFs: everything stays in Catalyst."""

from .collections import (  # noqa: F401
    chunk,
    drop_null_fields,
    map_values_with,
    only_value,
    previous_names,
    sic_array,
    snake_keys,
)
from .companies import (  # noqa: F401
    appointment_type,
    change_map,
    changed,
    company_type,
    optional_struct,
)
from .dates import (  # noqa: F401
    birth_date,
    bucket,
    ch_date,
    day_name,
    dow0,
    hour24,
    hour_of,
    instant,
    repair_century,
)
from .numbers import clean_number, int_or_text, round_half_up, safe_cast, to_decimal  # noqa: F401
from .text import (  # noqa: F401
    bold_html,
    bold_title,
    camel_case,
    clean_label,
    count_char,
    fill_template,
    json_field,
    null_if_empty,
    outer_key,
    pad_number,
    parse_path,
    strip_prefix,
    uri_company,
    yes_flag,
)
