from rowferry.functions.convert import (  # noqa: F401
    Columns,
    as_text,
    date_with_default,
    first_present,
    flag_boolean,
    flag_yn,
    integer_with_default,
    make_converter,
    normalize_string,
    safe_boolean,
    safe_date,
    safe_float,
    safe_integer,
    safe_json,
    safe_string,
    string_or_default,
    string_with_default,
    with_default,
)
from rowferry.functions.text import contains_any, fixed2, full_name, key_text, split_key  # noqa: F401
