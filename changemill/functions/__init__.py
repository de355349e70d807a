from changemill.functions.columns import (  # noqa: F401
    col,
    empty_to_null,
    int_or_text,
    join_keys,
    lenient_double,
    order_value,
    strip_schema,
    table_of,
    matches_wildcard,
    template,
    wildcard,
    wildcard_regex,
)
