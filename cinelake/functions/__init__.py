from cinelake.functions.jsonops import (  # noqa: F401
    json_array, json_bigint, json_bool, json_date, json_double, json_string, blank_to_null,
)
