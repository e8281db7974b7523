"""Scalar column functions (F1-F17): built-in Spark expressions only, no UDFs."""

from tidemill.functions.casts import lenient_int, to_date_lenient, to_decimal_money, to_timestamp_lenient
from tidemill.functions.ip import int_to_ip, ip_to_long
from tidemill.functions.json import json_field, json_fields, parse_json_struct, record_json
from tidemill.functions.text import (
    default_to,
    jvm_trim,
    region_city,
    region_province,
    reverse_text,
)
from tidemill.functions.time import millis_to_text, order_id_text, user_id_text

__all__ = [
    "default_to",
    "int_to_ip",
    "ip_to_long",
    "json_field",
    "json_fields",
    "jvm_trim",
    "lenient_int",
    "millis_to_text",
    "order_id_text",
    "parse_json_struct",
    "record_json",
    "region_city",
    "region_province",
    "reverse_text",
    "to_date_lenient",
    "to_decimal_money",
    "to_timestamp_lenient",
    "user_id_text",
]
