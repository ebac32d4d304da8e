"""Inputs: line/Kafka sources, typed record parsers, driver-table adapters."""

from rivulet.sources.records import (
    AD_CLICK,
    APACHE_LOG,
    LOGIN,
    MARKETING,
    USER_BEHAVIOR,
    Parsed,
    parse_ad_clicks,
    parse_apache_log,
    parse_logins,
    parse_marketing,
    parse_user_behavior,
)
from rivulet.sources.text import kafka_available, read_kafka, read_lines, write_kafka

__all__ = [
    "AD_CLICK", "APACHE_LOG", "LOGIN", "MARKETING", "USER_BEHAVIOR", "Parsed", "kafka_available",
    "parse_ad_clicks", "parse_apache_log", "parse_logins", "parse_marketing", "parse_user_behavior",
    "read_kafka", "read_lines", "write_kafka",
]
