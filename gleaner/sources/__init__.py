"""Sources: response bodies -> records, REST and Python-function fetchers."""

from gleaner.sources.records import dead_letters, infer_text_types, parse_csv_records, parse_json_records
from gleaner.sources.fetch import fetch_function, fetch_http, land

__all__ = ["infer_text_types", "parse_csv_records", "parse_json_records",
           "fetch_function", "fetch_http", "land"]
