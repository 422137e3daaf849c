"""Patterns and formats of the input data."""

# A line in common log format, and the names of its fields in order.
LOG_LINE = r'^(\S+) (\S+) (\S+) \[(\d{2}/[A-Za-z]{3}/\d{4}:\d{2}:\d{2}:\d{2}) -\d{4}\] "(GET|POST|HEAD|PUT|DELETE|CONNECT|OPTIONS|TRACE|PATCH) (\S+) (\S+)" (\d{3}) (\S+)$'
LOG_FIELDS = [
    "host",
    "user_identifier",
    "user_id",
    "datetime",
    "request_method",
    "resource",
    "protocol",
    "http_status",
    "content_size",
]
LOG_MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
# The host and the time of a log line, looked for separately, and what stands for neither.
LOG_HOST = r"^(\S+\.\S\S+)\s"
LOG_DATE = r"(\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2})"
NO_MATCH = "no match"

# The date pattern of the emergency calls, and the shape of their times, MM/dd/yyyy hh:mm:ss a.
CALL_DAY = "MM/dd/yyyy"
CALL_MOMENT_SHAPE = r"^\d{2}/\d{2}/\d{4} (0[1-9]|1[0-2]):[0-5]\d:[0-5]\d [AaPp][Mm]$"
