"""Common Log Format parsing with native regex extraction."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# A line is: host, identity, user, [time], "request", status, size.  Each field
# is read from its own place in that grammar; what does not fit its form is empty
# (path, host, time) or null (status, size), the other fields stay.
_HEAD = r"^(?:\S+ ){3}\[[^\]]*\] "
_REQUEST = r"\"(?:[^\"]*)\" "
HOST_RE = r"^(\S+) "
TIMESTAMP_RE = r"^(?:\S+ ){3}\[(\d{2}/[A-Za-z]{3}/\d{4}(?::\d{2}){3} [-+]\d{4})\]"
PATH_RE = _HEAD + r"\"[A-Za-z]+ +(\S+) +HTTP[^\" ]*\" "
STATUS_RE = _HEAD + _REQUEST + r"(\d{3}) "
SIZE_RE = _HEAD + _REQUEST + r"\S+ (\d+)$"
# Fixed value: the timestamp layout.
CLF_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss"


def parse_clf_columns(value="value") -> list[Column]:
    v = F.col(value) if isinstance(value, str) else value
    return [
        F.regexp_extract(v, HOST_RE, 1).alias("host"),
        F.regexp_extract(v, TIMESTAMP_RE, 1).alias("timestamp"),
        F.regexp_extract(v, PATH_RE, 1).alias("path"),
        F.regexp_extract(v, STATUS_RE, 1).try_cast("int").alias("status"),
        F.regexp_extract(v, SIZE_RE, 1).try_cast("int").alias("content_size"),
    ]


def clf_time(c) -> Column:
    """``dd/MMM/yyyy:HH:mm:ss ±zzzz`` -> timestamp; the zone is ignored, as in
    the original programs.  Unparseable text gives null."""
    c = F.col(c) if isinstance(c, str) else c
    parsed = F.try_to_timestamp(F.substring(c, 1, 20), F.lit(CLF_TIME_FORMAT))
    return parsed.cast("timestamp_ntz")


def clf_line(host, ts, method, path, status, size) -> Column:
    """Render one CLF line: ``host - - [dd/MMM/yyyy:HH:mm:ss -0000] "M path HTTP/1.0" status size``;
    ``path`` ends with a space, or is empty in a request without one."""
    return F.concat(host, F.lit(" - - ["), F.date_format(ts, CLF_TIME_FORMAT), F.lit(" -0000] \""),
                    method, F.lit(" "), path, F.lit("HTTP/1.0\" "), status, F.lit(" "), size)
