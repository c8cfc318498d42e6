"""Access-log line parsing as column expressions.

Everything here returns ``Column`` objects built from Spark's own
functions, so parsing is compiled by whole-stage codegen and unused
fields are pruned by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.text import jvm_split

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# Combined access-log line: ip (optional), client, user, [date time],
# "request", status (3 digits), bytes, "referer", "agent"; one space between
# fields; the whole line must match.
IP_FRAGMENT = r"(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})?"
LOG_PATTERN = (
    "^" + IP_FRAGMENT + r' (\S+) (\S+) (\[.+?\]) "(.*?)" (\d{3}) (\S+) "(.*?)" "(.*?)"\z'
)
# Date inside the brackets: text up to the first space, zone ignored.
DATE_PATTERN = r"\[(.*?) .+]"
DATE_FORMAT = "dd/MMM/yyyy:HH:mm:ss"
# Default texts for lines that do not match.
UNMATCHED_REQUEST = "()"       # value of an if-without-else, as printed
URL_ERROR = "[error]"          # URL rule could not find a URL
RECORD_ERROR = "error"         # default row for an unparsable line
STATUS_ERROR = "[error]"       # status of an unparsable line
# Status classes.
SUCCESS, FAILURE, OTHER = "Success", "Failure", "Other"
# ---------------------------------------------------------------------------

FIELDS = ("ip", "client", "user", "date_time", "request", "status", "bytes",
          "referer", "agent")


def matches(line: Column | str) -> Column:
    """True when the whole line is an access-log line."""
    return F.col(line).rlike(LOG_PATTERN) if isinstance(line, str) else line.rlike(LOG_PATTERN)


def _c(line):
    return F.col(line) if isinstance(line, str) else line


def group(line: Column | str, name: str) -> Column:
    """One field of the line ('' when the line does not match).

    The optional ip comes back as null when absent, as a missing group does
    in the JVM.
    """
    idx = FIELDS.index(name) + 1
    g = F.regexp_extract(_c(line), LOG_PATTERN, idx)
    if name == "ip":
        g = F.nullif(g, F.lit(""))
    return g


# Separator of the packed fields: a control character that lines do not hold
# (those that do take the slower way below).
_SEP = "\u001f"


def packed_fields(line: Column | str) -> Column:
    """The nine fields as an array, by one run of the regex: a replacement
    writes the groups with a separator, and a split takes them apart. Lines
    that do not match come back as an array of another size (or null). Use
    it in a projection of its own and read it with ``field``."""
    c = _c(line)
    written = F.regexp_replace(c, LOG_PATTERN, _SEP.join(f"${i + 1}" for i in range(len(FIELDS))))
    slow = F.when(c.rlike(LOG_PATTERN), F.array(*[F.regexp_extract(c, LOG_PATTERN, i + 1) for i in range(len(FIELDS))]))
    return F.when(F.contains(c, F.lit(_SEP)), slow).otherwise(F.split(written, _SEP, -1))


def is_packed(fields: Column | str) -> Column:
    """Whether ``packed_fields`` found a log line."""
    return F.coalesce(F.size(_c(fields)) == len(FIELDS), F.lit(False))


def field(fields: Column | str, name: str) -> Column:
    """One field of ``packed_fields``; a missing ip is null."""
    g = F.get(_c(fields), FIELDS.index(name))
    return F.nullif(g, F.lit("")) if name == "ip" else g


def url_strict(request: Column | str) -> Column:
    """Second token when the request has exactly three tokens, else '[error]'."""
    return url_strict_of_tokens(jvm_split(_c(request)))


def url_lenient(request: Column | str) -> Column:
    """Second token when present, else '[error]'."""
    return url_lenient_of_tokens(jvm_split(_c(request)))


# The rules on an already split request.  Operators split in a projection
# of its own, so the tokens (and the regex under them) are computed once
# per row: Catalyst does not merge a projection whose costly output is
# used more than once into the next one.
def url_strict_of_tokens(toks: Column | str) -> Column:
    toks = _c(toks)
    return F.when(F.size(toks) == 3, F.get(toks, 1)).otherwise(F.lit(URL_ERROR))


def url_lenient_of_tokens(toks: Column | str) -> Column:
    return F.coalesce(F.get(_c(toks), 1), F.lit(URL_ERROR))


def int_or_zero(s: Column | str) -> Column:
    """Integer value of a text, 0 when it is not one."""
    return F.coalesce(_c(s).try_cast("int"), F.lit(0))


def status_class(status_text: Column | str) -> Column:
    code = int_or_zero(status_text)
    return (F.when((code >= 200) & (code < 300), F.lit(SUCCESS))
            .when((code >= 500) & (code < 600), F.lit(FAILURE))
            .otherwise(F.lit(OTHER)))


def _wall_clock(text: Column, fmt: str) -> Column:
    """The instant of a text with an offset, as its UTC wall clock."""
    from tidewater.operators.windows import from_micros
    return from_micros(F.unix_micros(F.try_to_timestamp(text, F.lit(fmt))))


def log_time(date_field: Column | str) -> Column:
    """Timestamp (without zone) of a '[dd/MMM/yyyy:HH:mm:ss zone]' field.

    The zone is ignored, as in the reference; unparsable dates are null.
    The wall clock is read as UTC's, so the session zone and its clock
    changes do not matter.
    """
    inner = F.regexp_extract(_c(date_field), DATE_PATTERN, 1)
    return _wall_clock(F.concat(inner, F.lit(" +0000")), DATE_FORMAT + " Z")


def log_time_with_offset(date_field: Column | str) -> Column:
    """As ``log_time`` but honouring the numeric offset (result in UTC)."""
    return _wall_clock(F.regexp_extract(_c(date_field), r"\[(.*?)\]", 1), DATE_FORMAT + " Z")
