"""Text helpers: JVM-compatible split, tokens, lengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def jvm_split(s: Column | str, sep: str = " ") -> Column:
    """``String.split(sep)`` of the JVM for a one-character separator.

    Trailing empty strings are dropped, leading and inner ones kept;
    ``""`` gives ``[""]`` and a text made only of separators gives ``[]``.
    Spark's ``split`` keeps trailing empties, so the trailing separators
    are trimmed first.
    """
    s = _c(s)
    if sep == " ":
        trimmed = F.rtrim(s)
    else:
        trimmed = F.regexp_replace(s, "(" + _quote(sep) + ")+$", "")
    return (F.when((F.length(s) > 0) & (trimmed == ""), F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, _quote(sep))))


def _quote(sep: str) -> str:
    return "\\" + sep if sep in ".$|()[]{}^?*+\\" else sep


def lines(text: Column | str) -> Column:
    """Lines of a text as a text-file reader gives them.

    Breaks are LF, CR or CRLF; one final break does not open an empty line
    and an empty text has no lines.  CRLF and then lone CR are rewritten to
    LF with literal replaces (the same breaks a left-to-right ``CRLF|CR|LF``
    match finds), so the split is on one plain character, which the JVM
    does without a regex engine.
    """
    t = _c(text)
    norm = F.replace(F.replace(t, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    body = F.when(norm.endswith("\n"), norm.substr(F.lit(1), F.length(norm) - 1)).otherwise(norm)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n"))


def utf16_length(s: Column | str) -> Column:
    """Length in UTF-16 code units (the JVM's ``String.length``)."""
    return (F.octet_length(F.encode(_c(s), "UTF-16BE")) / 2).cast("bigint")


def is_hashtag(word: Column | str) -> Column:
    return _c(word).startswith("#")
