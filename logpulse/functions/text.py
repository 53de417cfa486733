"""Text helpers expressed as chained built-in regex functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logpulse.constants import HTML_BLANKS, HTML_BREAKS, HTML_TAG
from logpulse.functions.columns import col_


#: The characters that Python's str.strip() removes.
SPACES = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def html_to_text(html: str | Column) -> Column:
    """Plain-text fallback of an HTML body.

    Tags become a space, runs of spaces/tabs collapse to one space, three or
    more newlines collapse to a blank line, then white space (Unicode spaces
    included) is trimmed from the ends.
    """
    t = F.regexp_replace(col_(html), HTML_TAG, " ")
    t = F.regexp_replace(t, HTML_BLANKS, " ")
    t = F.regexp_replace(t, HTML_BREAKS, "\n\n")
    return F.regexp_replace(t, rf"\A[{SPACES}]+|[{SPACES}]+\z", "")


def repaired(text: str | Column) -> Column:
    """Text from bytes that may be damaged: every maximal part that is no UTF-8 becomes one
    U+FFFD, as Python's ``errors='replace'`` does it."""
    return F.make_valid_utf8(col_(text).cast("string"))
