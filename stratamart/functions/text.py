"""Text normalisation."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from stratamart.constants import NAME_DELIMITERS

_AFTER_DELIMITER = r"(?<=[\s" + re.escape(NAME_DELIMITERS) + "])"


def initcap_delimited(column: Column | str) -> Column:
    """Capitalise after whitespace and after any name delimiter.

    Spark's own ``initcap`` starts a word only after whitespace.
    """
    parts = F.split(F.lower(column), _AFTER_DELIMITER)
    return F.array_join(
        F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 2**31 - 1))),
        "",
    )


def full_name(first: Column | str, last: Column | str) -> Column:
    """First and last name with a blank between; NULL when either is missing."""
    return F.concat(F.col(first) if isinstance(first, str) else first, F.lit(" "),
                    F.col(last) if isinstance(last, str) else last)


def drop_prefix(text: Column, prefix: Column) -> Column:
    """``text`` without its first ``length(prefix)`` characters."""
    return F.substr(text, F.length(prefix) + 1)
