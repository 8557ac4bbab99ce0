"""Version strings as tools print them and as releases are tagged."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from exposure.functions.text import stripped

# The shapes in which a version may appear, most specific first.
LABELLED_VERSION = r"(?i)Current Version:\s*v?(\d+\.\d+\.\d+)"
ANY_VERSION = r"v?(\d+\.\d+\.\d+)"


def version_from_text(text: Column) -> Column:
    """Labelled version, else the first x.y.z anywhere, else the first line as it is."""
    output = stripped(text)
    return F.coalesce(
        F.nullif(F.regexp_extract(output, LABELLED_VERSION, 1), F.lit("")),
        F.nullif(F.regexp_extract(output, ANY_VERSION, 1), F.lit("")),
        stripped(F.substring_index(output, "\n", 1)),
    )


def version_of_tag(tag: Column) -> Column:
    """A release tag without its leading ``v`` letters."""
    return F.ltrim(tag, F.lit("v"))


def short_commit(commit: Column) -> Column:
    return F.substring(commit, 1, 7)
