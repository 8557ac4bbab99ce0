"""Text clean-up and host expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from exposure.schemas import ANSI_PATTERN

# Every character that counts as white space in Unicode text; F.trim would strip blanks only.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def has_text(text: Column) -> Column:
    """Any character that is no white space."""
    return text.rlike(f"[^{WHITESPACE}]")


def not_blank(text: Column) -> Column:
    """``has_text`` for columns read from files: a comparison of bytes settles almost every line.

    Blanks aside, a line that starts with a printable ASCII character is not blank. The input is
    used more than once, so do not stack this on an expensive expression.
    """
    start = F.ltrim(text)
    return ((start >= "!") & (start < "\x7f")) | has_text(text)


def without_ansi(text: Column) -> Column:
    """Drop terminal escape sequences."""
    return F.regexp_replace(text, ANSI_PATTERN, "")


def authority(text: Column) -> Column:
    """The authority of a lower-case http(s) URL; any other text is returned unchanged."""
    return F.when(
        text.rlike("^https?://"), F.regexp_extract(text, "^https?://([^/?#]*)", 1)
    ).otherwise(text)


def host_key(text: Column) -> Column:
    """What a host line and a probe line of the same host have in common."""
    return F.regexp_replace(authority(text), r"^[^@]*@|:\d+$", "")


def probe_target(line: Column) -> Column:
    """The target a probe line starts with, before its bracketed fields."""
    return F.substring_index(line, " ", 1)


def valid_host(text: Column) -> Column:
    """Dot-separated labels of 1-63 letters, digits and inner hyphens under a letters-only TLD.

    Written as separate linear tests so that hostile input cannot make the regex engine recurse.
    """
    host = authority(text)
    return F.coalesce(
        host.rlike(r"\A[A-Za-z0-9.-]+\z")
        & host.rlike(r"[A-Za-z0-9]\.[A-Za-z]{2,}\z")
        & ~host.rlike(r"\A[.-]|-\.|\.[.-]")
        & ~host.rlike(r"[A-Za-z0-9-]{64}\."),
        F.lit(False),
    )


def title_label(name: Column) -> Column:
    """``alive_check`` -> ``Alive Check``."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def title_status(status: Column) -> Column:
    """``in_progress`` -> ``In_Progress``: every word is capitalised, underscores stay."""
    return F.array_join(F.transform(F.split(status, "_"), F.initcap), "_")


def one_decimal(value: Column) -> Column:
    return F.round(value.cast("decimal(18,6)"), 1).cast("decimal(18,1)").cast("string")


def megabytes(size: Column) -> Column:
    """Bytes as MB of 1,048,576 bytes."""
    return size / 1024 / 1024


def comma_list(text: Column) -> Column:
    return F.transform(F.split(text, ","), stripped)
