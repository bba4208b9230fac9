"""URLs, archive paths and archive records, as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Public download host of the archives, header names of an archive record, and the
# number in the name of an extract file.
ARCHIVE_HOST = "https://data.commoncrawl.org"
VERSION_TOKEN = "WARC/"
VERSION_LINE = VERSION_TOKEN + "1.0"
URI_HEADER = "WARC-Target-URI"
EXTRACT_NUMBER = r"Multi(-?\d+)\.txt$"
# The folder that our own text extracts of a batch are written to.
BATCH_FOLDER = r"/batch=(\d+)/[^/]*$"

_BEFORE_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?"
_HOST = _BEFORE_HOST + r"([^/:?#]+)"


def host_key(name: Column) -> Column:
    """A host with its labels in reverse order and a dot at the end, so that a domain is a prefix of its subdomains."""
    return F.concat(F.array_join(F.reverse(F.split(F.lower(name), r"\.")), "."), F.lit("."))


def host(url: Column) -> Column:
    """Lowercase host of a URL, '' where there is none."""
    return F.lower(F.regexp_extract(url, _HOST, 1))


def in_domain(url: Column, domain: str) -> Column:
    """True for the domain itself and each of its subdomains, in one pass over the URL."""
    return F.coalesce(url.rlike(rf"(?i){_BEFORE_HOST}(?:[^/:?#]*\.)?{re.escape(domain)}(?:[/:?#]|$)"), F.lit(False))


def mentions(uri: Column, word: str) -> Column:
    """True where the URI contains the word anywhere, be it in a path or query string."""
    return uri.contains(word)


def wet_url(filename: Column, prefix: str = ARCHIVE_HOST) -> Column:
    """Location of the extracted-text archive that belongs to a raw archive."""
    parts = F.transform(
        F.split(filename, "/"), lambda part, i: F.when(i == 4, F.lit("wet")).otherwise(part)
    )
    path = F.replace(F.array_join(parts, "/"), F.lit("warc.gz"), F.lit("warc.wet.gz"))
    return F.concat(F.lit(prefix.rstrip("/") + "/"), path)


def wet_name(location: Column) -> Column:
    """Base name of an extracted-text archive: what stands between `wet/` and a final `wet.gz`."""
    return F.regexp_extract(location, r"wet/([^/]*)wet\.gz$", 1)


def plain_path(location: Column, encoded: bool = False) -> Column:
    """A location without its scheme; `encoded` ones (as Spark reports read files) are decoded first."""
    if encoded:
        location = F.url_decode(F.replace(location, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(location, r"^[A-Za-z][A-Za-z0-9+.-]*:(?://)?", "")


def extract_number(path: Column) -> Column:
    """The number in an extract file's name or of its batch folder, null where it has none."""
    named, batch = (F.regexp_extract(path, pattern, 1).try_cast("bigint") for pattern in (EXTRACT_NUMBER, BATCH_FOLDER))
    return F.coalesce(named, batch)


NEWLINE = r"(?:\r\n|\n|\r(?!\n))"
# The version line of a record, of any version, with or without the token that records are cut at.
VERSION = rf"(?:{VERSION_TOKEN})?[0-9]+\.[0-9]+[ \t]*"
# The end of a line and an empty line, whichever newline the file has.
BLANK_LINE = NEWLINE + "{2}"


def unify_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def starts_record(piece: Column) -> Column:
    """Whether a piece of an archive, cut at the version token, begins as a record does: version line, then a header."""
    return piece.rlike(rf"^{VERSION}{NEWLINE}[A-Za-z]")


def has_uri(raw: Column) -> Column:
    """Whether a raw record has a target URI among its headers, in one pass over these."""
    return raw.rlike(rf"^{NEWLINE}?(?:[^\r\n]+{NEWLINE})*?{URI_HEADER}:[ \t]*[^ \t\r\n]")


def target_uri(header: Column) -> Column:
    return F.trim(F.regexp_extract(header, rf"(?m)^{URI_HEADER}:[ \t]*([^\n]*)", 1))


def title_of(body: Column) -> Column:
    """First line of the extracted text."""
    return F.trim(F.substring_index(body, "\n", 1))


def text_of(body: Column) -> Column:
    """All lines of the extracted text, joined with a space."""
    return F.replace(body, F.lit("\n"), F.lit(" "))
