"""Text helpers for feed entries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the separator the reference splits each category element on.
CATEGORY_SEPARATOR = " / "
# Fixed value: the name of the last folder of a path. Read from the start and without giving characters back: a pattern that may begin
# anywhere tries every character of every folder name again, which costs more per row than parsing its entry.
_FOLDER = r"(?s)^(?:.*/)?([^/]++)/[^/]++$"


def default_fill(col) -> Column:
    """A missing element becomes '' (the reference's ``el.get(name, '')``)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(""))


def split_categories(col) -> Column:
    """ARRAY of category elements -> one flat ARRAY of names, each element split on ' / '.
    Empty pieces are kept, as Python's str.split keeps them."""
    c = F.col(col) if isinstance(col, str) else col
    return F.flatten(F.transform(c, lambda e: F.split(F.coalesce(e, F.lit("")), CATEGORY_SEPARATOR, -1)))


def source_from_path(col) -> Column:
    """The source is the name of the folder that holds the feed file. A Hive-style folder
    ``source=<name>`` (as written by a partitioned writer) gives ``<name>``.

    The file path of the metadata is a URI, so blanks, percent signs and other characters in it are
    percent-encoded and are decoded here; a plus sign stands for itself. A partitioned writer escapes
    some characters in folder names as well; these are decoded a second time, as its reader does."""
    c = F.col(col) if isinstance(col, str) else col
    decoded = F.try_url_decode(F.replace(F.regexp_extract(c, _FOLDER, 1), F.lit("+"), F.lit("%2B")))
    written = F.try_url_decode(F.replace(F.regexp_replace(decoded, r"^source=", ""), F.lit("+"), F.lit("%2B")))
    return F.when(F.startswith(decoded, F.lit("source=")), written).otherwise(decoded)
