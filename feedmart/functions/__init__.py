"""Column expressions. All are built-in Spark functions, so they stay inside whole-stage codegen."""

from feedmart.functions.dates import (as_of_date, day_of_week, parse_pubdate, parse_pubdate_lenient,
                                      parse_pubdate_strict, previous_day, raw_to_date)
from feedmart.functions.text import default_fill, source_from_path, split_categories

__all__ = ["as_of_date", "day_of_week", "parse_pubdate", "parse_pubdate_lenient", "parse_pubdate_strict",
           "previous_day", "raw_to_date", "default_fill", "source_from_path", "split_categories"]
