"""Text functions: cleaning, log patterns, labels from paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four kinds of payment log line that are kept, in matching order.
LOG_PATTERNS = {
    "auth_time": r"^(\S+) (\S+) (\S+) (\S+) : (\S+) -- (\S+) >>>> (\S+) >>>> (\S+)](\S+)$",
    "invoice_error": (
        r"^(\S+) (\S+) (\S+) (\S+) : (\S+) -- (\S+):(\S+),(\S+) (\S+) (\S+) (.*)"
        r"<response><head><errCode>([0-9]*)</errCode><errDesc>(.*): (\S+)$"
    ),
    "order_time": r"^(\S+) (\S+) (\S+) (\S+) : (\S+) -- (\S+):(\S+) (\S+) >>>> (\S+) >>>> (\S+)](\S+)$",
    "account_error": (
        r"^(\S+) (\S+) (\S+) (\S+) (\S+) : (\S+) -- (\S+):(\S+),(\S+) (\S+) (\S+) (.*)"
        r"<response><head><errCode>([0-9]*)</errCode><errDesc>(.*): (\S+)$"
    ),
}


def words(text: Column) -> Column:
    """Array of the words of a text over all its lines; adjacent blanks leave empty words."""
    return F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " ")


def remove_blanks(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def fill_empty_fields(line: Column, value: str = "0") -> Column:
    """Put ``value`` between any two adjacent commas."""
    once = F.replace(line, F.lit(",,"), F.lit(f",{value},"))
    return F.replace(once, F.lit(",,"), F.lit(f",{value},"))


def log_kind(line: Column) -> Column:
    """Name of the first log pattern the whole line matches, else NULL."""
    kind = F
    for name, pattern in LOG_PATTERNS.items():
        kind = kind.when(line.rlike(pattern), F.lit(name))
    return kind


def log_elapsed_ms(line: Column) -> Column:
    """Milliseconds in the ``>>>> Name >>>> [n]`` tail, NULL if absent."""
    return F.regexp_extract(line, r">>>> \S+ >>>> \[(\d+)\]", 1).try_cast("long")


def log_error_code(line: Column) -> Column:
    code = F.regexp_extract(line, r"<errCode>([0-9]*)</errCode>", 1)
    return F.when(code != "", code)


def parent_folder(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/[^/]*$", 1)


def label_from_path(path: Column, labels: dict[str, int]) -> Column:
    """Class id of the parent folder, NULL when the folder is not a known class."""
    pairs = [F.lit(x) for item in labels.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), parent_folder(path))
