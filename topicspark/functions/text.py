"""Column expressions for text handling (F1-F16 and the tokeniser).

All are built-in Spark expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token rule of the default TF-IDF vectoriser the search
# scores against (lowercase, runs of two or more word characters).
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
# Smoothed IDF of a term present in one of two documents: ln(3/2) + 1.
IDF_ONE_OF_TWO = math.log(3.0 / 2.0) + 1.0
# Placeholder keywords written on every loaded row.
PLACEHOLDER_KEYWORDS = ["kw1", "kw2", "kw3", "kw4", "kw5"]
# Fixed value: chunk text when a chunk has no summaries.
NO_SUMMARIES = "No summaries available"
# Fixed value: timestamp text format of load and update times.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Text formats of stored chunk summaries and keyword maps.
#   chunk text   = ' + ("\n" + "{id}. {summary}" + "\n" for each row in id order) + '
#   keyword map  = { + ("'{keyword}': [{id},{id}]" joined by ", ") + }
#   array text   = { + (values joined by ",") + }
CHUNK_QUOTE = "'"
LINE_BREAK = "\n"
ID_SEPARATOR = ". "
MAP_OPEN, MAP_CLOSE = "{", "}"
MAP_ITEM_SEPARATOR = ", "
MAP_KEY_QUOTE = "'"
MAP_KEY_END = ": ["
LIST_END = "]"
LIST_SEPARATOR = ","


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: Column | str) -> Column:
    """Lower-cased word tokens of two or more characters (array<string>)."""
    return F.regexp_extract_all(F.lower(col_(text)), F.lit(TOKEN_PATTERN), 0)


def value_counts(values: Column, value: str = "term", count: str = "cnt") -> Column:
    """array<struct<value, count>>: the distinct values of an array, in order,
    with the number of places that each has in it (sorted inside the row)."""
    first = lambda s: F.filter(  # noqa: E731  the first place of every value
        F.transform(s, lambda x, i: F.struct(x.alias("x"), i.alias("at"))),
        lambda x: (x["at"] == 0) | (F.get(s, x["at"] - 1) != x["x"]))
    counted = lambda s, f: F.transform(f, lambda x, i: F.struct(
        x["x"].alias(value), (F.coalesce(F.get(f, i + 1)["at"], F.size(s)) - x["at"]).cast("long").alias(count)))
    # Each inner array is named once, as the element of an array of one.
    return F.transform(F.array(F.array_sort(values)), lambda s: F.transform(F.array(first(s)), lambda f: counted(s, f))[0])[0]


def strip_ws(text: Column | str) -> Column:
    """Remove leading / trailing whitespace (spaces, tabs, CR, LF, FF)."""
    return F.regexp_replace(col_(text), r"^\s+|\s+$", "")


def normalize_line(text: Column | str) -> Column:
    """F8: lower-case and strip a summary line."""
    return strip_ws(F.lower(col_(text)))


def qa_text(question: Column | str, answer: Column | str) -> Column:
    """question, newline, answer (nulls read as empty)."""
    return F.concat(F.coalesce(col_(question), F.lit("")), F.lit("\n"),
                    F.coalesce(col_(answer), F.lit("")))


def split_getline(s: Column | str, sep: str = ",") -> Column:
    """split on one character like repeated getline: '' gives [], inner
    empty fields are kept, one trailing empty field is dropped."""
    s = col_(s)
    parts = F.split(s, F.lit(sep), -1)
    n = F.size(parts)
    trimmed = F.when(F.element_at(parts, -1) == F.lit(""),
                     F.slice(parts, 1, n - 1)).otherwise(parts)
    return F.when(s.isNull(), F.lit(None)).when(s == F.lit(""), F.array().cast("array<string>")).otherwise(trimmed)


def to_array_text(s: Column | str) -> Column:
    """comma list as an array value, and its text form ``{a,b}``."""
    return F.split(col_(s), ",")


def array_text(arr: Column | str) -> Column:
    return F.concat(F.lit(MAP_OPEN), F.array_join(col_(arr), LIST_SEPARATOR), F.lit(MAP_CLOSE))


def safe_cast(c: Column | str, to: str, default) -> Column:
    """cast with a default for null or failed casts."""
    return F.coalesce(col_(c).try_cast(to), F.lit(default).cast(to))


def parse_ts(c: Column | str) -> Column:
    """parse ``%Y-%m-%d %H:%M:%S`` text; null when it does not parse."""
    return F.try_to_timestamp(col_(c), F.lit(TS_FORMAT))


def format_ts(c: Column | str) -> Column:
    """timestamp as text at one-second precision."""
    return F.date_format(F.date_trunc("second", col_(c)), TS_FORMAT)


def epoch_to_ts(c: Column | str) -> Column:
    """epoch seconds to timestamp."""
    return F.timestamp_seconds(col_(c))


def row_id_of_line(line: Column | str) -> Column:
    """integer before the first '.', null when it is not one."""
    return F.split_part(col_(line), F.lit("."), F.lit(1)).try_cast("int")


def render_line(id_: Column | str, summary: Column | str) -> Column:
    """F11 (one line): ``{id}. {summary}`` with newlines made spaces."""
    return F.concat(col_(id_).cast("string"), F.lit(ID_SEPARATOR),
                    F.regexp_replace(F.coalesce(col_(summary), F.lit("")), "[\r\n]", " "))


def fold_lines(pairs: Column | str) -> Column:
    """array<struct<id, line>> in any order -> the stored chunk
    text: a single quote, then ``\\n{line}\\n`` per row in id order, then a
    single quote; an empty array gives the no-summary text."""
    arr = F.array_sort(col_(pairs))
    body = F.array_join(F.transform(arr, lambda p: F.concat(F.lit(LINE_BREAK), p["line"], F.lit(LINE_BREAK))), "")
    return F.when(F.size(arr) == 0, F.lit(NO_SUMMARIES)).otherwise(
        F.concat(F.lit(CHUNK_QUOTE), body, F.lit(CHUNK_QUOTE)))


def render_keyword_map(entries: Column | str) -> Column:
    """array<struct<keyword, ids>> -> ``{'kw': [1,2], ...}``, keys
    sorted; empty -> ``{}``."""
    arr = F.array_sort(col_(entries))
    items = F.transform(arr, lambda e: F.concat(
        F.lit(MAP_KEY_QUOTE), e["keyword"], F.lit(MAP_KEY_QUOTE + MAP_KEY_END),
        F.array_join(F.transform(e["ids"], lambda i: i.cast("string")), LIST_SEPARATOR), F.lit(LIST_END)))
    return F.concat(F.lit(MAP_OPEN), F.array_join(items, MAP_ITEM_SEPARATOR), F.lit(MAP_CLOSE))


def keyword_map_json(entries: Column | str) -> Column:
    """keyword map as JSON."""
    arr = F.array_sort(col_(entries))
    return F.to_json(F.map_from_entries(arr))


def summary_preview(summary: Column | str, n: int = 5, min_len: int = 10) -> Column:
    """first ``n`` lines longer than ``min_len`` characters (trimmed)."""
    lines = F.split(F.coalesce(col_(summary), F.lit("")), "\n")
    kept = F.filter(lines, lambda x: F.length(F.trim(x)) > min_len)
    return F.slice(kept, 1, n)


def thousands(n: Column | str) -> Column:
    """integer with thousands separators."""
    return F.format_number(col_(n), 0)


def reported_chunks(size: Column | str, n: int) -> Column:
    """F16: number of chunks of ``size`` rows at ``n`` per chunk."""
    return F.ceil(col_(size) / F.lit(n)).cast("long")
