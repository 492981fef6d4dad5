"""Expressions that read delimited text: delimiter, records, fields, names, value kinds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Delimiters in order of preference when several would do.
PREFERRED_DELIMITERS = [",", "\t", ";", " ", ":"]

# Field texts read as null.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
]

INTEGER = "^\\s*[+-]?[0-9]+\\s*$"
FLOAT = "^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$"
INFINITE = "^\\s*[+-]?(?i:inf|infinity|nan)\\s*$"
BOOLEAN = "^(True|TRUE|true|False|FALSE|false)$"

LINE_END = "\r\n|\r|\n"

# A quoted span beside a character that could be the delimiter:
# between two of them, opening the line, closing the line.
QUOTED_BETWEEN = "(?U)([^\\w\\n\"'])( ?)([\"']).*?\\3\\1"
QUOTED_FIRST = "(?U)^([\"']).*?\\1([^\\w\\n\"'])( ?)"
QUOTED_LAST = "(?U)([^\\w\\n\"'])( ?)([\"']).*?\\3$"


def first_line(content: Column) -> Column:
    return F.get(F.split(content, LINE_END, 2), 0)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), 0)


def _most_frequent(values: Column, prefer_first: bool) -> Column:
    """Most frequent array member; ties go to the first seen or the highest."""

    def tally(bound: Column) -> Column:
        def tallied(value, position):
            order = -position if prefer_first else F.lit(0)
            return F.struct(F.size(F.filter(bound, lambda v: v == value)), order, value.alias("value"))

        return F.array_max(F.transform(F.array_distinct(bound), tallied))["value"]

    return bind(values, tally)


def sniff_delimiter(header: Column) -> Column:
    """The delimiter a header line suggests; null if none can be told.

    Characters beside quoted spans decide first. Else the first preferred
    delimiter present wins, else the most frequent ASCII character.
    """
    between = F.regexp_extract_all(header, F.lit(QUOTED_BETWEEN), F.lit(1))
    opening = F.regexp_extract_all(header, F.lit(QUOTED_FIRST), F.lit(2))
    closing = F.regexp_extract_all(header, F.lit(QUOTED_LAST), F.lit(1))
    beside = F.when(F.size(between) > 0, between).when(F.size(opening) > 0, opening).otherwise(closing)
    quoted = F.when(header.rlike("[\"']"), _most_frequent(beside, prefer_first=True))
    preferred = F.coalesce(*[F.when(F.contains(header, F.lit(d)), F.lit(d)) for d in PREFERRED_DELIMITERS])
    ascii_chars = F.filter(F.split(header, ""), lambda c: (c != "") & (F.ascii(c) < 127))
    return F.coalesce(quoted, preferred, _most_frequent(ascii_chars, prefer_first=False))


def line_delimiter_counts(line: Column, candidates: list[str]) -> Column:
    """``array<struct(delimiter, n)>`` of the candidates present in a line."""
    counted = [
        F.struct(
            F.lit(d).alias("delimiter"),
            (F.length(line) - F.length(F.replace(line, F.lit(d), F.lit("")))).alias("n"),
        )
        for d in candidates
    ]
    return F.filter(F.array(*counted), lambda c: c["n"] > 0)


def quote_regex(delimiter: Column) -> Column:
    """The delimiter as a regular expression for itself."""
    return F.when(delimiter.rlike("^[A-Za-z0-9 ]$"), delimiter).otherwise(F.concat(F.lit("\\"), delimiter))


# A quoted field up to its closing quote. Possessive loops run without recursion.
_QUOTED = '"[^"]*+(?:""[^"]*+)*+'


def split_records(body: Column, delimiter: Column) -> Column:
    """Records of a text; a line end inside a quoted field does not end the record.

    A closing quote followed by other text spoils the rest of its line.
    """
    d = quote_regex(delimiter)
    field = F.concat(
        F.lit(f'(?:{_QUOTED}"(?=['), d, F.lit(f'\\r\\n]|\\z)|{_QUOTED}"[^\\r\\n]*+|{_QUOTED}\\z|[^'), d, F.lit("\\r\\n]*+)")
    )
    pattern = F.concat(F.lit("("), field, F.lit("(?:"), d, field, F.lit(f")*+)(?:{LINE_END}|\\z)"))
    plain = F.when(F.contains(body, F.lit("\r")), F.split(body, LINE_END, -1)).otherwise(F.split(body, "\n", -1))
    return F.when(F.contains(body, F.lit('"')), F.regexp_extract_all(body, pattern, F.lit(1))).otherwise(plain)


def split_fields(record: Column, delimiter: Column) -> Column:
    """Raw fields of one record, quotes still on."""
    d = quote_regex(delimiter)
    pattern = F.concat(
        d, F.lit(f'({_QUOTED}"(?='), d, F.lit('|\\z)|"[\\s\\S]*+|[^'), d, F.lit("]*+)")
    )
    quoted = F.regexp_extract_all(F.concat(delimiter, record), pattern, F.lit(1))
    return F.when(F.contains(record, F.lit('"')), quoted).otherwise(F.split(record, d, -1))


def spoiled_field(field: Column, longest: int | None = None) -> Column:
    """A field that opens with a quote but does not close with one at its end, or has over ``longest`` characters."""
    open_ended = field.startswith('"') & ~field.rlike(f'\\A{_QUOTED}"\\z')
    return open_ended if longest is None else open_ended | (F.length(field) > longest)


def unquote(field: Column) -> Column:
    inner = F.substring(field, F.lit(2), F.greatest(F.length(field) - 2, F.lit(0)))
    return F.when(field.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(field)


def blank_record(fields: Column) -> Column:
    return (F.size(fields) == 1) & (F.trim(F.regexp_replace(fields[0], "\\s", " ")) == "")


def index_width(width: Column, first: Column, second: Column) -> Column:
    """Leading columns without a header, from the sizes of the first two records."""
    surplus = F.greatest(first - width, F.lit(0))
    return F.coalesce(F.when(second == first + width, first), surplus, F.lit(0))


def name_columns(fields: Column) -> Column:
    """Header names: empty ones become ``Unnamed: i``, repeats get ``.1``, ``.2``; no name occurs twice."""
    named = F.transform(fields, lambda f, i: F.when(f == "", F.concat(F.lit("Unnamed: "), i)).otherwise(f))

    def apart(names: Column) -> Column:
        return F.size(F.array_distinct(names)) == F.size(names)

    def once_numbered(names: Column) -> Column:
        # Equal names lie together once sorted, so a name's earlier takers are its distance from the first of them.
        def ranked(names: Column) -> Column:
            begins = F.transform(names, lambda e, j: F.when((j == 0) | ~e["name"].eqNullSafe(F.get(names, j - 1)["name"]), j))
            ends = lambda begins, g: F.coalesce(F.get(begins, g + 1), F.size(names))
            runs = lambda begins: F.flatten(F.transform(begins, lambda b, g: F.sequence(F.lit(0), ends(begins, g) - b - 1)))
            return bind(F.filter(begins, lambda b: b.isNotNull()), runs)

        def counted(names: Column) -> Column:
            name = lambda x, n: F.when((n > 0) & x.isNotNull(), F.concat_ws(".", x, n)).otherwise(x)
            takers = lambda ranks: F.transform(names, lambda e, j: F.struct(e["at"].alias("at"), name(e["name"], F.get(ranks, j)).alias("name")))
            return F.transform(F.sort_array(bind(ranked(names), takers)), lambda e: e["name"])

        return bind(F.sort_array(F.transform(names, lambda x, i: F.struct(x.alias("name"), i.alias("at")))), counted)

    # one number each is enough unless a header itself looks like a numbered name
    last = lambda names: bind(once_numbered(names), lambda once: F.when(apart(once), once).otherwise(numbered(names)))
    return bind(named, lambda names: F.when(apart(names), names).otherwise(last(names)))


def numbered(names: Column) -> Column:
    """Names in order; one that is taken gets its number of earlier takers, again and again until it is free.

    A name grows with every number, so it meets each earlier name once at most:
    as many steps as there are earlier names always suffice.
    """

    def free(taken: Column, name: Column) -> Column:
        def step(state: Column, _: Column) -> Column:
            at = F.array_position(taken["names"], state["name"]).cast("int")
            takers = F.get(state["takers"], at - 1)
            counted = F.transform(state["takers"], lambda n, i: F.when(i == at - 1, n + 1).otherwise(n))
            longer = F.struct(F.concat_ws(".", state["name"], takers).alias("name"), counted.alias("takers"))
            return F.when(at > 0, longer).otherwise(state)

        return F.aggregate(taken["names"], F.struct(name.alias("name"), taken["takers"].alias("takers")), step)

    def add(taken: Column, name: Column) -> Column:
        return bind(
            free(taken, name),
            lambda found: F.struct(
                F.concat(taken["names"], F.array(found["name"])).alias("names"), F.concat(found["takers"], F.array(F.lit(1))).alias("takers")
            ),
        )

    nothing = F.struct(F.array().cast("array<string>").alias("names"), F.array().cast("array<int>").alias("takers"))
    return F.aggregate(names, nothing, add, lambda taken: taken["names"])


def null_value(value: Column) -> Column:
    return value.isNull() | value.isin(NULL_TOKENS)


def value_kind(value: Column) -> Column:
    """One of null, int, negative, uint, wide (beyond 64 bits), float, bool, text."""
    number = F.trim(F.regexp_replace(value, "\\s", " "))
    as_long = number.try_cast("bigint")
    as_wide = number.try_cast("decimal(38,0)")
    whole = (
        F.when(as_long < 0, "negative")
        .when(as_long.isNotNull(), "int")
        .when(as_wide.between(F.lit(0).cast("decimal(38,0)"), F.lit("18446744073709551615").cast("decimal(38,0)")), "uint")
        .otherwise("wide")
    )
    return (
        F.when(null_value(value), "null")
        .when(value.rlike(INTEGER), whole)
        .when(value.rlike(FLOAT) | value.rlike(INFINITE), "float")
        .when(value.rlike(BOOLEAN), "bool")
        .otherwise("text")
    )
