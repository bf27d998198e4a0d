"""Filter text such as ``(a="x" or with(b)) and c>3`` as a Spark Column.

OR binds tighter than AND. Strings stand in double quotes or back quotes, numbers are whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame

from flowloom.functions import predicates as P

_TOKEN = re.compile(r"""\s*(?:(?P<text>"(?:\\.|[^"\\])*"|`[^`]*`)|(?P<number>-?\d+(?![\w.]))|(?P<word>[A-Za-z_][\w.]*)|(?P<op>=~|!~|!=|<=|>=|[=<>()]))""")


def column_of(df: DataFrame, text: str) -> Column:
    """The predicate over df that the text states."""
    tokens, at = [], 0
    text = text.rstrip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"cannot read filter text at {text[at:]!r}")
        tokens.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    tokens.append(("end", ""))

    def take(*wanted: str) -> str:
        kind, value = tokens.pop(0)
        if wanted and value not in wanted:
            raise ValueError(f"expected {' or '.join(wanted)}, found {value!r}")
        return value

    def joined(word: str, part) -> Column:
        found = part()
        while tokens[0][0] == "word" and tokens[0][1].lower() == word:
            take()
            found = found & part() if word == "and" else found | part()
        return found

    def leaf() -> Column:
        kind, value = tokens.pop(0)
        if (kind, value) == ("op", "("):
            found = whole()
            take(")")
            return found
        if kind != "word":
            raise ValueError(f"expected a field, found {value!r}")
        if value.lower() in ("with", "without") and tokens[0] == ("op", "("):
            take("(")
            field = take()
            take(")")
            return P.present(df, field) if value.lower() == "with" else P.absent(df, field)
        op, (kind, literal) = take("=", "!=", "<", ">", "<=", ">=", "=~", "!~"), tokens.pop(0)
        if kind == "number" and op not in ("=~", "!~"):
            return P.compare(df, value, op, int(literal))
        if kind != "text" or op in ("<", ">", "<=", ">="):
            raise ValueError(f"{op} cannot be followed by {literal!r}")
        literal = literal[1:-1] if literal[0] == "`" else re.sub(r"\\(.)", r"\1", literal[1:-1])
        return {"=": P.equal, "!=": P.not_equal, "=~": P.matches, "!~": P.not_matches}[op](df, value, literal)

    def whole() -> Column:
        return joined("and", lambda: joined("or", leaf))

    found = whole()
    take("")
    return found


def filter_query(df: DataFrame, text: str) -> DataFrame:
    """df's rows for which the text holds."""
    return df.filter(column_of(df, text))
