"""Redaction of secrets in a text column, with built-in functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of secrets.
NAMES = ("access_token", "api_key", "apikey", "auth_token", "client_secret", "passwd", "password", "secret", "securitytoken", "token")
LEAST_LITERAL = 12


#: What ends a bare value: white space, the next parameter of a query string, and closing marks.
ENDS = r"\s&\"'<>\])"


def redact(text: Column, literals: tuple[str, ...] = ()) -> Column:
    """Values of secrets as ``***``; NULL stays NULL.

    A secret's name may be followed by ``=`` and a bare value, by ``=`` or ``:`` and a value in double quotes, or be quoted
    itself, as a key before ``:`` and a quoted value. Literal values of 12 characters or more go wherever they stand.
    """
    for short in (x for x in literals if len(x) < LEAST_LITERAL):
        raise ValueError(f"a literal of {len(short)} characters is too short to redact")
    name = "(" + "|".join(NAMES) + ")"
    forms = [(rf'\b{name}(\s*[=:]\s*)"[^"]*"', '$1$2"***"')]
    forms += [(f"{q}{name}{q}(\\s*:\\s*){v}[^{v}]*{v}", f"{q}$1{q}$2{v}***{v}") for q in "\"'" for v in "\"'"]
    forms += [(rf"\b{name}=[^{ENDS}]+", "$1=***")]
    out = reduce(lambda c, form: F.regexp_replace(c, "(?i)" + form[0], form[1]), forms, text)
    return reduce(lambda c, x: F.replace(c, F.lit(x), F.lit("***")), literals, out)
