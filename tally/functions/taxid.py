"""Company tax id (CNPJ) mod-11 check (op V1) as a native Column expression.

The weighted sums are unrolled into plain arithmetic over ``substring``; one
``transform`` over a one-element array binds the digit string, so it is
extracted once per row. No UDF. The expression is generated as SQL text from the weights and handed to
Spark in one piece (one driver round trip instead of hundreds of Column
calls); the text only names a column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mod-11 weights of the first and of the second check digit.
WEIGHTS_1 = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
WEIGHTS_2 = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def check_digit_sql(digits_sql: str, weights=WEIGHTS_1) -> str:
    """SQL text of the check digit over the first ``len(weights)`` digits.

    ``11 - (sum mod 11)``, where 10 and 11 become 0, written with a single
    reference to the sum: ``(11 - sum % 11) % 11 % 10``.
    """
    terms = " + ".join(
        f"try_cast(substring({digits_sql}, {i + 1}, 1) AS INT) * {w}"
        for i, w in enumerate(weights)
    )
    return f"((11 - (({terms}) % 11)) % 11 % 10)"


def check_digit(column: str, weights=WEIGHTS_1) -> Column:
    """Check digit of the digit string held in ``column``."""
    return F.expr(check_digit_sql(_quote(column), weights))


def cnpj_valid_sql(column_sql: str) -> str:
    """SQL text of the validity rule over a column (see :func:`cnpj_is_valid`).

    The digit string is bound once as a lambda variable
    (``transform(array(digits), d -> ...)``): the rule reads it ~30 times,
    and a bound variable keeps a predicate pushed below a computed column
    from copying that column's expression into every read.
    """
    shape = "(length(d) = 14 AND NOT (d RLIKE '^([0-9])\\\\1*$'))"
    c1 = check_digit_sql("d", WEIGHTS_1)
    c2 = check_digit_sql("d", WEIGHTS_2)
    ok = (f"{c1} = try_cast(substring(d, 13, 1) AS INT) AND "
          f"{c2} = try_cast(substring(d, 14, 1) AS INT)")
    body = f"CASE WHEN {shape} THEN ({ok}) END"
    digits = f"regexp_replace({column_sql}, '[^0-9]', '')"
    return f"coalesce(element_at(transform(array({digits}), d -> {body}), 1), false)"


def cnpj_is_valid(column: str) -> Column:
    """True when the column holds a valid 14-digit CNPJ (punctuation ignored).

    Rules: keep digits; exactly 14; not all the same digit; both check digits
    match. NULL or digit-free input is invalid (never NULL).
    """
    return F.expr(cnpj_valid_sql(_quote(column)))


def cnpj_from_key_sql(key_sql: str, spoil_sql: str | None = None) -> tuple[str, str, str]:
    """SQL text ``(d1, d2, formatted)`` for the tax id whose 12-digit base is
    an integer key, computed arithmetically (digit i = key div 10^(12-i) mod 10).

    ``formatted`` refers to columns ``_d1`` and ``_d2`` that the caller
    projects from the first two texts. ``spoil_sql`` (0 or 1 per row) is
    added to the second check digit to make some ids invalid on purpose.
    """
    digit = [f"(({key_sql} div {10 ** (11 - i)}) % 10)" for i in range(12)]
    s1 = " + ".join(f"{w} * {digit[i]}" for i, w in enumerate(WEIGHTS_1))
    d1 = f"((11 - (({s1}) % 11)) % 11 % 10)"
    s2 = " + ".join(f"{w} * {digit[i]}" for i, w in enumerate(WEIGHTS_2[:12]))
    d2 = f"((11 - (({s2} + {WEIGHTS_2[12]} * _d1) % 11)) % 11 % 10)"
    if spoil_sql:
        d2 = f"(({d2} + {spoil_sql}) % 10)"

    def part(div: int, mod: int, width: int) -> str:
        return f"lpad(CAST(({key_sql} div {div}) % {mod} AS STRING), {width}, '0')"

    fmt = (f"concat({part(10 ** 10, 100, 2)}, '.', {part(10 ** 7, 1000, 3)}, '.', "
           f"{part(10 ** 4, 1000, 3)}, '/', {part(1, 10000, 4)}, '-', "
           f"CAST(_d1 AS STRING), CAST(_d2 AS STRING))")
    return d1, d2, fmt


def format_cnpj_sql(digits_sql: str) -> str:
    """SQL text rendering 14 digits as ``NN.NNN.NNN/NNNN-NN``."""
    def s(p: int, n: int) -> str:
        return f"substring({digits_sql}, {p}, {n})"
    return (f"concat({s(1, 2)}, '.', {s(3, 3)}, '.', {s(6, 3)}, '/', {s(9, 4)}, '-', "
            f"{s(13, 2)})")
