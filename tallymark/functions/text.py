"""Text expressions: codes, TSV escaping, normalisation, target keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark import contract as C

NULL_MARK = "\\N"


def target_key(*parts: tuple[str, Column]) -> Column:
    """``COUPON:7|MEMBER:9`` from (("COUPON", c1), ("MEMBER", c2))."""
    pieces = [F.concat(F.lit(f"{name}:"), value.cast("string")) for name, value in parts]
    return pieces[0] if len(pieces) == 1 else F.concat_ws("|", *pieces)


def issue_code(number: Column) -> Column:
    """Positive id -> CP + 14 base-32 digits, alphabet without I, L, O, U."""
    digits = F.translate(
        F.conv(number.cast("string"), 10, 32), "IJKLMNOPQRSTUV", "JKMNPQRSTVWXYZ"
    )
    return F.concat(F.lit(C.CODE_PREFIX), F.lpad(digits, C.CODE_DIGITS, "0"))


def normalize_email(value: Column) -> Column:
    """Strip white space of any script at both ends, then lower-case."""
    return F.lower(F.regexp_replace(value, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))


def normalize_phone(value: Column) -> Column:
    """Decimal digits only, of any script."""
    return F.regexp_replace(value, r"\P{Nd}", "")


def escape_tsv(value: Column) -> Column:
    out = value
    for raw, coded in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(raw), F.lit(coded))
    return out


def unescape_tsv(value: Column) -> Column:
    """Inverse of escape_tsv; an escaped backslash must not start a new escape.

    Splitting at escaped backslashes leaves pieces in which every remaining
    backslash starts a real escape.
    """
    pieces = F.transform(
        F.split(value, r"\\\\"),
        lambda p: F.replace(
            F.replace(F.replace(p, F.lit("\\t"), F.lit("\t")), F.lit("\\n"), F.lit("\n")),
            F.lit("\\r"),
            F.lit("\r"),
        ),
    )
    return F.array_join(pieces, "\\")
