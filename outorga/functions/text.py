"""Text cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outorga import fixed


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def on_text_columns(df: DataFrame, fn, columns: list[str] | None = None) -> DataFrame:
    """Apply ``fn`` to the named (default: all text) columns in one projection."""
    chosen = set(text_columns(df) if columns is None else columns)
    return df.select(*[fn(F.col(c)).alias(c) if c in chosen else F.col(c) for c in df.columns])


NULL_TOKEN_LIST = ", ".join(f"'{token}'" for token in fixed.NULL_TOKENS)


def null_tokens(df: DataFrame) -> DataFrame:
    """Turn the null tokens of every text column into null."""
    chosen = set(text_columns(df))
    return df.selectExpr(*[
        f"case when `{c}` not in ({NULL_TOKEN_LIST}) then `{c}` end as `{c}`" if c in chosen else f"`{c}`"
        for c in df.columns])


def strip(c: Column) -> Column:
    """Trim both ends, Unicode spaces included (plain ``trim`` takes blanks only).

    A trim by a list of characters looks each character up in it. A text that begins and ends with a visible ASCII
    character has nothing to trim, which its first and last byte tell."""
    last = F.substring(c.cast("binary"), -1, 1)
    plain = (c >= "!") & (c < "\x80") & (last > F.lit(b" ")) & (last < F.lit(b"\x80"))
    return F.when(plain, c).otherwise(F.trim(c, F.lit(fixed.WHITESPACE)))


def without_tilde_no(c: Column) -> Column:
    return F.when(F.upper(c) == "NÃO", fixed.NO).otherwise(c)


def is_number_text(c: Column) -> Column:
    """True for a non-empty run of numerals of any script; false for null."""
    return F.coalesce(c.rlike(r"^\p{N}+$"), F.lit(False))


def starts_with_any(c: Column, *prefixes: str) -> Column:
    return _any(F.lower(c).startswith(p) for p in prefixes)


def contains_any(c: Column, *parts: str) -> Column:
    return _any(F.lower(c).contains(p) for p in parts)


def ends_with_any(c: Column, *suffixes: str) -> Column:
    return _any(F.lower(c).endswith(s) for s in suffixes)


def _any(tests) -> Column:
    result = F.lit(False)
    for test in tests:
        result = result | F.coalesce(test, F.lit(False))
    return result


def equals_ignoring_case(c: Column, text: str) -> Column:
    return F.lower(c) == text.lower()


def yes_no(test: Column) -> Column:
    return F.when(test, fixed.YES).otherwise(fixed.NO)


def flag_label(c: Column) -> Column:
    """'1' -> SIM, '0' -> NAO, anything else as it is."""
    return F.when(c == "1", fixed.YES).when(c == "0", fixed.NO).otherwise(c)


def padded_label(number: Column, year: Column) -> Column:
    return F.concat_ws(" ", F.lpad(number.cast("string"), 2, "0"), year.cast("string"))
