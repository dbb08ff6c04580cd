"""Column expressions the operators share. All of them stay inside generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_schema(schema: T.StructType | str) -> T.StructType:
    """A schema given as such or written as ``name type, ...``; the latter needs a running session."""
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def trimmed(df: DataFrame, name: str) -> Column:
    """The column as a join key: text without surrounding blanks, any other type unchanged."""
    is_text = isinstance(df.schema[name].dataType, (T.StringType, T.VarcharType, T.CharType))
    return F.trim(F.col(name)) if is_text else F.col(name)


# The shape of every text that can be a whole number, a decimal number or a date. A text of that shape
# may still not fit, by its size or by the calendar.
_BLANK = r"[\x00-\x20\x7f]*"
_WHOLE = rf"^{_BLANK}[+-]?[0-9]+{_BLANK}$"
_DECIMAL = rf"^{_BLANK}[+-]?[\p{{Nd}}.][\p{{Nd}}.eE+-]*{_BLANK}$"
_DATE = rf"^{_BLANK}[+-]?[0-9]{{4,7}}(-[0-9]{{1,2}}(-[0-9]{{1,2}}([T ].*)?)?)?{_BLANK}$"


def typed(c: Column | str, data_type: T.DataType) -> Column:
    """The text as the given type, null where it does not fit.

    Spark raises and catches an error for every text that ``try_cast`` refuses, which costs far more
    than the cast. Texts of a shape that cannot fit are therefore kept from it.
    """
    c = as_column(c)
    cast = c.try_cast(data_type)
    if isinstance(data_type, T.IntegralType):
        return F.when(c.rlike(_WHOLE), cast)
    if isinstance(data_type, T.DecimalType):
        return F.when(c.rlike(_DECIMAL), cast)
    if isinstance(data_type, T.DateType):
        return F.when(c.rlike(_DATE), cast)
    return cast


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(as_column(c), F.lit(""))


def _lookup(c: Column, mapping: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), c)


def remapped(c: Column | str, mapping: Mapping[str, str], trim: bool = True) -> Column:
    """The canonical form of a listed value; every other value, null included, stays as it is."""
    c = as_column(c)
    return F.coalesce(_lookup(F.trim(c) if trim else c, mapping), c)


def decoded(c: Column | str, labels: Mapping[str, str], default: str | None = "") -> Column:
    """The label of a code; ``default`` for a code that is unknown or null."""
    return F.coalesce(_lookup(as_column(c), labels), F.lit(default))


def split_code(code: Column | str, value: str, measure: Column | str, limit: float, low: str, high: str) -> Column:
    """Split one code in two by a measure; a null measure keeps the code."""
    code, measure = as_column(code), as_column(measure)
    return (
        F.when((code == value) & (measure <= limit), low)
        .when((code == value) & (measure > limit), high)
        .otherwise(code)
    )


def joined_when(condition: Column, separator: str, parts: Sequence[str], otherwise: Column | str) -> Column:
    """The joined parts where the condition holds. Null parts are left out, as ``concat_ws`` does."""
    return F.when(condition, F.concat_ws(separator, *parts)).otherwise(as_column(otherwise))


def in_list(c: Column, patterns: Sequence[str]) -> Column:
    """True where a text matches one of the patterns.

    A pattern with ``%`` is matched as ``like`` on the text as it is; one without is compared with
    the trimmed text.
    """
    exact = [p for p in patterns if "%" not in p]
    tests = [c.like(p) for p in patterns if "%" in p]
    if exact:
        tests.append(F.trim(c).isin(exact))
    return reduce(lambda a, b: a | b, tests)


def null_safe_equal(pairs: Sequence[tuple[str, str]]) -> Column:
    """Equality of column pairs in which null matches null. Spark still plans an equi-join for it."""
    return reduce(lambda a, b: a & b, [F.col(left).eqNullSafe(F.col(right)) for left, right in pairs])


def row_hash(df: DataFrame) -> Column:
    """A repeatable number per row, used to break ties and to spread rows. Unlike a random number it
    is the same when a lost task runs again."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
