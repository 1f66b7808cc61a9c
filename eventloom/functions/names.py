"""Names and labels for fluents and actions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sanitize_name(name: Column) -> Column:
    """Lower-case name of letters, digits and single dashes that starts with a letter.

    camelCase is split; nothing left gives ``na``; a leading digit gets ``v-``.
    """
    split = F.regexp_replace(F.trim(name.cast("string")), "([a-z0-9])([A-Z])", "$1-$2")
    dashed = F.lower(F.trim(F.regexp_replace(split, "[^0-9a-zA-Z]+", "-"), F.lit("-")))
    return F.when(dashed == "", "na").when(dashed.rlike("^[a-z]"), dashed).otherwise(F.concat(F.lit("v-"), dashed))


def _six_digits(value: Column) -> Column:
    """At most six significant digits, without trailing zeros; exponent form outside 1e-4..1e6.

    Number patterns round the exact binary value; ``%e`` formats would round its
    shortest decimal text.
    """
    shown = F.call_function("format_number", value, F.lit("0.00000E0"))
    parts = F.split(shown, "E")
    mantissa, power = F.get(parts, F.lit(0)), F.get(parts, F.lit(1)).cast("int")

    def strip(text: Column) -> Column:
        return F.regexp_replace(text, r"\.?0+$", "")

    plain = strip(shown.cast("double").cast("decimal(20,10)").cast("string"))
    sign = F.when(power < 0, "-").otherwise("+")
    exponent = F.concat(F.lit("e"), sign, F.lpad(F.abs(power).cast("string"), 2, "0"))
    return F.when((power >= -4) & (power < 6), plain).otherwise(F.concat(strip(mantissa), exponent))


def category_label(value: Column, data_type: T.DataType) -> Column:
    """Readable text of a category: 3.0 is ``3``, other floats have six digits."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        number = value.cast("double")
        whole = number.try_cast("decimal(38,0)").cast("string")
        return F.when(number % 1 == 0, whole).otherwise(_six_digits(number))
    if isinstance(data_type, T.BooleanType):
        return F.initcap(value.cast("string"))
    return value.cast("string")
