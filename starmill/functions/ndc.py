"""Drug-code normalisation (FN-12)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Segment lengths of the three ten-digit layouts, and the number of the segment
# that gets a leading zero to reach the eleven-digit 5-4-2 layout.
TEN_DIGIT_LAYOUTS = (
    ((4, 4, 2), 0),
    ((5, 3, 2), 1),
    ((5, 4, 1), 2),
)


def _shape(code: Column) -> Column:
    """The text with every digit written as 9."""
    return F.translate(code, "012345678", "999999999")


def _layout_shape(lengths: tuple[int, ...]) -> str:
    return "-".join("9" * n for n in lengths)


def is_ndc(code: Column) -> Column:
    """Whether the text has one of the ten-digit layouts; NULL for NULL."""
    return _shape(code).isin([_layout_shape(lengths) for lengths, _ in TEN_DIGIT_LAYOUTS])


def format_ndc(code: Column) -> Column:
    """Ten-digit code with hyphens to eleven digits; NULL for any other text."""
    shape = _shape(code)
    result = F.lit(None).cast("string")
    for lengths, short in TEN_DIGIT_LAYOUTS:
        segments, start = [], 1
        for i, length in enumerate(lengths):
            if i == short:
                segments.append(F.lit("0"))
            segments.append(F.substring(code, start, length))
            start += length + 1
        result = F.when(shape == _layout_shape(lengths), F.concat(*segments)).otherwise(result)
    return result
