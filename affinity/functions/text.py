"""Text helpers: item sentences and tokens.

Fixed values: the token pattern and the minimum token length below.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens are runs between matches of this pattern, lower-cased,
# at least two characters long.
TOKEN_PATTERN = r"[^\p{L}\w\d]+"
MIN_TOKEN_LENGTH = 2
# Fixed value: blanks and control characters are cut off around attributes.
EDGE = "".join(map(chr, range(33)))


def sentence(attrs: Sequence[str | Column]) -> Column:
    """Lower-cased attributes, trimmed of blanks and control characters, joined by blanks; NULL attributes skipped."""
    cols = [F.lower(F.btrim(F.col(a) if isinstance(a, str) else a, F.lit(EDGE))) for a in attrs]
    return F.concat_ws(" ", *cols)


def tokens(text: str | Column) -> Column:
    """All tokens of a text, in order, with repeats."""
    t = F.col(text) if isinstance(text, str) else text
    parts = F.split(F.lower(t), TOKEN_PATTERN)
    return F.filter(parts, lambda w: F.length(w) >= MIN_TOKEN_LENGTH)


def distinct_tokens(text: str | Column) -> Column:
    """The set of tokens of a text, as an array."""
    return F.array_distinct(tokens(text))
