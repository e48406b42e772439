"""Column-expression helpers (JVM-side, inside whole-stage codegen)."""

from affinity.functions.numeric import (  # noqa: F401
    half_down, safe_ratio, significance_weight, stable, out, truncate_int,
)
from affinity.functions.text import sentence, tokens, distinct_tokens  # noqa: F401
from affinity.functions.shape import joined, joined_in_order  # noqa: F401
