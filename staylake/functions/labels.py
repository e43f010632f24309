"""Attribution label parsing as column expressions.

A label such as ``k-inn_d-t_u-77_p-BC-12`` is a ``_``-separated list
of ``prefix-value`` segments. A segment without ``-`` is ignored, the prefix
ends at the first ``-`` (so ``p-BC-12`` has value ``BC-12``), and
when a prefix repeats, its last segment wins. Empty or missing labels give
null for every part.

Implementation: with a ``_`` put in front of the label, every segment starts
right after a ``_``, and a value can never contain ``_``. So a segment with
prefix ``k`` exists exactly when ``"_" + label`` contains ``"_k-"``, and the
last such segment's value is the text after the last ``"_k-"`` up to the next
``_``. Plain string functions, no arrays or lambdas, so the parse runs inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Device codes and their names; any other code passes through.
DEVICE_NAMES = {
    "m": "mobile",
    "d": "desktop",
    "t": "tablet",
}


def label_part(label: Column, prefix: str) -> Column:
    """Value of the last ``prefix-…`` segment, or null when there is none."""
    padded = F.concat(F.lit("_"), label)
    marker = f"_{prefix}-"
    after_last = F.substring_index(padded, marker, -1)
    return F.when(F.instr(padded, marker) > 0, F.substring_index(after_last, "_", 1))


def device_name(code: Column) -> Column:
    """Device code to name; unknown codes (and ``""``) pass through."""
    out = None
    for k, v in DEVICE_NAMES.items():
        out = F.when(code == k, F.lit(v)) if out is None else out.when(code == k, F.lit(v))
    return out.otherwise(code)


def attribution(label: Column) -> dict[str, Column]:
    """``site_key``, ``device`` and ``referral_property_id`` for a label column."""
    return {
        "site_key": F.upper(label_part(label, "k")),
        "device": device_name(label_part(label, "d")),
        "referral_property_id": label_part(label, "p"),
    }
