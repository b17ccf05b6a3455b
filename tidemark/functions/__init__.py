from tidemark.functions.expressions import (
    content_key,
    event_sort_key,
    inferred_number,
    row_changed,
    version_id,
)
from tidemark.functions.rules import DEFAULT_RULES, DomainRule, NullRule, RangeRule, ladder
from tidemark.functions.sequence import sequence_within

__all__ = [
    "content_key",
    "event_sort_key",
    "inferred_number",
    "row_changed",
    "version_id",
    "DEFAULT_RULES",
    "DomainRule",
    "NullRule",
    "RangeRule",
    "ladder",
    "sequence_within",
]
