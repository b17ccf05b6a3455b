"""Quarantine rules as data, and the first-match ladder built from them.

A rule knows its column, its bucket and the condition under which a row fails.
``ladder`` turns an ordered rule list into one CASE expression that yields a
struct (reason, bucket), so reason and bucket can never disagree.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import ACCEPTED_CONTRACT_VERSIONS

# --- fixed values: buckets in precedence order and the reason prefix of each ---
BUCKETS = ("KEY", "LINEAGE", "MISSING_ATTR", "DOMAIN", "RANGE")
REASON_PREFIX = {
    "KEY": "KEY_NULL",
    "LINEAGE": "LINEAGE_NULL",
    "MISSING_ATTR": "ATTR_NULL",
    "DOMAIN": "DOMAIN",
    "RANGE": "RANGE",
}
DATA_BUCKETS = ("DOMAIN", "RANGE", "MISSING_ATTR")


@dataclass(frozen=True)
class Rule:
    column: str
    bucket: str

    @property
    def reason(self) -> str:
        return f"{REASON_PREFIX[self.bucket]}:{self.column}"

    def fails(self) -> Column:  # pragma: no cover - abstract
        raise NotImplementedError


@dataclass(frozen=True)
class NullRule(Rule):
    def fails(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class DomainRule(Rule):
    values: tuple = ()
    null_fails: bool = True

    def fails(self) -> Column:
        c = F.col(self.column)
        bad = ~c.isin(*self.values)
        return (c.isNull() | bad) if self.null_fails else bad


@dataclass(frozen=True)
class RangeRule(Rule):
    lo: float | None = None
    hi: float | None = None

    def fails(self) -> Column:
        c = F.col(self.column)
        cond = c.isNull()
        if self.lo is not None:
            cond = cond | (c < F.lit(self.lo))
        if self.hi is not None:
            cond = cond | (c > F.lit(self.hi))
        return cond


def _null(col: str, bucket: str) -> NullRule:
    return NullRule(col, bucket)


def _domain(col: str, values, null_fails: bool = True) -> DomainRule:
    return DomainRule(col, "DOMAIN", tuple(values), null_fails)


def _non_negative(col: str) -> RangeRule:
    return RangeRule(col, "RANGE", 0, None)


# --- fixed values: the default ladder, in evaluation order (34 rules) ---
DEFAULT_RULES: list[Rule] = [
    _null("account", "KEY"),
    _null("entity_id", "KEY"),
    _null("source_type_id", "KEY"),
    _null("source_file", "KEY"),
    _null("run_id", "LINEAGE"),
    _null("snapshot_ts", "LINEAGE"),
    _null("snapshot_date", "LINEAGE"),
    _null("schema_version", "LINEAGE"),
    _null("name", "MISSING_ATTR"),
    _domain("rank", range(1, 7)),
    _domain("empower_level", range(0, 5)),
    _domain("rarity", range(1, 7)),
    _domain("affinity", range(1, 5)),
    _domain("blessing_id", range(0, 7)),
    _domain("schema_version", ACCEPTED_CONTRACT_VERSIONS, null_fails=False),
    RangeRule("faction", "RANGE", 1, 18),
    _non_negative("level"),
    _non_negative("used_t1_scrolls"),
    _non_negative("unused_t1_scrolls"),
    _non_negative("used_t2_scrolls"),
    _non_negative("unused_t2_scrolls"),
    _non_negative("used_t3_scrolls"),
    _non_negative("unused_t3_scrolls"),
    _non_negative("hp"),
    _non_negative("atk"),
    _non_negative("def"),
    _non_negative("crit_rate"),
    _non_negative("crit_damage"),
    _non_negative("spd"),
    _non_negative("acc"),
    _non_negative("res"),
    _non_negative("blessing_grade"),
    _non_negative("books_missing"),
    _non_negative("snapshot_version"),
]


def ladder(rules: Sequence[Rule]) -> Column:
    """First failing rule wins: struct(reason, bucket), NULL when clean."""
    expr = None
    for rule in rules:
        hit = F.struct(F.lit(rule.reason).alias("reason"), F.lit(rule.bucket).alias("bucket"))
        expr = F.when(rule.fails(), hit) if expr is None else expr.when(rule.fails(), hit)
    return expr
