"""The call graph from bronze rows to gold, as lazily built DataFrames.

Order kept from the model dependencies:
final -> id map -> keyed -> {lookup, registry} -> {current, first seen}
-> history -> scd2 -> {obtained, upgrades} -> gold.
Each attribute is built on first use; nothing is collected.

With ``materialize=True`` the layers everything else reads (classified and keyed
rows, the snapshot sequence and history) are written once as parquet into the shared folder
of ``spark.checkpoint.dir``: later plans start from those files and read only
the columns they need, and a lost executor recomputes from there.

``known_at`` leaves out what was ingested after that time: the layers as they
were known then.  (``history.valid_at`` asks the other question: which versions
are in effect at a time, by what is known now.)
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import events, history, identity, quality, registry, rollup
from tidemark.schema import STAGED_COLUMNS
from tidemark.session import write_layer


class Silver:
    """Lazily built layers over one bronze DataFrame (first-run semantics)."""

    def __init__(self, bronze: DataFrame, tiebreak: str | None = None, materialize: bool = False, known_at: Column | None = None):
        self.bronze = bronze if known_at is None else bronze.where(F.col("snapshot_ts") <= known_at)
        self.tiebreak = tiebreak
        self.materialize = materialize

    def _cut(self, df: DataFrame, name: str) -> DataFrame:
        return write_layer(df.sparkSession, df, name) if self.materialize else df

    @cached_property
    def staged(self) -> DataFrame:
        keep = [self.tiebreak] if self.tiebreak else []
        return quality.stage(self.bronze, keep=keep)

    @cached_property
    def classified(self) -> DataFrame:
        return self._cut(quality.classify(self.staged), "classified")

    @cached_property
    def quarantine(self) -> DataFrame:
        return quality.quarantined(self.classified)

    @cached_property
    def ranked(self) -> DataFrame:
        return quality.rank_duplicates(quality.valid(self.classified), order=quality.dedupe_order(self.tiebreak))

    @cached_property
    def final(self) -> DataFrame:
        winners = quality.dedupe_winners(quality.valid(self.classified), order=quality.dedupe_order(self.tiebreak))
        return winners.select(*STAGED_COLUMNS)

    @cached_property
    def losers(self) -> DataFrame:
        return quality.dedupe_losers(self.ranked)

    @cached_property
    def id_map(self) -> DataFrame:
        return identity.type_id_map(self.final)

    @cached_property
    def keyed(self) -> DataFrame:
        return self._cut(identity.attach_key(self.final, self.id_map), "keyed")

    @cached_property
    def lookup(self) -> DataFrame:
        return identity.type_lookup(self.keyed)

    @cached_property
    def registry(self) -> DataFrame:
        return registry.register_snapshots(self.keyed)

    @cached_property
    def current(self) -> DataFrame:
        return registry.current_state(self.keyed, self.registry)

    @cached_property
    def first_seen(self) -> DataFrame:
        return identity.first_seen(self.keyed, registry.with_effect(self.registry, self.sequence))

    @cached_property
    def sequence(self) -> DataFrame:
        return self._cut(registry.in_order_sequence(self.registry), "sequence")

    @cached_property
    def history(self) -> DataFrame:
        return self._cut(history.scd2_backfill(self.keyed, self.sequence), "history")

    @cached_property
    def scd2(self) -> DataFrame:
        return history.scd2_view(self.history)

    @cached_property
    def obtained(self) -> DataFrame:
        return events.first_version_events(self.scd2)

    @cached_property
    def upgrades(self) -> DataFrame:
        return events.upgrade_events(self.scd2)

    @cached_property
    def gold(self) -> DataFrame:
        return rollup.account_type_state(self.scd2, self.obtained, self.upgrades, self.first_seen, self.lookup)

    LAYERS = (
        "staged", "classified", "quarantine", "final", "losers", "id_map", "keyed", "lookup", "registry",
        "current", "first_seen", "history", "scd2", "obtained", "upgrades", "gold",
    )

    def register_views(self, prefix: str = "") -> list[str]:
        """Every layer as a temporary view (lazy: a view is its plan, run
        when read), so SQL users can query ``<prefix><layer>``."""
        names = []
        for layer in self.LAYERS:
            getattr(self, layer).createOrReplaceTempView(prefix + layer)
            names.append(prefix + layer)
        return names
