"""The training-table build as layers; each layer is a lazy plan over the one before."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Collection
from dataclasses import dataclass
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from spellcast.config import FIXTURE_SETTINGS, Settings
from spellcast.operators import bronze, lookback, snapshots, spells
from spellcast.session import checkpointed
from spellcast.sources import io
from spellcast.sources.fixtures import BASE_TABLES, Fixtures


@dataclass(frozen=True)
class Sources:
    payments: DataFrame
    providers: DataFrame
    history: DataFrame
    interactions: DataFrame
    provider_map: DataFrame
    provider_flags: DataFrame

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str) -> Sources:
        # Orders and their customers are joined the same way at any size: a broadcast would pass them through
        # the driver while they look small, and leave payments to be dealt out by the day as well.
        fx = Fixtures(spark, sf_dir)
        merged = {name: ("orders", "customer") if "orders" in BASE_TABLES[name] else () for name in cls.__dataclass_fields__}
        return cls(**{name: fx.view(name, of) for name, of in merged.items()})

    @classmethod
    def fixture_versions(cls, spark: SparkSession, sf_dir: str) -> dict[str, str]:
        files = {t: io.files_version(spark, f"{sf_dir}/{t}.parquet") for name in cls.__dataclass_fields__ for t in BASE_TABLES[name]}
        return {name: ",".join(files[t] for t in BASE_TABLES[name]) for name in cls.__dataclass_fields__}


class TrainingTable:
    """Bronze, silver and gold layers of one run.

    ``paid_days`` (a calendar's worth of rows per provider), ``eligible`` and ``spells`` (one
    and a few rows per provider) are each read several times downstream, so they are
    materialised; the payments themselves are read three times in all; the snapshot rows are generated from the
    spells whenever they are needed and never stored on their own.
    """

    def __init__(
        self,
        sources: Sources,
        settings: Settings,
        materialise: Callable[[DataFrame], DataFrame] = checkpointed,
    ):
        self.src = sources
        self.settings = settings
        self.materialise = materialise

    def layer(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The rows of a layer that is read several times, stored."""
        return self.materialise(make())

    @cached_property
    def paid_days(self) -> DataFrame:
        return self.layer("paid_days", lambda: bronze.paid_days(self.src.payments, self.settings))

    @cached_property
    def eligible(self) -> DataFrame:
        s = self.src
        return self.layer(
            "eligible", lambda: bronze.eligible_providers(self.paid_days, s.providers, s.history, self.settings)
        )

    @cached_property
    def timeline(self) -> DataFrame:
        return spells.action_timeline(self.eligible, self.paid_days, self.src.history)

    @cached_property
    def optout_spells(self) -> DataFrame:
        return spells.optout_spells(spells.next_action(self.timeline), self.eligible, self.settings)

    @cached_property
    def spells(self) -> DataFrame:
        return self.layer(
            "spells", lambda: spells.all_spells(self.eligible, self.paid_days, self.src.history, self.settings)
        )

    @cached_property
    def gold(self) -> DataFrame:
        return snapshots.gold_spells(self.spells, self.settings)

    @cached_property
    def spans(self) -> DataFrame:
        return snapshots.spell_spans(self.spells, self.settings)

    @cached_property
    def rows(self) -> DataFrame:
        return self.rows_with(None)

    def rows_with(self, columns: Collection[str] | None) -> DataFrame:
        """The rows with no other payment and call sums than those named in ``columns`` (None: all)."""
        s = self.src
        return lookback.gold_training_row(
            self.spells, self.eligible, s.payments, s.history, s.interactions,
            s.provider_map, s.provider_flags, self.settings, self.spans, columns,
        )


# What each layer is made from: the layers before it and the source tables.
LAYERS = {
    "paid_days": ((), ("payments",)),
    "eligible": (("paid_days",), ("providers", "history")),
    "spells": (("eligible", "paid_days"), ("history",)),
    "rows": (("spells", "eligible"), ("payments", "history", "interactions", "provider_map", "provider_flags")),
}


def fingerprint(layer: str, settings: Settings, versions: dict[str, str]) -> str:
    """A digest of all that a layer depends on: settings, source versions, and the layers before it."""
    before, sources = LAYERS[layer]
    parts = [layer, repr(settings), *(f"{t}={versions[t]}" for t in sources), *(fingerprint(b, settings, versions) for b in before)]
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


class StoredTable(TrainingTable):
    """A training table whose layers lie under ``base``, each with a manifest of what it was made from.

    A layer whose manifest has the fingerprint of this run is read instead of built, so a run that
    failed goes on after its last complete layer, and a run on unchanged sources builds nothing. The
    manifest is written after the rows, so an incomplete layer is never taken for one.
    """

    def __init__(self, spark: SparkSession, sources: Sources, settings: Settings, versions: dict[str, str], base: str):
        super().__init__(sources, settings)
        self.spark, self.versions, self.base = spark, versions, base.rstrip("/")
        self.built: list[str] = []
        self.reused: list[str] = []

    def manifest(self, name: str) -> dict:
        try:
            return io.read_json(self.spark, f"{self.base}/manifest/{name}")
        except (AnalysisException, FileNotFoundError):  # not there yet
            return {}

    def layer(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        mark = fingerprint(name, self.settings, self.versions)
        known = self.manifest(name)
        if known.get("fingerprint") == mark:
            self.reused.append(name)
            return self.spark.read.parquet(known["path"])
        path = f"{self.base}/{name}/{mark[:16]}_{uuid.uuid4().hex[:8]}"
        make().write.parquet(path)
        rows = self.spark.read.parquet(path)
        io.write_json(self.spark, {"fingerprint": mark, "path": path, "rows": rows.count()}, f"{self.base}/manifest/{name}")
        if known.get("path"):
            io.delete_path(self.spark, known["path"])
        self.built.append(name)
        return rows

    @cached_property
    def rows(self) -> DataFrame:
        return self.layer("rows", lambda: TrainingTable.rows.func(self))


@dataclass(frozen=True)
class RunStatus:
    """How a run ended: a message as text (the error's, if it failed), and which layers it built or reused."""

    ok: bool
    message: str
    table: str | None
    n_rows: int | None
    built: tuple[str, ...]
    reused: tuple[str, ...]


def run_training_table(
    spark: SparkSession, sources: Sources, settings: Settings, versions: dict[str, str], base: str, target: str | None = None
) -> RunStatus:
    """Build the training table under ``base``, from where an earlier run stopped, and publish it as ``target``.

    ``versions`` names the state of each source table (a table version, or ``io.files_version``). A
    failure is returned with its text and leaves the complete layers and the former target.
    """
    table = StoredTable(spark, sources, settings, versions, base)
    try:
        rows = table.rows
        n = io.publish(rows, target, base) if target else rows.count()
    except Exception as e:
        return RunStatus(False, f"error: {e}", target, None, tuple(table.built), tuple(table.reused))
    return RunStatus(True, f"{n} rows for {target or base}", target, n, tuple(table.built), tuple(table.reused))


def fixture_table(spark: SparkSession, sf_dir: str) -> TrainingTable:
    return TrainingTable(Sources.from_fixtures(spark, sf_dir), FIXTURE_SETTINGS)
