"""The journal as versioned parquet folders and a manifest that says which of them count.

A run writes its rows once, to a folder of its own, partitioned by document class and company, and reads
nothing of the journal: what it deletes is noted, not rewritten. The rows of a company that
it clears are dropped from the manifest; the documents that it purges are kept as a list of
delete markers, which readers apply to folders older than the run. So a run's work is in proportion to what
it posts and purges, however long the journal is. ``compact`` merges what has piled up.

    data/run=<id>/doc_class=<class>/in_cod_empresa=<company>/   rows
    markers/run=<id>/                                           purged document numbers
    versions/<number>.json                                      manifests

Readers take the newest manifest, whose folders never change: they see the journal before or after
a run, never half of it. A run takes effect when its manifest gets the next number, which is
claimed by a rename that fails if the number is taken. The loser applies its change to the newer
manifest and tries the next number; since a change does not depend on what the journal held,
runs of several writers give the state of one order of them. The file system must refuse to
rename onto an existing file, as HDFS does.
"""

from __future__ import annotations

import hashlib
import json
import logging
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asiento.context import RunContext
from asiento.operators.state import apply_invoice_runs, apply_payment_runs, is_invoice, is_other, purged_payments
from asiento.plans.posting import lasting_invoices, lasting_lines, lasting_payments, replay_slices
from asiento.plans.rules import REPLAY_COMPANY
from asiento.slices import SliceSet
from asiento.sources.schemas import JOURNAL
from asiento.sources.shared import claim, drop, exists, mark, names, read_text, scratch, unsized
from asiento.sources.tables import Tables

log = logging.getLogger(__name__)

# Rows without a type are deleted by no run; they have a class of their own.
INVOICES, OTHERS, UNTYPED = "invoice", "other", "untyped"
PARTITION = ("doc_class", "in_cod_empresa")
NO_COMPANY = "__HIVE_DEFAULT_PARTITION__"
REMEMBERED = 1000  # runs that a manifest names as done
ATTEMPTS = 100  # numbers that one run tries to claim

Company = int | None


@dataclass(frozen=True)
class Entry:
    """Some companies of one class in a run's folder; markers of versions after ``version`` apply."""

    run: str
    doc_class: str
    version: int
    companies: tuple[Company, ...]
    digests: dict[str, str] = field(default_factory=dict)  # of a company's rows, as the run posted them

    def only(self, keep: Callable[[Company], bool]) -> Entry:
        return replace(self, companies=tuple(c for c in self.companies if keep(c)))


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    entries: tuple[Entry, ...] = ()
    markers: dict[str, int] = field(default_factory=dict)  # run to version
    marked: dict[str, str] = field(default_factory=dict)  # run to digest of its markers
    done: tuple[str, ...] = ()

    @staticmethod
    def of(text: str) -> Manifest:
        held = json.loads(text)
        entries = (Entry(**{**e, "companies": tuple(e["companies"])}) for e in held["entries"])
        return Manifest(held["version"], tuple(entries), held["markers"], held["marked"], tuple(held["done"]))

    def text(self) -> str:
        return json.dumps(self, default=lambda o: o.__dict__)

    def where(self, doc_class: str, company: Company) -> list[Entry]:
        return [e for e in self.entries if e.doc_class == doc_class and company in e.companies]

    def after(self, entries: Iterable[Entry], version: int, **changes) -> Manifest:
        """This manifest with other entries; markers that no entry is older than are forgotten."""
        kept = tuple(e for e in entries if e.companies)
        found = replace(self, version=version, entries=kept, **changes)
        oldest = min((e.version for e in kept if e.doc_class == OTHERS), default=version)
        markers = {run: v for run, v in found.markers.items() if v > oldest}
        return replace(found, markers=markers, marked={r: d for r, d in found.marked.items() if r in markers})


@dataclass(frozen=True)
class Change:
    """What one run does to the journal, whatever that holds."""

    run: str
    doc_class: str
    cleared: frozenset[Company]
    posted: tuple[Company, ...]  # companies with new rows
    digests: dict[str, str] = field(default_factory=dict)
    markers: str | None = None  # digest of the purged documents, if there are any
    only_changed: bool = False

    def unchanged(self, base: Manifest, company: Company) -> bool:
        """The company's rows are one folder's, as a run with the same rows left them."""
        if not self.only_changed or company not in self.cleared:
            return False
        held = base.where(self.doc_class, company)
        digest = self.digests.get(str(company))
        if digest is None:
            return not held
        return len(held) == 1 and held[0].digests.get(str(company)) == digest

    def repeats(self, base: Manifest) -> bool:
        """Nothing would differ: no company, no rows beside them, and no row that the markers have not met."""
        if not self.only_changed or not all(self.unchanged(base, c) for c in self.cleared | {*self.posted}):
            return False
        if self.markers is None:
            return True
        met = (version for run, version in base.markers.items() if base.marked.get(run) == self.markers)
        beside = (e.version for e in base.entries if e.doc_class == OTHERS and not self.cleared.issuperset(e.companies))
        return max(beside, default=0) <= max(met, default=0)

    def applied(self, base: Manifest) -> Manifest:
        version = base.version + 1
        same = {c for c in self.cleared if self.unchanged(base, c)}
        gone = {*self.cleared} - same
        entries = []
        for entry in base.entries:
            if entry.doc_class != self.doc_class:
                entries.append(entry)
                continue
            entries.append(entry.only(lambda c: c not in self.cleared))
            # What is as the run would post it moves to the run's version: its markers are in it already.
            entries.append(replace(entry.only(lambda c: c in same), version=version))
        posted = tuple(c for c in self.posted if c not in same)
        digests = {str(c): self.digests[str(c)] for c in posted if c in gone and str(c) in self.digests}
        entries.append(Entry(self.run, self.doc_class, version, posted, digests))
        markers, marked = base.markers, base.marked
        if self.markers is not None:
            markers, marked = {**markers, self.run: version}, {**marked, self.run: self.markers}
        return base.after(entries, version, markers=markers, marked=marked, done=(*base.done, self.run)[-REMEMBERED:])


@dataclass(frozen=True)
class Compaction:
    """Rows of the entries read, in one folder; companies that changed meanwhile are left as they are."""

    run: str
    read: Manifest
    companies: dict[str, tuple[Company, ...]]  # by class, those with rows left
    pairs: dict[str, frozenset[Company]]  # by class, those read

    def applied(self, base: Manifest) -> Manifest:
        def folders(held: Manifest, doc_class: str, company: Company) -> list[tuple[str, int]]:
            return [(e.run, e.version) for e in held.where(doc_class, company)]

        entries = list(base.entries)
        for doc_class, companies in self.pairs.items():
            merged = {c for c in companies if folders(self.read, doc_class, c) == folders(base, doc_class, c)}
            entries = [e if e.doc_class != doc_class else e.only(lambda c: c not in merged) for e in entries]
            left = tuple(c for c in self.companies.get(doc_class, ()) if c in merged)
            entries.append(Entry(self.run, doc_class, self.read.version, left))
        return base.after(entries, base.version + 1)


class JournalTable:
    def __init__(self, spark: SparkSession, path: str, sink_decimal: tuple[int, int] | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.sink_decimal = sink_decimal
        self.schema = T.StructType(
            [
                T.StructField(field.name, T.DecimalType(*sink_decimal))
                if field.name == "in_valor" and sink_decimal
                else field
                for field in JOURNAL
            ]
        )

    # -- reading and creating ---------------------------------------------------------

    def create(self, journal: DataFrame | None = None) -> None:
        """Start the table with the rows given, or without rows."""
        run = uuid.uuid4().hex
        entries = []
        if journal is not None:
            self._write(journal, run)
            entries = [Entry(run, c, 1, self._companies(run, c)) for c in (INVOICES, OTHERS, UNTYPED)]
        if not self._publish(lambda base: base.after(entries, 1) if base.version == 0 else None):
            raise ValueError(f"{self.path} holds a journal already")

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in names(self.spark, f"{self.path}/versions") if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest manifest, or that of an earlier version."""
        known = self.versions()
        if version is None:
            version = known[-1] if known else 0
        if not version:
            return Manifest()
        return Manifest.of(read_text(self.spark, f"{self.path}/versions/{version:020d}.json"))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the journal, as of its newest version or an earlier one."""
        return self._rows(self.manifest(version)).select(*JOURNAL.names)

    def _rows(self, manifest: Manifest, keep: Callable[[str, Company], bool] = lambda *_: True) -> DataFrame:
        """Rows, less what markers purge."""
        entries = [e.only(lambda c, e=e: keep(e.doc_class, c)) for e in manifest.entries]
        # Only folders older than some marker are compared with the markers.
        last = max(manifest.markers.values(), default=0)
        older = [e for e in entries if e.doc_class == OTHERS and e.version < last and e.companies]
        met = self._folders([e for e in entries if e not in older]).drop("run")
        if not older:
            return met
        purged = None
        for run, version in manifest.markers.items():
            marked = self._markers(run).withColumn("since", F.lit(version))
            purged = marked if purged is None else purged.unionByName(marked)
        purged = unsized(purged.groupBy("purged").agg(F.max("since").alias("since")))
        while older:
            # One scan for all runs; a run whose companies are of several versions takes several.
            layer = {e.run: e for e in reversed(older)}
            versions = ", ".join(f"'{run}', {e.version}" for run, e in layer.items())
            rows = self._folders([*layer.values()]).withColumn("version", F.expr(f"map({versions})[run]"))
            listed = (F.col("in_num_documento") == F.col("purged")) & (F.col("since") > F.col("version"))
            met = met.unionByName(rows.join(purged, listed, "left_anti").drop("run", "version"))
            older = [e for e in older if e not in layer.values()]
        return met

    def _folders(self, entries: list[Entry]) -> DataFrame:
        """``run`` and the rows in the folders of some entries: no other folder is listed or read."""
        stored = T.StructType([*self.schema, T.StructField("run", T.StringType())])
        paths = [
            f"{self._folder(e.run)}/doc_class={e.doc_class}/in_cod_empresa={NO_COMPANY if c is None else c}"
            for e in entries
            for c in e.companies
        ]
        if not paths:
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).option("basePath", f"{self.path}/data").parquet(*paths).select(*stored.names)

    def _folder(self, run: str) -> str:
        return f"{self.path}/data/run={run}"

    def _markers(self, run: str) -> DataFrame:
        return self.spark.read.schema("purged bigint").parquet(f"{self.path}/markers/run={run}")

    def _write(self, journal: DataFrame, run: str) -> None:
        """Rows with their class and the table's types, in files of even size."""
        columns = [F.col(field.name).cast(field.dataType) for field in self.schema]
        doc_class = F.when(is_invoice(), INVOICES).when(is_other(), OTHERS).otherwise(UNTYPED)
        # Rebalancing gathers a company into few files and still splits a large company
        # over many tasks.
        classified = journal.select(*columns, doc_class.alias("doc_class")).hint("rebalance", *PARTITION)
        classified.write.mode("overwrite").partitionBy(*PARTITION).parquet(self._folder(run))

    def _companies(self, run: str, doc_class: str) -> tuple[Company, ...]:
        """The companies that a folder has rows of: names of its partitions."""
        found = names(self.spark, f"{self._folder(run)}/doc_class={doc_class}")
        values = [name.split("=", 1)[1] for name in found if "=" in name]
        return tuple(None if v == NO_COMPANY else int(v) for v in sorted(values))

    # -- runs -------------------------------------------------------------------------

    def run_invoices(
        self, tables: Tables, slices: SliceSet, ctx: RunContext, once: str | None = None, only_changed: bool = False
    ) -> None:
        """Post the invoices of ``slices`` in order; ``once`` and ``only_changed`` as for ``run``."""
        # Only the last slice of each company lasts: few days, whatever the run.
        ctx = replace(ctx, keys_first=True)

        def stage(run: str) -> None:
            nothing = self.spark.createDataFrame([], self.schema)
            self._write(apply_invoice_runs(nothing, lasting_invoices(tables, slices, ctx), slices), run)

        self._run(INVOICES, stage, slices, once, only_changed)

    def run_payments(
        self, tables: Tables, slices: SliceSet, ctx: RunContext, once: str | None = None, only_changed: bool = False
    ) -> None:
        """Post the payments of ``slices`` in order; ``once`` and ``only_changed`` as for ``run``.

        Stray payment lines and forms of the second system may be of any company: they are added to
        what that company has. Purged documents become markers.
        """
        ctx = replace(ctx, sink_decimal=self.sink_decimal)

        def stage(run: str) -> None:
            markers = f"{self.path}/markers/run={run}"
            purged_payments(tables.payment, slices).write.mode("overwrite").parquet(markers)
            purged = self.spark.read.parquet(markers)
            nothing = self.spark.createDataFrame([], self.schema)
            rows, lines = lasting_payments(tables, slices, ctx), lasting_lines(tables, slices, ctx, purged)
            self._write(apply_payment_runs(nothing, rows, slices, purged, lines), run)

        self._run(OTHERS, stage, slices, once, only_changed)

    def run(
        self, tables: Tables, slices: SliceSet, ctx: RunContext, once: str | None = None, only_changed: bool = False
    ) -> None:
        """Post the invoices, then the payments, of ``slices``.

        ``once`` names a shared folder of this run's own. A run that is repeated with the same
        folder does what is left to do: it publishes what was staged, computes only what
        was not, and changes nothing if all was published.

        ``only_changed`` leaves a company's rows as they are if they are what the run would post, but for the time
        of posting; if that holds for all companies, and the run posts and purges nothing else, there is no new version.
        """
        self.run_invoices(tables, slices, ctx, once, only_changed)
        self.run_payments(tables, slices, ctx, once, only_changed)

    def replay(
        self,
        tables: Tables,
        calls: SliceSet,
        ctx: RunContext,
        replay_company: int | str = REPLAY_COMPANY,
        only_changed: bool = False,
    ) -> None:
        """Post again, as reversed, the accounting dates of the documents the calls find."""
        slices, ctx = replay_slices(tables, calls, ctx, replay_company)[1:]
        self.run(tables, slices, ctx, only_changed=only_changed)

    def _run(
        self, doc_class: str, stage: Callable[[str], None], slices: SliceSet, once: str | None, only_changed: bool
    ) -> None:
        run = hashlib.sha256(f"{once}/{doc_class}".encode()).hexdigest()[:32] if once else uuid.uuid4().hex
        published = f"{once}/{doc_class}-published"
        if once and (run in self.manifest().done or exists(self.spark, published)):
            return
        # The writer leaves this file when all rows are written.
        if not exists(self.spark, f"{self._folder(run)}/_SUCCESS"):
            with scratch(self.spark):
                stage(run)
            log.info("staged %s rows in %s", doc_class, self._folder(run))
        cleared = frozenset(row.empresa for row in slices.companies().collect())
        posted = self._companies(run, doc_class)
        digests = self._digests(Entry(run, doc_class, 0, tuple(c for c in posted if c in cleared)))
        markers = None
        if doc_class == OTHERS:
            n, total = self._markers(run).distinct().agg(F.count("*"), F.sum(F.xxhash64("purged").cast("decimal(38,0)"))).first()
            markers = f"{n}:{total}" if n else None
        self.publish(Change(run, doc_class, cleared, posted, digests, markers, only_changed))
        if once:
            mark(self.spark, published)

    def _digests(self, entry: Entry) -> dict[str, str]:
        """For each company the number of its rows and the sum of their hashes, times of posting aside."""
        if not entry.companies:
            return {}
        columns = [c for c in JOURNAL.names if c != "in_fecha_ing"]
        hashed = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
        found = self._folders([entry]).groupBy("in_cod_empresa").agg(F.count("*").alias("n"), hashed.alias("total"))
        return {str(row.in_cod_empresa): f"{row.n}:{row.total}" for row in found.collect()}

    # -- versions -----------------------------------------------------------------------

    def publish(self, change: Change) -> bool:
        """Make a staged run part of the journal, in one step; False if nothing would differ.

        Publishing the same run again changes nothing.
        """

        def next_(base: Manifest) -> Manifest | None:
            if base.version == 0:
                raise ValueError(f"{self.path} holds no journal: create it first")
            return None if change.run in base.done or change.repeats(base) else change.applied(base)

        return self._publish(next_)

    def _publish(self, next_: Callable[[Manifest], Manifest | None]) -> bool:
        for _ in range(ATTEMPTS):
            found = next_(self.manifest())
            if found is None:
                return False
            if claim(self.spark, f"{self.path}/versions/{found.version:020d}.json", found.text()):
                return True
            log.info("version %d was published by another run", found.version)
        raise TimeoutError(f"{self.path}: other runs took {ATTEMPTS} versions")

    def compact(self) -> bool:
        """Merge companies that lie in several folders or have purged rows to drop.

        Runs may go on meanwhile. Companies whose folders no marker is newer than, and
        that lie in one folder, are not read.
        """
        base = self.manifest()
        last = max(base.markers.values(), default=0)
        pairs = {(e.doc_class, c) for e in base.entries for c in e.companies}
        stale = lambda k, found: len(found) > 1 or (k == OTHERS and found[0].version < last)
        wanted = {(k, c) for k, c in pairs if stale(k, base.where(k, c))}
        if not wanted:
            return False
        run = uuid.uuid4().hex
        self._write(self._rows(base, lambda k, c: (k, c) in wanted).select(*JOURNAL.names), run)
        classes = {k for k, _ in wanted}
        read = {k: frozenset(c for kind, c in wanted if kind == k) for k in classes}
        left = {k: self._companies(run, k) for k in classes}
        return self._publish(Compaction(run, base, left, read).applied)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove folders that none of the last ``keep`` versions names, and older manifests.

        For times without runs: what a run has staged is not in a version yet.
        """
        known = self.versions()
        manifests = [self.manifest(v) for v in known[-keep:]]
        needed = {e.run for m in manifests for e in m.entries} | {run for m in manifests for run in m.markers}
        gone = [f"versions/{v:020d}.json" for v in known[:-keep]]
        for kind in ("data", "markers"):
            gone += [f"{kind}/{n}" for n in names(self.spark, f"{self.path}/{kind}") if "=" in n and n.split("=", 1)[1] not in needed]
        for name in gone:
            drop(self.spark, f"{self.path}/{name}")
        return gone
