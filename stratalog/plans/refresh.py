"""A whole refresh: crawl, enrich, validate, export, compare.

Every stage reads the last snapshot and writes the next one, so a stage that fails is simply run
again and nothing is computed twice. Counts are gathered while a snapshot is written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog import fixed_values as fv
from stratalog.operators import catalog as cat
from stratalog.operators.inference import Client, infer_counts, run_calls
from stratalog.operators.joins import is_small, semi_by_key
from stratalog.operators.listing import listing_extract
from stratalog.operators.prompts import DEFAULT_TEMPLATES, build_prompts
from stratalog.operators.publish import no_change_gate, snapshot_diff
from stratalog.operators.quality import (
    DEFAULT_RULES, Rule, validation_counts, validation_transition,
)
from stratalog.operators.responses import merge_answers
from stratalog.operators.staleness import select_stale
from stratalog.schema import (
    CATALOG_SCHEMA, CONTENT_COLUMNS, CONTENT_SCHEMA, PAGE_ARCHIVE_SCHEMA, RESPONSES_SCHEMA,
    ROLLUP_COLUMNS, SECTIONS_SCHEMA, STATE_SCHEMA,
)
from stratalog.sources.digests import change_feed, write_digests
from stratalog.sources.exports import export_name, read_export, write_export
from stratalog.sources.snapshots import SnapshotStore, latest_rows

# Rewritten per stage: the state of every item. Appended to: pages, what was read from them, answers.
CATALOG, LISTING, ENRICHMENT = "catalog", "listing", "enrichment"
PAGES, CONTENT, RESPONSES = "pages", "content", "responses"


@dataclass(frozen=True)
class Site:
    """Where items live and how their pages speak."""

    base_url: str
    link_prefix: str
    command_prefix: str
    item_type: str = "official"


@dataclass(frozen=True)
class Options:
    """Switches of a run."""

    skip_crawl: bool = False
    skip_enrich: bool = False
    force_crawl: bool = False
    force_enrich: bool = False
    single_key: str | None = None
    dry_run: bool = False
    enrich_version: int = 1
    # "all": the second pass takes every stale item; "requeued": only those queued again.
    requeue_scope: str = "all"
    max_passes: int = 1
    attempts: int = 2
    # Model calls are written in this many lots, so a lost run repeats one lot at most.
    lots: int = 1
    partitions: int | None = None
    # Items a task asks about at a time.
    calls_per_task: int = 1
    model_label: str | None = None
    rules: Sequence[Rule] = DEFAULT_RULES
    max_retries: int = fv.MAX_VALIDATION_RETRIES
    templates: dict = field(default_factory=lambda: dict(DEFAULT_TEMPLATES))


class Refresh:
    """The stages of a run over one store."""

    def __init__(
        self,
        store: SnapshotStore,
        site: Site,
        client_factory: Callable[[], Client],
        run_ts: str,
        options: Options = Options(),
    ):
        self.store, self.site, self.client_factory = store, site, client_factory
        self.run_ts, self.options = run_ts, options
        self._stamp = F.lit(run_ts).cast("timestamp")

    def state(self) -> DataFrame:
        """All catalog columns but the long ones; what the stages rewrite."""
        return self.store.read(CATALOG, STATE_SCHEMA)

    def catalog(self) -> DataFrame:
        """The whole catalog, state and content."""
        return self._with_content(self.state(), latest_rows(self._all(CONTENT)))

    def pages(self) -> DataFrame:
        return latest_rows(self._all(PAGES))

    def _with_content(self, state: DataFrame, content: DataFrame) -> DataFrame:
        joined = state.join(content.select("item_key", *CONTENT_COLUMNS), "item_key", "left")
        return joined.select(*CATALOG_SCHEMA.names)

    # ---- stages ----------------------------------------------------------------------------

    def crawl(self, listing: DataFrame, details: DataFrame, tag: str | None = None) -> dict:
        """Listing pages (page_id, html) and detail pages (item_key, html) into the catalog.

        Pages, content and state become visible together.
        """
        with self.store.together():
            return self._crawl(listing, details, tag)

    def _crawl(self, listing: DataFrame, details: DataFrame, tag: str | None) -> dict:
        """One crawl.

        The detail pages are by far the largest input. A page is taken, listed or not, unless its
        key has stored content (with ``force_crawl`` always): it is archived and read in one pass,
        and only short columns of what it says are joined. Content of a key that no listing has
        shown yet waits; content of a known key without any is put on it. So the catalog does not
        depend on the batches in which listings and pages arrive.
        """
        site, force = self.site, self.options.force_crawl
        state = self.state()
        found = listing_extract(listing, site.link_prefix)
        self.store.write(LISTING, found, tag=tag)
        records = self.store.read(LISTING, found.schema)

        landed = details.filter("item_key IS NOT NULL AND length(html) > 0")
        taken = landed if force else self._unread(landed)
        self.store.write(PAGES, taken.select("item_key", "html"), tag=tag)
        self._read_pages(self.store.read(PAGES, PAGE_ARCHIVE_SCHEMA), tag)

        short = self._all(CONTENT).select("item_key", *ROLLUP_COLUMNS, "_version")
        content = latest_rows(short.withColumn(
            "has_detail", F.col("_version") == self.store.version(CONTENT)))
        late = cat.merge_content(state, content.filter("has_detail")).drop(cat.ACTION)
        typed = cat.typed_listing(records, F.to_date(self._stamp))
        merged = cat.catalog_upsert(
            late, cat.attach_rollups(typed, content), site.base_url, self._stamp,
            site.item_type, small_crawl=is_small(records),
        )
        return self._save(merged, cat.action_counts("inserted", "updated"), tag)

    def _unread(self, landed: DataFrame) -> DataFrame:
        """Landed pages of keys without stored content.

        Decided on keys. The markup is filtered in place by a broadcast of the keys to leave out or
        of those to keep, whichever are few; it is shuffled only where one landing has many of both.
        """
        if not self.store.version(CONTENT):
            return landed
        stored = self._all(CONTENT).select("item_key").distinct()
        keys = landed.select("item_key").distinct()
        known = keys.join(stored, "item_key", "left_semi")
        if is_small(known):
            return landed.join(F.broadcast(known), "item_key", "left_anti")
        fresh = keys.join(stored, "item_key", "left_anti")
        return semi_by_key(landed, fresh, "item_key", is_small(fresh))

    def reparse(self) -> dict:
        """Read all stored pages again."""
        with self.store.together():
            content = self._read_pages(self.pages(), None)
            merged = cat.merge_content(self.state(), content)
            return self._save(merged, cat.action_counts("updated", "skipped"))

    def _read_pages(self, pages: DataFrame, tag: str | None) -> DataFrame:
        """Append what the pages say, without a shuffle, and return it."""
        content = cat.read_whole(pages, self.site.command_prefix)
        self.store.write(CONTENT, content.select(*CONTENT_SCHEMA.names), tag=tag)
        return self.store.read(CONTENT, CONTENT_SCHEMA)

    def enrich(self) -> dict:
        """Ask the model about stale items and write the answers back."""
        tag = self._tag(0)
        if not self.store.has_tag(CATALOG, f"{tag}/enriched"):
            self._save(self._enriched(0, None), [], f"{tag}/enriched")
        return self._enrich_counts(tag)

    def validate(self) -> dict:
        """Validate every item; once for a ``run_ts``."""
        tag = f"{self.run_ts}/validated"
        if self.store.has_tag(CATALOG, tag):
            return self._counts(CATALOG, tag)
        return self._save(self._checked(self.state()), validation_counts(), tag)

    def enrich_and_validate(
        self, pass_no: int = 0, keys: DataFrame | None = None
    ) -> tuple[dict, dict]:
        """Both stages, with the catalog written once instead of twice.

        A pass that this ``run_ts`` has finished is not repeated: retries would be counted again.
        """
        tag = self._tag(pass_no)
        done = f"{tag}/checked"
        if not self.store.has_tag(CATALOG, done):
            written = self._enriched(pass_no, keys)
            self._save(self._checked(written), validation_counts(), done)
        return self._enrich_counts(tag), self._counts(CATALOG, done)

    def _checked(self, catalog: DataFrame) -> DataFrame:
        return validation_transition(catalog, self.options.rules, self.options.max_retries)

    def _tag(self, pass_no: int) -> str:
        return f"{self.run_ts}/{pass_no}/{self.options.lots}"

    def _counts(self, name: str, tag: str) -> dict:
        return {k: v for k, v in self.store.metrics(name, tag).items() if k != "rows_in"}

    def _enrich_counts(self, tag: str) -> dict:
        return self._counts(ENRICHMENT, tag)

    def _enriched(self, pass_no: int, keys: DataFrame | None) -> DataFrame:
        o = self.options
        if pass_no == 0:
            stale = select_stale(self.state(), o.enrich_version, o.force_enrich, o.single_key)
        else:
            stale = select_stale(self.state(), o.enrich_version)
            if keys is not None:
                stale = semi_by_key(stale, keys, "item_key", is_small(keys))
        tag = self._tag(pass_no)
        stale = stale.select("item_key", "description", "labels")
        for lot in range(o.lots):
            lot_tag = f"{tag}/{lot}"
            if self.store.has_tag(RESPONSES, lot_tag):
                continue
            items = stale
            if o.lots > 1:
                items = stale.filter(F.pmod(F.xxhash64("item_key"), F.lit(o.lots)) == lot)
            content = self._rows_of(CONTENT, items, is_small(items)).select(
                "item_key", "readme", *SECTIONS_SCHEMA.names)
            prompts = build_prompts(items.join(content, "item_key", "left"), o.templates)
            answers = run_calls(
                prompts, self.client_factory, attempts=o.attempts, partitions=o.partitions,
                calls_per_task=o.calls_per_task,
            )
            self.store.write(RESPONSES, answers, tag=lot_tag)
        merged = merge_answers(self._answers(tag))
        # An item that has gone since it was chosen cannot be written back, so it counts as failed.
        present = self.state().select("item_key", F.lit(True).alias("_present"))
        counted = merged.join(present, "item_key", "left").withColumn(
            "ok", F.col("ok") & F.coalesce("_present", F.lit(False))).drop("_present")
        self.store.write(ENRICHMENT, counted, infer_counts(F.col("ok")), tag)
        enriched = self.store.read(ENRICHMENT, merged.schema).filter("ok")
        return cat.enrichment_writeback(self.state(), enriched, o.enrich_version)

    def export(self) -> dict:
        """Write the export, once for a ``run_ts``; tell how it differs from the one before."""
        o = self.options
        root = f"{self.store.root}/exports/{export_name(o.model_label)}"
        # One series of exports per model label.
        name = f"export/{export_name(o.model_label)}"
        digests = f"{name}/digests"
        done = self.store.has_tag(name, self.run_ts)
        number = self.store.log(name, self.run_ts)[-1]["version"] - 1 if done else (
            self.store.version(name))
        previous = read_export(self.store.spark, f"{root}/{number:06d}") if number else None
        path = f"{root}/{number + 1:06d}"
        if not done:
            found = write_export(self.catalog(), path)
            write_digests(read_export(self.store.spark, path), f"{path}-digests", ignore=["timestamp"])
            with self.store.together():
                self.store.announce_export(name, path, found, self.run_ts)
                self.store.announce_export(digests, f"{path}-digests", {}, self.run_ts)
        stats = self.store.metrics(name, self.run_ts)
        feed = self.changes()
        if feed is not None:
            kinds = {r["kind"]: r["count"] for r in feed.groupBy("kind").count().collect()}
            new, removed = kinds.get("added", 0), kinds.get("removed", 0)
            diff = {"total": stats["total"], "new": new, "common": stats["total"] - new,
                    "removed": removed}
            return {"stats": stats, "diff": diff, "changed": kinds.get("changed", 0),
                    "unchanged": not kinds}
        # The export before has no digests: both are read.
        now = read_export(self.store.spark, path)
        diff = snapshot_diff(now, previous).first().asDict()
        gate = no_change_gate(now, previous, ignore=["timestamp"]).first().asDict()
        return {"stats": stats, "diff": diff, "unchanged": gate["unchanged"]}

    def changes(self) -> DataFrame | None:
        """(key, kind, columns) of what this run's export changed against the one before, told from the
        digests stored with both; the run stamp does not count. None where the one before has none."""
        name = f"export/{export_name(self.options.model_label)}"
        own = self.store.log(name, self.run_ts)[-1]["version"]
        paths = {r["dir"] for r in self.store.log(f"{name}/digests")}
        base = {r["version"]: f"{r['dir']}-digests" for r in self.store.log(name)}
        if base[own] not in paths or own > 1 and base[own - 1] not in paths:
            return None
        return change_feed(self.store.spark, base[own], base.get(own - 1))

    def run(self, listing: DataFrame | None = None, details: DataFrame | None = None) -> dict:
        """All stages in order; with ``dry_run`` nothing after enrichment."""
        o, out = self.options, {}
        if not o.skip_crawl:
            out["crawl"] = self.crawl(listing, details)
        if o.dry_run:
            if not o.skip_enrich:
                out["enrich"] = self.enrich()
            return out
        if o.skip_enrich:
            out["validation"] = self.validate()
        else:
            out["enrich"], out["validation"] = self.enrich_and_validate()
        for pass_no in range(1, o.max_passes + 1):
            if not out["validation"]["re_queued"]:
                break
            keys = None
            if o.requeue_scope == "requeued":
                # Queued again in this run: no version any more, retries counted.
                keys = self.state().filter(
                    F.col("enrich_version").isNull() & (F.col("validation_retries") > 0)
                ).select("item_key")
            out["enrich_again"], out["validation"] = self.enrich_and_validate(pass_no, keys)
        out["export"] = self.export()
        return out

    # ---- helpers ---------------------------------------------------------------------------

    def _save(self, df: DataFrame, metrics: list, tag: str | None = None) -> dict:
        found = self.store.write(CATALOG, df, metrics, tag)
        found.pop("rows_in")
        return found

    def _all(self, name: str) -> DataFrame:
        schema = PAGE_ARCHIVE_SCHEMA if name == PAGES else CONTENT_SCHEMA
        return self.store.read_all(name, schema)

    def _rows_of(self, name: str, items: DataFrame, small: bool) -> DataFrame:
        """Newest rows of the given items, without shuffling the whole table for a small set."""
        return latest_rows(semi_by_key(self._all(name), items, "item_key", small))

    def _answers(self, tag: str) -> DataFrame:
        lots = [f"{tag}/{lot}" for lot in range(self.options.lots)]
        rows = [self.store.read_all(RESPONSES, RESPONSES_SCHEMA, t) for t in lots]
        out = rows[0]
        for more in rows[1:]:
            out = out.unionAll(more)
        return out.drop("_version")


def local_or_shared_root(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate snapshots: below the session's checkpoint folder if the
    cluster names one, else a temporary folder of this machine, which a local master alone may use."""
    import tempfile
    import uuid

    shared: Any = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"{name}-")
