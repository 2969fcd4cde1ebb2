"""Stored tables of any set of event handlers, with one commit for all of them.

A batch decodes its blocks once and writes, each into a folder of its own: the rows of every handler, rejected records,
and what failed. One manifest folder, written last, makes all of it visible: coverage, the failure ledger and run totals
are derived from committed batches and never updated. A crash before the manifest leaves nothing visible, and the same
batch id writes the same folders again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from chainloom import schemas
from chainloom.constants import HEIGHT_BUCKET
from chainloom.extend import Handler, HandlerSpec
from chainloom.operators.dictionary import dict_encode, dict_lookup
from chainloom.operators.intervals import range_overlap_join
from chainloom.operators.ledger import fold_failures, pop_failures, runs_from_manifest
from chainloom.operators.merge import first_per_key
from chainloom.sinks.tables import BatchTable, VersionedTable, discard
from chainloom.sources.blocks import SHAPES, stage_blocks, staged_events
from chainloom.sources.landed import LandedBlocks


def islands_in_buckets(heights: DataFrame) -> DataFrame:
    """Consecutive heights ``(handler, height)`` as ranges, cut at the edges of height buckets.

    Coverage may touch or overlap, as readers merge it, so a batch needs no pass across buckets.
    """
    bucket = F.floor(F.col("height") / HEIGHT_BUCKET)
    placed = heights.select("handler", "height", bucket.alias("_bucket"))
    order = Window.partitionBy("handler", "_bucket").orderBy("height")
    return (
        placed.withColumn("_island", F.col("height") - F.row_number().over(order))
        .groupBy("handler", "_bucket", "_island")
        .agg(F.min("height").alias("from_height"), F.max("height").alias("to_height"))
        .select("handler", "from_height", "to_height")
    )


class EventStore:
    """Tables of the selected handlers under one root directory.

    One writer at a time; readers may read at any time.
    """

    def __init__(self, spark: SparkSession, root: str, handlers: Iterable[Handler]):
        self.spark, self.root = spark, root
        self.specs = [HandlerSpec.of(h) for h in handlers]
        if len({s.table for s in self.specs}) < len(self.specs):
            raise ValueError("two handlers would share a table")
        self.manifest_path = f"{root}/manifest"
        self._log = self._batches("failure_log", schemas.FAILURE_LOG)
        self._claims = self._batches("claims", schemas.CLAIMS)
        self.tables = {s.name: self._batches(s.table, s.schema) for s in self.specs}
        self.rejected = {s.name: self._batches(f"rejected_{s.table}", s.records) for s in self.specs}
        names = {d for s in self.specs for d, _ in s.dictionaries.values()}
        self.dictionaries = {n: VersionedTable(spark, f"{root}/{n}", schemas.DICTIONARY) for n in sorted(names)}
        self._spans = VersionedTable(spark, f"{root}/runs", schemas.RUN_SPANS)

    def _batches(self, name: str, schema: str) -> BatchTable:
        return BatchTable(self.spark, f"{self.root}/{name}", schema, manifest=self.manifest_path)

    # --- what follows from committed batches ---

    def manifest(self) -> DataFrame:
        return self._log.manifest()

    def committed(self, batch_id: str) -> bool:
        return self._log.committed(batch_id)

    def coverage(self) -> DataFrame:
        """Covered ranges per handler."""
        return self._log.coverage()

    def ledger(self) -> DataFrame:
        """Heights that failed and were not covered since, with their retries."""
        covered = self.manifest().where("handler is not null").select("handler", "from_height", "to_height", "seq")
        return fold_failures(self._log.read().drop("batch_id"), covered, self.open_claims().drop("batch_id"))

    def open_claims(self) -> DataFrame:
        """Heights of retries that were begun and are not committed, with their batch id."""
        waiting = [b for b in self._claims.batches() if not self.committed(b) and self._claims.written(b)]
        return self._claims.read_batches(waiting)

    # --- runs ---

    def start_run(self, now: Column) -> int:
        """Open a run; batches that name it make up its totals."""
        spans = self._spans.read()
        run_id = (spans.agg(F.max("id")).first()[0] or 0) + 1
        opened = self.spark.range(1).select(F.lit(run_id).cast("bigint").alias("id"), now.alias("started_at"))
        self._spans.replace(spans.unionByName(opened, allowMissingColumns=True))
        return run_id

    def end_run(self, run_id: int, reason: str, now: Column) -> None:
        """Close a run; the first end and reason stay."""
        this = F.col("id") == run_id
        ended = self._spans.read().withColumns(
            {
                "end_reason": F.when(this & F.col("ended_at").isNull(), F.lit(reason)).otherwise(F.col("end_reason")),
                "ended_at": F.when(this, F.coalesce("ended_at", now)).otherwise(F.col("ended_at")),
            }
        )
        self._spans.replace(ended)

    def runs(self) -> DataFrame:
        return runs_from_manifest(self._spans.read(), self.manifest())

    # --- batches ---

    def overlapping(self, islands: DataFrame, but: str) -> list[str]:
        """Committed batches that cover a height of ``islands``: the only ones that can hold the same rows.

        The zone map, lowest and highest height of each batch, leaves out most; what is left is compared range by range,
        in buckets as wide as the longer range, so scattered heights don't meet all others of a wide bucket.
        """
        zone = islands.agg(F.min("from_height"), F.max("to_height")).first()
        if zone[0] is None:
            return []
        near = self.manifest().where(
            (F.col("batch_id") != but) & F.col("handler").isNotNull() & (F.col("from_height") <= zone[1]) & (F.col("to_height") >= zone[0])
        )

        clipped = near.withColumns(  # what lies outside the batch meets nothing
            {"from_height": F.greatest("from_height", F.lit(zone[0])), "to_height": F.least("to_height", F.lit(zone[1]))}
        )
        met = range_overlap_join(clipped.select("handler", "batch_id", "from_height", "to_height"), islands)
        return sorted(r[0] for r in met.select("batch_id").distinct().collect())

    def ingest(
        self,
        raw: DataFrame,
        batch_id: str,
        now: Column,
        max_retries: int = 0,
        run_id: int | None = None,
        shape: str = "rpc",
    ) -> None:
        """Store one batch of landed blocks. A committed id is never touched again, whatever ``raw`` holds.

        Ids must be unique per checkpoint. Rows whose key an overlapping batch holds are left out; a batch that overlaps
        none reads no stored row. A height is done for a handler when a copy of it decodes and no record of it has a fatal
        reason; otherwise it is logged as failed for that handler.
        """
        if self.committed(batch_id):
            return
        staging = f"{self.root}/staging/{batch_id}"

        def keep(df: DataFrame, name: str) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{staging}/{name}")
            return self.spark.read.schema(df.schema).parquet(f"{staging}/{name}")

        staged = keep(stage_blocks(SHAPES[shape](raw), [t for s in self.specs for t in s.event_types]), "blocks")
        records = {s.name: keep(self._records(s, staged), f"records_{s.table}") for s in self.specs}
        # one good copy of a height is enough
        copies = staged.groupBy("height").agg(F.min("error").alias("error"), F.bool_or(F.col("error").isNull()).alias("ok"))
        outcome = copies.select("height", F.when(~F.col("ok"), F.col("error")).alias("error"))
        heights = keep(self._all(self._heights(s, outcome, records[s.name]) for s in self.specs), "heights")
        failed = heights.where("reason is not null")
        islands = keep(islands_in_buckets(heights.where("reason is null")), "islands")
        others = self.overlapping(islands, batch_id)
        seq = (self.manifest().agg(F.max("seq")).first()[0] or 0) + 1
        rows = 0
        for s in self.specs:
            rows += self._write_rows(s, records[s.name], others, batch_id)
            self.after_write(s, self.tables[s.name].read_batch(batch_id), batch_id)
        self._log.write_batch(
            failed.select(
                "handler", "height", "reason", F.lit(False).alias("permanent"), F.lit(max_retries).alias("max_retries"),
                F.lit(seq).cast("bigint").alias("seq"), now.alias("at"),
            ),
            batch_id,
        )
        decoded = staged.where("error is null").select("height").distinct()
        totals = decoded.agg(F.count(F.lit(1)).alias("blocks"), F.lit(rows).cast("bigint").alias("rows"))
        length = F.col("to_height") - F.col("from_height") + 1
        lines = islands.select("handler", "from_height", "to_height", length.alias("blocks")).unionByName(totals, allowMissingColumns=True)
        self.commit(
            lines.withColumns(
                {
                    "rows": F.coalesce("rows", F.lit(0).cast("bigint")),
                    "committed_at": now,
                    "seq": F.lit(seq).cast("bigint"),
                    "run_id": F.lit(run_id).cast("bigint"),
                }
            ),
            batch_id,
        )
        discard(self.spark, staging)

    def commit(self, lines: DataFrame, batch_id: str) -> None:
        """The last step of a batch."""
        self._log.commit(lines, batch_id)

    def after_write(self, spec: HandlerSpec, written: DataFrame, batch_id: str) -> None:
        """A place for tables derived from the rows of one batch; they must use the same manifest."""

    @staticmethod
    def _all(frames: Iterable[DataFrame]) -> DataFrame:
        first, *more = frames
        for other in more:
            first = first.unionByName(other)
        return first

    @staticmethod
    def _records(spec: HandlerSpec, staged: DataFrame) -> DataFrame:
        out = spec.transform(staged_events(staged, spec.event_types))
        if "reason" not in out.columns:
            out = out.withColumn("reason", F.lit(None).cast("string"))
        return out.select(*[part.split()[0] for part in spec.records.split(", ")])

    @staticmethod
    def _heights(spec: HandlerSpec, outcome: DataFrame, records: DataFrame) -> DataFrame:
        """``handler, height, reason`` of a batch; no reason where the height is done."""
        out = outcome.withColumnRenamed("error", "reason")
        if spec.fatal:
            refused = spec.failed(records).withColumnRenamed("reason", "_refused")
            out = out.join(refused, "height", "left").select("height", F.coalesce("reason", "_refused").alias("reason"))
        return out.select(F.lit(spec.name).alias("handler"), "height", "reason")

    def _write_rows(self, spec: HandlerSpec, records: DataFrame, others: list[str], batch_id: str) -> int:
        """Rows of a batch, ids looked up, one per key and none that an overlapping batch holds; and rejected records."""
        rows, rejects = spec.rows_and_rejects(records)
        fresh = first_per_key(rows, spec.key, [*spec.key, *[c for c in rows.columns if c not in spec.key]])
        for text, (name, id_column) in spec.dictionaries.items():
            self._grow(self.dictionaries[name], records.where("reason is null"), text)
            fresh = dict_lookup(fresh, self.dictionaries[name].read(), text, id_column)
        fresh = fresh.select(*spec.columns())
        if others:
            stored = self.tables[spec.name].read_batches(others).select(*spec.key)
            fresh = fresh.join(stored, spec.key, "left_anti")
        count = Observation()
        self.tables[spec.name].write_batch(fresh.observe(count, F.count(F.lit(1)).alias("n")), batch_id)
        self.rejected[spec.name].write_batch(rejects, batch_id)
        return count.get["n"]

    def _grow(self, dictionary: VersionedTable, rows: DataFrame, text: str) -> None:
        """Add unseen texts to a dictionary; most batches bring none and write nothing."""
        known = dictionary.read()
        if not rows.select(F.col(text).alias("value")).join(known, "value", "left_anti").isEmpty():
            dictionary.replace(dict_encode(rows, known, text))

    # --- dead letters ---

    def claim(self, batch_id: str, limit: int) -> DataFrame:
        """Heights that a retry works on: claimed before anything is read, and the same ones if it is begun again."""
        if not self._claims.written(batch_id):
            popped, _ = pop_failures(self.ledger(), limit)
            self._claims.write_batch(popped.select("handler", "height"), batch_id)
        return self._claims.read_batch(batch_id)

    def retry_failures(
        self, raw: DataFrame | LandedBlocks, batch_id: str, now: Column, limit: int, max_retries: int, run_id: int | None = None
    ) -> None:
        """Take waiting heights (highest first, ``limit`` per handler) and ingest them again.

        The claim, one row per height, is written first, so a call that was cut short anywhere does the same heights when
        it is repeated under its id; :meth:`resume_retries` repeats all of these. Until then the heights stay in the
        ledger, marked. Landed blocks in height buckets are read at these heights only. A height that fails again is
        logged again; one that ``raw`` lacks goes on waiting.
        """
        if self.committed(batch_id):
            return
        heights = self.claim(batch_id, limit).select("height").distinct()
        found = raw.at_heights(heights) if isinstance(raw, LandedBlocks) else raw.join(heights, "height", "left_semi")
        self.ingest(found, batch_id, now, max_retries, run_id)
        discard(self.spark, f"{self._claims.path}/batch_id={batch_id}")

    def resume_retries(self, raw: DataFrame | LandedBlocks, now: Column, max_retries: int) -> list[str]:
        """Finish the retries that were begun and never committed; returns their ids."""
        begun = sorted(r[0] for r in self.open_claims().select("batch_id").distinct().collect())
        for batch_id in begun:
            self.retry_failures(raw, batch_id, now, 0, max_retries)
        return begun

    def read(self, handler: str) -> DataFrame:
        """Committed rows of a handler, texts in place of ids."""
        spec = next(s for s in self.specs if s.name == handler)
        rows = self.tables[handler].read().drop("batch_id")
        for text, (name, id_column) in spec.dictionaries.items():
            entries = self.dictionaries[name].read().withColumnsRenamed({"id": id_column, "value": text})
            rows = rows.join(entries, id_column).drop(id_column)
        return rows
