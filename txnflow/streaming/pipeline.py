"""One query from envelopes to landing rows and dead letters.

Both outputs come from one micro-batch: it is parsed once, kept, and written
twice. So the source is read once and its offsets are committed once, after
both writes. Each write replaces what an earlier try of the batch left, so a
retry ends in the same tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from txnflow.functions import RotatingKey, TokenKey
from txnflow.operators.contract import data_tests
from txnflow.operators.dedupe import dedupe_in_batch
from txnflow.operators.parse import invalid_rows, tag, valid_rows
from txnflow.operators.transform import (
    landing_projection,
    staged_dead_letters,
    staged_projection,
    tag_staged,
    transform,
    with_row_number,
)
from txnflow.schema import EVENT_TYPES, PAYLOAD_NAMES, PAYLOAD_SCHEMA
from txnflow.sinks.committed import CommittedSink
from txnflow.sinks.landing import ConnectorSink, FileSink
from txnflow.sinks.topic import TopicSink
from txnflow.streaming.live import COUNTS, LiveMetrics

Sink = FileSink | ConnectorSink | CommittedSink
Key = TokenKey | Sequence[RotatingKey]


class HeldBatch(RuntimeError):
    """A batch that the gate keeps back. Nothing of it is written or committed."""


@dataclass(frozen=True)
class PipelineConfig:
    landing: Sink
    # Refused messages are never discarded, so there is always a place for them.
    dead_letters: Sink | TopicSink
    checkpoint: str
    metrics: FileSink | None = None
    # Counts in passing instead of in a job before the writes, unless `metrics` or `gate` needs that job.
    live: LiveMetrics | None = None
    # False routes only unparseable messages and those without an id to the
    # dead letters; True also those that break the declared contract or the
    # constraints of the landing table.
    strict: bool = False
    # True holds a batch back, by failing the query, if any of its messages is
    # refused or its landing rows fail the data tests.
    gate: bool = False
    # The contract with optional fields added later; these land as columns.
    schema: T.StructType = PAYLOAD_SCHEMA
    trigger: dict = field(default_factory=lambda: {"processingTime": "10 seconds"})
    # Set to name runs yourself; by default the id kept in the checkpoint is used.
    run_id: str | None = None

    @property
    def added_fields(self) -> list[str]:
        return [n for n in self.schema.names if n not in PAYLOAD_NAMES]


class MicroBatchWriter:
    """`foreachBatch` callback. A failed write propagates and fails the query."""

    def __init__(self, config: PipelineConfig, key: Key | None):
        self._config = config
        self._key = key

    def _run_id(self, batch: DataFrame) -> str:
        run_id = self._config.run_id or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not run_id:
            raise ValueError("a batch outside of a streaming query needs a run_id, so that no other run overwrites it")
        return run_id

    def write(self, raw: DataFrame, batch_id: int) -> None:
        """Envelopes in; landing rows, dead letters and metrics out."""
        run_id = self._run_id(raw)
        config = self._config
        tagged = tag(raw, config.strict, config.schema)
        if config.live and not config.metrics and not config.gate:
            self._write_observed(tagged, run_id, batch_id)
            return
        tagged = tagged.persist()
        try:
            # This job parses the batch into the cache; the writes read from there.
            # Counting rows, not tasks' reports, stays right when a task runs again.
            n_valid, n_written, n_invalid = _batch_counts(tagged)
            rows = valid_rows(tagged, tuple(config.schema.names))
            # As many ids as rows: there is no copy to look for.
            landing = self._landing(rows if n_valid == n_written else dedupe_in_batch(rows), config.added_fields)
            self._pass_gate(landing, n_invalid)
            if n_invalid:
                dated = invalid_rows(tagged).withColumn("event_date", F.to_date("kafka_timestamp"))
                config.dead_letters.write_batch(dated, run_id, batch_id)
            if n_valid:
                config.landing.write_batch(landing, run_id, batch_id)
            if n_valid or n_invalid:
                self._write_metrics(raw, (n_valid, n_valid - n_written, n_written, n_invalid), run_id, batch_id)
        finally:
            tagged.unpersist()

    def _write_observed(self, tagged: DataFrame, run_id: str, batch_id: int) -> None:
        """Both writes of a batch, which count its rows as they come by.

        Whether there is anything to write, or any copy to look for, is not known
        before, so both writes run and ids are always compared.
        """
        config = self._config
        valid, refused, written = Observation(), Observation(), Observation()
        tagged = tagged.persist()
        try:
            dated = _counted(invalid_rows(tagged), refused).withColumn("event_date", F.to_date("kafka_timestamp"))
            rows = _counted(valid_rows(tagged, tuple(config.schema.names)), valid)
            landing = _counted(self._landing(dedupe_in_batch(rows), config.added_fields), written)
            sent = config.dead_letters.write_batch(dated, run_id, batch_id) is not False
            landed = config.landing.write_batch(landing, run_id, batch_id) is not False
        finally:
            tagged.unpersist()
        # A sink that had the batch already computes nothing, so what it would have counted is unknown.
        n_valid, n_written = (_count_of(valid), _count_of(written)) if landed else (None, None)
        copies = n_valid - n_written if landed else None
        self._note((n_valid, copies, n_written, _count_of(refused) if sent else None), tagged, run_id, batch_id)

    def _note(self, counts: tuple, batch: DataFrame, run_id: str, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if self._config.live and query_id:
            self._config.live.note(query_id, run_id, batch_id, dict(zip(COUNTS, counts)))

    def write_staged(self, staged: DataFrame, batch_id: int) -> None:
        """Rows of staged files in, landed without a stream position; unreadable records to the dead letters."""
        run_id = self._run_id(staged)
        tagged = tag_staged(staged, self._config.strict).persist()
        try:
            good = F.col("dlq_reason").isNull()
            n, n_invalid = tagged.agg(F.count_if(good), F.count_if(~good)).first()
            landing = self._landing(staged_projection(tagged.where(good)))
            self._pass_gate(landing, n_invalid)
            if n_invalid:
                letters = staged_dead_letters(tagged).withColumn("event_date", F.lit(None).cast("date"))
                self._config.dead_letters.write_batch(letters, run_id, batch_id)
            if n:
                self._config.landing.write_batch(landing, run_id, batch_id)
            if n or n_invalid:
                self._write_metrics(staged, (n, 0, n, n_invalid), run_id, batch_id)
        finally:
            tagged.unpersist()

    def _landing(self, rows: DataFrame, added: Sequence[str] = ()) -> DataFrame:
        rotating = self._key is not None and not isinstance(self._key, TokenKey)
        extra = [*added, *(["token_key_id"] if rotating else [])]
        return with_row_number(landing_projection(transform(rows, self._key, extra=added), extra))

    def _pass_gate(self, landing: DataFrame, n_invalid: int) -> None:
        if not self._config.gate:
            return
        broken = [("contract", "payload", n_invalid)] if n_invalid else []
        tests = data_tests(
            landing,
            not_null=("transaction_id", "account_id_token", "amount_cents", "event_ts"),
            unique=("transaction_id",),
            accepted={"event_type": EVENT_TYPES},
        )
        broken += [tuple(r) for r in tests.where("failures > 0").collect()]
        if broken:
            raise HeldBatch(", ".join(f"{check} {column}: {n}" for check, column, n in broken))

    def _write_metrics(self, batch: DataFrame, counts: tuple[int, ...], run_id: str, batch_id: int) -> None:
        self._note(counts, batch, run_id, batch_id)
        if self._config.metrics:
            schema = "rows_in bigint, duplicates bigint, rows_written bigint, rows_invalid bigint"
            self._config.metrics.write_batch(batch.sparkSession.createDataFrame([counts], schema), run_id, batch_id)


def _batch_counts(tagged: DataFrame) -> tuple[int, int, int]:
    """Valid rows, distinct valid ids and invalid rows, in one job.

    Rows are counted per id first, so the copies of one id travel as one row.
    """
    valid = F.col("dlq_reason").isNull()
    per_id = tagged.groupBy(valid.alias("valid"), F.when(valid, F.col("transaction_id")).alias("id"))
    zero = F.lit(0).cast("bigint")
    rows = per_id.agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.when(F.col("valid"), F.col("n"))), zero),
        F.count_if("valid"),
        F.coalesce(F.sum(F.when(~F.col("valid"), F.col("n"))), zero),
    )
    return tuple(rows.first())


def _counted(rows: DataFrame, observation: Observation) -> DataFrame:
    return rows.observe(observation, F.count(F.lit(1)).alias("n"))


def _count_of(observation: Observation) -> int:
    """Rows that came by. Where Spark finds while it runs that no row comes, it
    drops that part of the plan, and the report has no fields to read: none came.
    """
    try:
        return observation.get["n"]
    except Py4JJavaError as error:
        if error.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return 0


def start_pipeline(envelopes: DataFrame, config: PipelineConfig, key: Key) -> StreamingQuery:
    """Start the query on any stream of envelopes; `config.trigger` sets its pace."""
    return _start(envelopes, MicroBatchWriter(config, key).write, config)


def start_file_ingest(staged: DataFrame, config: PipelineConfig) -> StreamingQuery:
    """Start continuous loading of staged, already tokenized files."""
    return _start(staged, MicroBatchWriter(config, None).write_staged, config)


def _start(stream: DataFrame, write, config: PipelineConfig) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", config.checkpoint)
        .trigger(**config.trigger)
        .start()
    )
