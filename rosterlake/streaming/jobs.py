"""Stream forms of two batch jobs.

Payload reading keeps no state, so the batch operator runs on the stream as it is. Extraction is
incremental by its state table; each micro-batch skips the ids an earlier one finished.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from ..operators.embedding import Encoder
from ..operators.extraction import Extract
from ..operators.payload import read_payloads, score_requests
from ..plans.scoring import run_extraction


def parsed_requests(requests: DataFrame) -> DataFrame:
    """Streamed requests with parsed payloads and a rejection reason."""
    return read_payloads(requests)


def score_stream(requests: DataFrame, output: str, checkpoint: str, encode: Encoder,
                 extract: Extract | None = None, jobs: DataFrame | None = None) -> DataStreamWriter:
    """Score every micro-batch and write it under its batch number, so that a replayed batch replaces itself."""
    def write(batch: DataFrame, number: int) -> None:
        score_requests(batch, encode, extract, jobs).write.mode("overwrite").parquet(f"{output}/batch={number}")

    return requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def extraction_stream(rows: DataFrame, folder: str, output: str, checkpoint: str, extract: Extract,
                      entities: dict[str, DataFrame] | None = None) -> DataStreamWriter:
    """Extract new ids of every micro-batch and write the enriched rows.

    With ``entities`` (see :func:`run_extraction`) the texts come from the job and candidate tables, and
    the streamed rows give their ids only.
    """
    def write(batch: DataFrame, number: int) -> None:
        enriched = run_extraction(batch.sparkSession, batch, folder, extract, entities, (checkpoint, number))
        enriched.write.mode("overwrite").parquet(f"{output}/batch={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


