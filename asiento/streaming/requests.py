"""Posting requests that arrive as a stream.

Each row asks for one posting: (pedido, fecha, empresa, estado), where ``pedido`` numbers
the requests. A micro-batch is posted as one set of slices, in request order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from asiento.context import RunContext
from asiento.slices import SliceSet
from asiento.sources.journal import JournalTable
from asiento.sources.tables import Tables


def request_slices(requests: DataFrame) -> SliceSet:
    return SliceSet.from_frame(
        requests.select(
            F.col("pedido").cast("bigint").alias("slice_id"),
            F.to_date("fecha").alias("fecha"),
            F.col("empresa").cast("int").alias("empresa"),
            "estado",
        )
    )


def post_requests(
    requests: DataFrame,
    journal: JournalTable,
    tables: Tables,
    ctx: RunContext,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run invoices and payments for every request that arrives on the stream.

    A micro-batch that is repeated after a failure is posted once: what it published stays,
    what it staged is published, and only the rest is computed. The notes about it lie in
    the stream's checkpoint.
    """

    def post(batch: DataFrame, batch_id: int) -> None:
        slices = request_slices(batch)
        if slices.days:
            journal.run(tables, slices, ctx, once=f"{checkpoint}/posted/{batch_id}")

    return (
        requests.writeStream.foreachBatch(post)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
