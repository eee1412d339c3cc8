"""Landing of new files as a stream that stops when it has caught up.

The stream's checkpoint remembers which files were read, so a file is landed once
however often the job is started. A batch that is repeated after a failure replaces
the folders of its own files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from sparkmart.plans.load_job import account_landed, write_landed
from sparkmart.schema import CORRUPT
from sparkmart.sources.files import CSV_OPTIONS, with_corrupt
from sparkmart.sources.store import Store


def land_new_files(store: Store, folder: str) -> None:
    """Lands every delimited file in ``folder`` that was not landed before."""
    reader = store.spark.readStream.options(**CSV_OPTIONS, columnNameOfCorruptRecord=CORRUPT)
    raw = reader.schema(with_corrupt(CORRUPT)).csv(folder)

    def land_batch(batch: DataFrame, _: int) -> None:
        landing = uuid.uuid4().hex
        write_landed(store, batch, landing)
        account_landed(store, landing)

    query = (
        raw.selectExpr("*", "_metadata")
        .writeStream.foreachBatch(land_batch)
        .option("checkpointLocation", store.path("state/landing_stream"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
