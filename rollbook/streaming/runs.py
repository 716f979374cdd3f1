"""Ways to run a stream. A stream keeps its place in its checkpoint, no row locks needed."""


def run_until_current(writer, checkpoint):
    """Work off all that is there now, in batches, then stop."""
    query = (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def run_continuous(writer, checkpoint, every="1 minute"):
    """Start a stream that looks for new files at a fixed interval; the caller stops it."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def save_each_batch(df, path, mode="append", finish=lambda batch: batch):
    """A writer that stores every batch in a folder of its own.

    A batch that runs again after a failure replaces its folder, so nothing is stored twice.
    In ``complete`` mode each folder holds the whole result so far. ``finish`` is applied to
    the batch as an ordinary DataFrame: joins there are re-planned by AQE, which splits a
    key that holds much of the batch.
    """

    def save(batch, batch_id):
        finish(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id:010d}")

    return df.writeStream.outputMode(mode).foreachBatch(save)
