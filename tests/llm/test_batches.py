"""Batches for Python workers are bounded, since each is held several times outside of the heap."""

import pyarrow as pa

from tallyframe.llm.work import BATCH, Workspace


def test_batches_are_small(spark):
    Workspace(spark, "t")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "size"])

    for width, count in ((1, 9000), (8000, 3000)):
        table = spark.range(0, count, 1, 1).selectExpr(f"repeat('x', {width}) AS text")
        got = table.mapInArrow(sizes, "rows long, size long").collect()
        assert sum(r["rows"] for r in got) == count
        assert max(r["rows"] for r in got) <= 2000
        assert max(r["size"] for r in got) <= 1.5 * BATCH["spark.sql.execution.arrow.maxBytesPerBatch"]
