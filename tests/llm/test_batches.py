"""What goes to and from Python workers at a time."""

import numpy as np
import pyarrow as pa

from crisis_posts.llm.shared import map_rows


class Runs:
    """Stands for a table; its partitions are run in this process."""

    def mapInArrow(self, run, schema):
        return run


def test_batches_of_arrays_are_bounded_by_their_bytes(spark):
    def arrays(rows):
        for (number,) in rows:
            yield number, np.full(50_000, number, np.int32), np.full(10, number, np.int64)

    run = map_rows(Runs(), "number long, ids array<int>, keys array<long>", arrays)
    batches = list(run(iter([pa.record_batch({"number": list(range(100))})])))
    assert max(batch.nbytes for batch in batches) < 1_500_000
    rows = [row for batch in batches for row in batch.to_pylist()]
    assert [row["number"] for row in rows] == list(range(100))
    assert all(row["ids"] == [row["number"]] * 50_000 and row["keys"] == [row["number"]] * 10 for row in rows)
