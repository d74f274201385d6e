import random

import numpy as np
import pyarrow as pa

from aerolake.llm import sketch


def test_presence_is_a_bit_a_slot_and_misses_nothing(spark):
    rng = random.Random(4)
    keys = [rng.getrandbits(64) - (1 << 63) for _ in range(500)]
    wanted = sketch.present(spark.createDataFrame([(k,) for k in keys], "key long").repartition(4))
    assert wanted.nbytes == sketch.COUNTERS // 8
    rest = [k + 1 for k in keys]
    slot = {k % sketch.COUNTERS for k in keys}
    got = sketch.among(wanted, sketch.slots(pa.array(keys + rest, pa.int64())))
    assert got.tolist() == [True] * 500 + [k % sketch.COUNTERS in slot for k in rest]
    assert int(np.unpackbits(wanted).sum()) == len(slot)


def test_no_keys_are_nowhere(spark):
    assert not sketch.present(spark.createDataFrame([], "key long")).any()


def test_counts_take_two_bytes_and_keep_their_order(spark):
    counts = sketch.sketch(spark.createDataFrame([(7,), (7,), (9,)], "key long"), lambda batch: [batch.column(0).to_numpy()])
    assert counts.nbytes == 2 * sketch.COUNTERS and counts[7] == 2 and counts[9] == 1 and counts.sum() == 3
    some = np.array([0, 1, 2, 32_767, 32_768, 33_000, 40_000, 1 << 20, (1 << 31) - 1], dtype=np.int32)
    assert (np.diff(sketch.heights(some).astype(int)) > 0).all() and (sketch.heights(some[:4]) == some[:4]).all()
