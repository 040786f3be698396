"""What a task of any merge round holds does not grow with the number of partitions."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from costlake.llm import packing


def rounds(partitions, lengths_of, most=64, fan_in=32, window=1024):
    """Windows in the largest group of each round, over the same steps as on the cluster."""
    rng = np.random.default_rng(partitions)
    pieces = []
    for origin in range(partitions):
        for i in range(most):
            pieces.append((origin // fan_in, (origin << 32) + i, 0, int(lengths_of(rng))))
    current = pd.DataFrame(pieces, columns=["group", "sequence_id", "offset", "length"])
    largest, level = [], 1
    while True:
        largest.append(int(current.groupby("group")["sequence_id"].nunique().max()))
        moved = pd.concat([packing._merge(window, most, level)(g) for _, g in current.groupby("group")])
        used = moved.groupby("new_sequence")["length"].sum()
        assert used.max() <= window
        if current["group"].nunique() == 1:
            return largest
        left = moved[moved["open"]]
        assert (used[left["new_sequence"]] < 0.95 * window).all()
        level += 1
        current = pd.DataFrame(
            {
                "group": left["group"] // fan_in, "sequence_id": left["new_sequence"],
                "offset": left["new_offset"], "length": left["length"],
            }
        )


@pytest.mark.parametrize("lengths_of", [lambda r: r.integers(1, 1000), lambda r: 600])
def test_groups_of_every_round_stay_within_a_fixed_number_of_windows(lengths_of):
    for partitions in (32, 256, 1024):
        assert max(rounds(partitions, lengths_of)) <= 32 * 64


def test_texts_are_encoded_in_slices_of_bounded_size():
    """Slices are whole and in order, and only a text that is longer by itself goes over the bytes."""
    rng = np.random.default_rng(3)
    texts = [None if n % 7 == 0 else "ä" * int(n) for n in rng.integers(0, 40_000, 3000)]
    texts[5] = "a" * (packing.TEXT_BYTES + 1)
    texts[2000:] = ["a"] * 2500
    column = pa.array(texts, pa.string())
    slices = list(packing.encoded_at_once(column))
    assert [i for begin, rows in slices for i in range(begin, begin + rows)] == list(range(len(texts)))
    for begin, rows in slices:
        size = sum(len((t or "").encode()) for t in texts[begin : begin + rows])
        assert rows <= packing.DOCUMENTS and (size <= packing.TEXT_BYTES or rows == 1)
    assert list(packing.encoded_at_once(column.slice(0, 0))) == []
