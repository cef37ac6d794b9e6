"""Groups of sorted batches."""

import numpy as np
import pyarrow as pa
import pytest

from loanframe.llm.common import bounded_groups, sorted_groups


@pytest.mark.parametrize("seed", range(20))
def test_groups_whole_or_in_pieces(seed):
    rng = np.random.default_rng(seed)
    keys = np.sort(rng.choice([0, 1, 1, 1, 2, 3, 5], rng.integers(1, 60)))
    table = pa.table({"key": keys, "at": np.arange(len(keys))})
    batches = [b for size in (rng.integers(1, 9),) for b in table.to_batches(max_chunksize=int(size))]
    rows = []
    for part, starts, big in bounded_groups(iter(batches), ["key"], 7):
        own = part.column("key").to_numpy()
        rows += part.column("at").to_pylist()
        if big:
            assert len(set(own.tolist())) == 1 and starts.tolist() == [0, len(own)] and (keys == own[0]).sum() > 7
        else:
            for s, e in zip(starts[:-1], starts[1:]):
                assert e - s == (keys == own[s]).sum()
    assert rows == list(range(len(keys)))
    whole = [len(p) for p, s in sorted_groups(iter(batches), ["key"]) for p in np.split(p.column("key").to_numpy(), s[1:-1])]
    assert whole == np.unique(keys, return_counts=True)[1].tolist()
