"""The percentile chooses the width of a block."""

import numpy as np

from merchweave.llm import token_files


def test_width_is_that_of_the_percentile_and_the_rest_are_exceptions():
    rng = np.random.default_rng(4)
    for n in (1, 7, 100, 1024):
        ids = (rng.pareto(0.4, n) * 50).clip(0, 50_000).astype(np.uint32)
        payload, starts = token_files.pack_ids(ids)
        values = ids - ids.min()
        bits = np.asarray([int(v).bit_length() for v in values])
        want = next(w for w in range(33) if (bits > w).sum() <= n * (100 - token_files.PERCENTILE) / 100)
        head = bytes(payload)[: token_files.HEAD]
        assert head[4] == want and int.from_bytes(head[7:9], "little") == (bits > want).sum()
        assert (token_files.unpack_ids(payload, starts) == ids).all()
