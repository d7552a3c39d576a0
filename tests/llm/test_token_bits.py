"""Ids are packed without a byte for every bit, in the bytes that a plain packing has."""

import tracemalloc

import numpy as np

from merchweave.llm import token_files


def plain(values, w):
    """All values as one number, the first in its lowest bits."""
    whole = sum(int(v) % (1 << w) << (w * i) for i, v in enumerate(values))
    return whole.to_bytes((len(values) * w + 7) // 8, "little")


def test_bytes_are_those_of_a_plain_packing():
    rng = np.random.default_rng(11)
    for w in range(33):
        for n in (1, 8, 13):
            values = rng.integers(0, 1 << 32, (3, n), np.uint32)
            packed = token_files._packed(values, w)
            assert [row.tobytes() for row in packed] == [plain(row, w) for row in values]
            assert (token_files._unpacked(packed, n, w) == values.astype(np.int64) % (1 << w)).all()


def test_a_segment_takes_few_bytes_an_id():
    ids = np.random.default_rng(5).integers(0, 50_000, token_files.SEGMENT).astype(np.uint32)

    def peak(run):
        tracemalloc.start()
        try:
            return run(), tracemalloc.get_traced_memory()[1] / len(ids)
        finally:
            tracemalloc.stop()

    (payload, starts), packing = peak(lambda: token_files.pack_ids(ids))
    found, unpacking = peak(lambda: token_files.unpack_ids(payload, starts))
    assert (found == ids).all()
    print(packing, unpacking)
    assert packing < 40 and unpacking < 24
