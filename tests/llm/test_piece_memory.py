"""Byte-level BPE does not carry what one piece of texts took into the next one."""

from pathlib import Path

import numpy as np
import pyarrow as pa

from fundlens.llm.byte_bpe import digested


class Greedy:
    names = np.array(["0"], object)

    def __init__(self):
        self.pinned = []

    def encode(self, texts):
        held = [bytes(2000) for _ in range(100_000)]
        self.pinned.append(bytes(2000))  # above the rest, so that the C library alone keeps it all
        return [np.zeros(len(t), np.int32) for t in texts] if held else []

    def decode(self, ids):
        return [b"" for _ in ids]


def resident_mb() -> float:
    return int(Path("/proc/self/statm").read_text().split()[1]) * 4096 / 1e6


def test_a_piece_gives_its_memory_back():
    before, held = resident_mb(), []
    batch = pa.RecordBatch.from_pylist([{"doc_id": 1, "text": "ab"}, {"doc_id": 2, "text": None}])
    for out in digested(Greedy(), [batch, batch]):
        assert out["n_tokens"].to_pylist() == [2, 0]
        held.append(resident_mb() - before)
    assert len(held) == 2 and max(held) < 60
