"""Blocks of ids under a static range asymmetric numeral system.

A table shared by all blocks gives every id its share of 2**bits slots. A block encodes its ids
on LANES interleaved states of 64 bits that share one stream of 32-bit words: id t belongs to
lane t % LANES and step t // LANES. Blocks depend on nothing but the table. Checkpoints store
the states and the place in the stream before every CHECKPOINT-th step, so that a decoder can
start there; all stretches between checkpoints of many blocks are decoded at the same time, as
arrays. CRCs cover the stream and the ids.

Layout of a block, all little-endian unsigned (fixed values): the magic "FLR1"; ids (8 bytes);
words (4); checkpoints (4); CRC of ids (4); CRC of all else (4); then per checkpoint its place in
the stream (4 bytes each), the checkpoints' states (LANES of 8 bytes each), the words (4 bytes each).
"""

from __future__ import annotations

import struct
from zlib import crc32

import numpy as np

LANES = 32
CHECKPOINT = 512  # steps
MAGIC = b"FLR1"
HEADER = struct.Struct("<4sQIII")
CRC = struct.Struct("<I")
HEAD = HEADER.size + CRC.size
LOW = np.uint64(1 << 31)  # states stay from here to 2**63
WORD = np.uint64(32)
MASK = np.uint64(0xFFFFFFFF)
# Ids of blocks that are encoded together; a larger block is encoded by itself.
IDS_TOGETHER = 1 << 21


class Table:
    """ids (ascending) and their frequencies, which sum to 2**bits."""

    def __init__(self, ids: np.ndarray, frequencies: np.ndarray):
        self.ids, self.frequencies = np.asarray(ids, np.uint32), np.asarray(frequencies, np.uint64)
        total = int(self.frequencies.sum())
        if total & (total - 1) or not total:
            raise ValueError("the frequencies must sum to a power of two")
        self.bits = np.uint64(total.bit_length() - 1)
        self.starts = np.cumsum(self.frequencies) - self.frequencies
        self.limits = self.frequencies << np.uint64(63) - self.bits  # a state at or above writes a word
        self.place = np.full(int(self.ids[-1]) + 1, -1, np.int32)
        self.place[self.ids] = np.arange(len(self.ids))
        self.symbol = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.frequencies.astype(np.int64))

    @classmethod
    def of_counts(cls, ids: np.ndarray, counts: np.ndarray, bits: int = 20) -> Table:
        """Frequencies near the counts' shares, at least one for every id."""
        order = np.argsort(ids)
        ids, counts = np.asarray(ids)[order], np.asarray(counts, np.float64)[order]
        bits = max(bits, (2 * len(ids) - 1).bit_length())
        spare = (1 << bits) - len(ids)
        share = counts / counts.sum() * spare
        extra = np.floor(share).astype(np.int64)
        rest = spare - int(extra.sum())
        extra[np.argsort(extra - share, kind="stable")[:rest]] += 1  # the largest remainders
        return cls(ids, extra + 1)


def encode(blocks: list[np.ndarray], table: Table) -> list[bytes]:
    """One block of bytes for each array of ids."""
    out: list[bytes] = []
    i = 0
    while i < len(blocks):
        j, longest = i + 1, len(blocks[i])
        while j < len(blocks) and max(longest, len(blocks[j])) * (j + 1 - i) <= IDS_TOGETHER:
            longest = max(longest, len(blocks[j]))
            j += 1
        out += _encode(blocks[i:j], table)
        i = j
    return out


def _encode(blocks: list[np.ndarray], table: Table) -> list[bytes]:
    sizes = np.array([len(b) for b in blocks], np.int64)
    steps = -(-sizes // LANES)
    n, deep = len(blocks), int(steps.max(initial=0))
    symbols = np.full((n, deep * LANES), -1, np.int32)
    for i, ids in enumerate(blocks):
        if len(ids) and ids.max() >= len(table.place):
            raise ValueError("an id is not in the table")
        symbols[i, :len(ids)] = table.place[ids]
        if (symbols[i, :len(ids)] < 0).any():
            raise ValueError("an id is not in the table")
    symbols = np.ascontiguousarray(symbols.reshape(n, deep, LANES).transpose(1, 0, 2).reshape(deep, n * LANES))
    whole = int(sizes.min()) // LANES  # steps before this one have an id on every lane
    every = np.arange(n * LANES)
    state = np.full(n * LANES, LOW, np.uint64)
    block_of = np.repeat(np.arange(n), LANES)
    written = np.zeros(n, np.int64)
    words, owners = [], []
    states: list[list[np.ndarray]] = [[] for _ in blocks]
    places: list[list[int]] = [[] for _ in blocks]
    for step in range(deep - 1, -1, -1):
        s, lanes, x = symbols[step], every, state
        if step >= whole:
            lanes = np.flatnonzero(s >= 0)
            s, x = s[lanes], state[lanes]
        full = np.flatnonzero(x >= table.limits[s])
        if len(full):
            # the decoder takes words lane by lane, so they are written in the opposite order
            which = lanes[full[::-1]]
            words.append((state[which] & MASK).astype(np.uint32))
            owners.append(block_of[which])
            written += np.bincount(owners[-1], minlength=n)
            if step < whole:
                x = x.copy()
            x[full] >>= WORD
        f = table.frequencies[s]
        times = x // f
        x = (times << table.bits) + (x - times * f) + table.starts[s]
        if step < whole:
            state = x
        else:
            state[lanes] = x
        if step % CHECKPOINT == 0:
            for i in np.flatnonzero(steps > step):
                states[i].append(state[i * LANES:(i + 1) * LANES].copy())
                places[i].append(int(written[i]))
    owner = np.concatenate([*owners, np.empty(0, np.int64)])
    order = np.argsort(owner, kind="stable")
    words = np.concatenate([*words, np.empty(0, np.uint32)])[order]
    ends = np.searchsorted(owner[order], np.arange(n), side="right")
    out = []
    for i, ids in enumerate(blocks):
        mine = words[ends[i] - written[i]:ends[i]][::-1]  # first step first
        at = written[i] - np.array(places[i][::-1], np.int64)
        body = at.astype("<u4").tobytes() + np.array(states[i][::-1], "<u8").tobytes() + mine.astype("<u4").tobytes()
        ids_crc = crc32(np.asarray(ids, "<u4").tobytes())
        head = HEADER.pack(MAGIC, len(ids), len(mine), len(at), ids_crc)
        out.append(head + CRC.pack(crc32(body, crc32(head))) + body)
    return out


def read(block: bytes) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
    """Number of ids, their CRC, the checkpoints' places and states, the words; checked."""
    if len(block) < HEAD or not block.startswith(MAGIC):
        raise ValueError("not a block")
    _, n, n_words, points, ids_crc = HEADER.unpack_from(block)
    body = memoryview(block)[HEAD:]
    if crc32(body, crc32(block[:HEADER.size])) != CRC.unpack_from(block, HEADER.size)[0]:
        raise ValueError("a block is damaged")
    places = np.frombuffer(body, "<u4", points)
    states = np.frombuffer(body, "<u8", points * LANES, 4 * points).reshape(points, LANES)
    words = np.frombuffer(body, "<u4", n_words, points * (4 + 8 * LANES))
    return n, ids_crc, places, states, words


def stretches(parsed: list) -> list[tuple[int, int]]:
    return [(i, k) for i, (n, _, places, _, _) in enumerate(parsed) for k in range(len(places))]


def decode_stretches(parsed: list, chosen: list[tuple[int, int]], table: Table) -> list[np.ndarray]:
    """The ids between checkpoints: for each (block, checkpoint), up to the next checkpoint."""
    if not chosen:
        return []
    base = np.cumsum([0] + [len(p[4]) for p in parsed])
    stream = np.concatenate([*(p[4] for p in parsed), np.zeros(1, np.uint32)]).astype(np.uint64)
    size = np.array([min(parsed[i][0] - k * CHECKPOINT * LANES, CHECKPOINT * LANES) for i, k in chosen], np.int64)
    place = np.array([base[i] + parsed[i][2][k] for i, k in chosen], np.int64)
    state = np.concatenate([parsed[i][3][k] for i, k in chosen]).astype(np.uint64)
    order = np.argsort(-size, kind="stable")  # long ones first: the others end behind them
    size, place, state = size[order], place[order], state.reshape(-1, LANES)[order].ravel()
    deep = int(-(-size[0] // LANES))
    out = np.zeros((deep, len(chosen) * LANES), np.uint32)
    slots = (np.uint64(1) << table.bits) - np.uint64(1)
    lane = np.arange(LANES)
    for step in range(deep):
        left = size - step * LANES
        n = int(np.searchsorted(-left, 0))  # stretches that go on
        whole = bool(left[n - 1] >= LANES)
        x = state[:n * LANES]
        slot = x & slots
        s = table.symbol[slot.view(np.int64)]
        new = table.frequencies[s] * (x >> table.bits) + slot - table.starts[s]
        if not whole:
            live = (lane < left[:n, None]).ravel()
            new = np.where(live, new, x)
        low = new < LOW
        if not whole:
            low &= live
        if low.any():
            low = low.reshape(n, LANES)
            taken = low.sum(1)
            at = (place[:n, None] + np.cumsum(low, 1) - 1)[low]
            low = low.ravel()
            new[low] = new[low] << WORD | stream[at]
            place[:n] += taken
        state[:n * LANES] = new
        out[step, :n * LANES] = table.ids[s]
    rows = out.reshape(deep, len(chosen), LANES).transpose(1, 0, 2).reshape(len(chosen), -1)
    found: list = [None] * len(chosen)
    for row, i in enumerate(order.tolist()):
        found[i] = rows[row, :size[row]]
    return found


def decode(blocks: list[bytes], table: Table) -> list[np.ndarray]:
    """The ids of each block; their CRCs are checked."""
    parsed = [read(b) for b in blocks]
    parts: list[list[np.ndarray]] = [[] for _ in blocks]
    chosen = stretches(parsed)
    together = max(1, IDS_TOGETHER // (CHECKPOINT * LANES))
    for k in range(0, len(chosen), together):
        for (i, _), ids in zip(chosen[k:k + together], decode_stretches(parsed, chosen[k:k + together], table)):
            parts[i].append(ids)
    out = [np.concatenate([*p, np.empty(0, np.uint32)]) for p in parts]
    for ids, p in zip(out, parsed):
        if crc32(ids.astype("<u4").tobytes()) != p[1]:
            raise ValueError("a block's ids differ from those that were written")
    return out
