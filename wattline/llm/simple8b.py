"""Simple-8b: whole numbers in 64-bit words, decoded by array operations.

The top four bits of a word select how many numbers of how many bits follow (fixed values
below). Numbers are coded in runs of ``RUN``, a multiple of 60, so that equal small numbers fill whole words; an offset tells where the words of each run begin, so
runs decode independently of each other. Within a run each word takes as many numbers as fit; the last one
is filled up with zeros. A number of more than 60 bits is an escape: its word holds the
place of the number in a list at the end.
"""

from __future__ import annotations

import numpy as np

RUN = 240
# Numbers in a word and bits of each, by selector.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 15
#: By the bits of a number, the first selector with room for it; one too many where a float rounds up.
_LEVELS = np.array([next((i for i, room in enumerate(BITS) if bits <= room), ESCAPE) for bits in range(66)], np.uint8)
_TAKES = np.array([*COUNTS, 0, 1, 0], np.int64)
_DONE = 16


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned numbers, coded: three sizes, offsets of the runs, words, escaped numbers."""
    numbers = numbers.astype(np.uint64)
    runs = -(-len(numbers) // RUN)
    flat = np.zeros(runs * RUN, np.uint64)
    flat[: len(numbers)] = numbers
    table = np.zeros((runs, RUN + max(COUNTS)), np.uint64)
    table[:, :RUN] = flat.reshape(runs, RUN)
    level = np.zeros(table.shape, np.uint8)
    level[:, :RUN] = _LEVELS[np.frexp(table[:, :RUN].astype(np.float64))[1]]
    fitting = np.zeros((runs, RUN), np.uint8)
    highest, width = level, 1
    for selector in reversed(range(len(COUNTS))):
        # The highest level among the next COUNTS[selector] numbers, from that of fewer.
        while width < COUNTS[selector]:
            step = min(width, COUNTS[selector] - width)
            wider = highest.copy()
            np.maximum(highest[:, :-step], highest[:, step:], out=wider[:, :-step])
            highest, width = wider, width + step
        fitting += highest[:, :RUN] <= selector
    # What fits into many narrow places fits into fewer wide ones, so the number of fitting selectors tells the first.
    best = np.full((runs, RUN + 1), _DONE, np.uint8)
    best[:, :RUN] = np.where(fitting, len(COUNTS) - fitting, ESCAPE)
    if runs:
        best[-1, len(numbers) - RUN * (runs - 1) :] = _DONE
    # All runs step through their words side by side, each stays at its end.
    at, steps = np.zeros(runs, np.int64), []
    first, best = np.arange(runs) * (RUN + 1), best.ravel()
    while True:
        selector = best[first + at]
        if (selector == _DONE).all():
            break
        steps.append((selector, at))
        at = np.minimum(at + _TAKES[selector], RUN)
    selectors = np.array([selector for selector, _ in steps], np.uint8).reshape(len(steps), runs).T
    starts = np.array([at for _, at in steps], np.int64).reshape(len(steps), runs).T
    real = selectors != _DONE
    offsets = np.concatenate(([0], np.cumsum(real.sum(axis=1))))
    starts = (starts + (np.arange(runs) * table.shape[1])[:, None])[real]
    selectors, table = selectors[real], table.ravel()
    coded = np.zeros(len(selectors), np.uint64)
    for selector, (count, bits) in enumerate(zip(COUNTS, BITS)):
        mine = np.flatnonzero(selectors == selector)
        if len(mine):
            value, start = np.full(len(mine), np.uint64(selector) << np.uint64(60)), starts[mine]
            for i in range(count):
                value |= table[start + i] << np.uint64(i * bits)
            coded[mine] = value
    mine = np.flatnonzero(selectors == ESCAPE)
    escaped = table[starts[mine]]
    coded[mine] = (np.uint64(ESCAPE) << np.uint64(60)) | np.arange(len(mine), dtype=np.uint64)
    sizes = np.array([len(numbers), len(coded), len(escaped)], "<u8")
    parts = (sizes, offsets[:-1].astype("<u4"), coded.astype("<u8"), escaped.astype("<u8"))
    return b"".join(part.tobytes() for part in parts)


def unpack(data: bytes) -> np.ndarray:
    total, n_words, n_escaped = np.frombuffer(data, "<u8", 3).tolist()
    runs = -(-total // RUN)
    offsets = np.frombuffer(data, "<u4", runs, 24).astype(np.int64)
    words = np.frombuffer(data, "<u8", n_words, 24 + 4 * runs)
    escaped = np.frombuffer(data, "<u8", n_escaped, 24 + 4 * runs + 8 * n_words)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    takes = _TAKES[selectors]
    before = np.cumsum(takes) - takes
    run = np.repeat(np.arange(runs), np.diff(np.append(offsets, n_words)))
    start = before - before[offsets][run] + run * RUN if runs else before
    end = np.minimum((run + 1) * RUN, total)
    numbers = np.zeros(total, np.uint64)
    for selector, (count, bits) in enumerate(zip(COUNTS, BITS)):
        mine = np.flatnonzero(selectors == selector)
        mask = np.uint64((1 << bits) - 1)
        for i in range(count if len(mine) else 0):
            place = start[mine] + i
            inside = place < end[mine]
            numbers[place[inside]] = (words[mine[inside]] >> np.uint64(i * bits)) & mask
    mine = np.flatnonzero(selectors == ESCAPE)
    numbers[start[mine]] = escaped[(words[mine] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return numbers
