"""Edit similarity of word sequences by banded alignment, many pairs at once."""

from __future__ import annotations

import numpy as np

FAR = np.int32(1 << 29)
#: First width of the band, its growth, and cells of the matrices in which pairs are aligned together.
BAND, WIDER, CELLS = 8, 4, 40_000


def encoded(texts: list[list[str]]) -> list[np.ndarray]:
    """Words as numbers, equal words equal numbers."""
    codes: dict[str, int] = {}
    return [np.fromiter((codes.setdefault(word, len(codes)) for word in text), np.int32, len(text)) for text in texts]


def similar(left: list[np.ndarray], right: list[np.ndarray], least: float) -> np.ndarray:
    """Whether 1 - (word edits / words of the longer text) is ``least`` or more.

    Common beginnings and ends are cut off. A pair is refused at once if its lengths or its words,
    regardless of order, already differ too much. The others are aligned in a narrow band, which
    is widened until the edits found are few enough or the band holds all alignments
    with that many edits, so the answer is exact. Two empty texts are similar.
    """
    result = np.zeros(len(left), bool)
    open_pairs: list[tuple[int, np.ndarray, np.ndarray, int]] = []
    for i, (a, b) in enumerate(zip(left, right)):
        allowed = int((1 - least) * max(len(a), len(b)) + 1e-9)
        if abs(len(a) - len(b)) > allowed:
            continue
        a, b = _trimmed(a, b)
        longer = max(len(a), len(b))
        if longer <= allowed:
            result[i] = True
        elif min(len(a), len(b)) and longer - _common(a, b) <= allowed:
            open_pairs.append((i, a, b, allowed))
    band = BAND
    while open_pairs:
        again = []
        for group in _groups(open_pairs, band):
            width = max(min(band, allowed) + abs(len(a) - len(b)) for _, a, b, allowed in group)
            edits = _edits([a for _, a, _, _ in group], [b for _, _, b, _ in group], width)
            for pair, found in zip(group, edits.tolist()):
                if found <= pair[3]:
                    result[pair[0]] = True
                elif width < pair[3]:
                    again.append(pair)
        open_pairs, band = again, band * WIDER
    return result


def _trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    start = int(differ[0]) if len(differ) else short
    a, b = a[start:], b[start:]
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - short :] != b[len(b) - short :])
    end = short - 1 - int(differ[-1]) if len(differ) else short
    return a[: len(a) - end], b[: len(b) - end]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Words that both have, each as often as the rarer side has it."""
    kinds, code = np.unique(np.concatenate((a, b)), return_inverse=True)
    return int(
        np.minimum(
            np.bincount(code[: len(a)], minlength=len(kinds)), np.bincount(code[len(a) :], minlength=len(kinds))
        ).sum()
    )


def _groups(pairs: list, band: int):
    """Pairs of like length that fill a matrix of CELLS together."""
    group: list = []
    for pair in sorted(pairs, key=lambda p: (len(p[1]), len(p[2]))):
        width = 2 * (min(band, pair[3]) + abs(len(pair[1]) - len(pair[2]))) + 1
        if group and ((len(group) + 1) * width > CELLS or len(pair[1]) > 1.25 * len(group[0][1]) + 8):
            yield group
            group = []
        group.append(pair)
    if group:
        yield group


def _edits(left: list[np.ndarray], right: list[np.ndarray], width: int) -> np.ndarray:
    """Fewest edits among alignments that stay within ``width`` of the diagonal."""
    n = np.array([len(a) for a in left])
    m = np.array([len(b) for b in right])
    rows, span = int(n.max()), 2 * width + 1
    a = np.full((len(left), rows), -1, np.int32)
    b = np.full((len(left), rows + span), -2, np.int32)
    for i, (x, y) in enumerate(zip(left, right)):
        a[i, : len(x)] = x
        y = y[: rows + span - width]
        b[i, width : width + len(y)] = y
    offset = np.arange(span, dtype=np.int32)
    here = np.where(offset >= width, offset - width, FAR)[None, :].repeat(len(left), axis=0).astype(np.int32)
    edits = np.full(len(left), FAR, np.int64)
    ending: dict[int, list[int]] = {}
    for i, length in enumerate(n.tolist()):
        ending.setdefault(length, []).append(i)
    for row in range(1, rows + 1):
        step = here + (b[:, row - 1 : row - 1 + span] != a[:, row - 1 : row])
        np.minimum(step[:, :-1], here[:, 1:] + 1, out=step[:, :-1])
        step -= offset
        np.minimum.accumulate(step, axis=1, out=step)
        step += offset
        here = np.minimum(step, FAR)
        if row in ending:
            who = np.array(ending[row])
            edits[who] = here[who, m[who] - row + width]
    return edits
