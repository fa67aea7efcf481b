"""Best window scores of positions, for one Arrow batch of fragment tiles at a time.

It is Python inside Spark tasks. It reports, for every position that can possibly be a
hit, the best wild-type and substituted scores on both strands; which of them are hits is decided
by Spark expressions afterwards. It is shipped by value, so executors need only numpy and pyarrow.
"""

import numpy as np
import pyarrow as pa

# Code of each byte: A, C, G, T in either case are 1 to 4, all others 0.
CODES = np.zeros(256, dtype=np.uint8)
for _code, _letters in enumerate((b"Aa", b"Cc", b"Gg", b"Tt"), start=1):
    CODES[list(_letters)] = _code

FLANK = 29  # fixed value: bases at each end of a fragment that are never reported
FLOOR = -99999.0  # fixed value: score of a position whose windows are all impossible
# Stands for minus infinity. It keeps differences finite, and a sum that holds it is below FLOOR
# whatever the other terms are.
IMPOSSIBLE = -1e6
WORD = 6  # bases looked up at once
BLOCK = 1 << 18  # bases worked on at once, so that the arrays stay in cache
ROWS = 4096  # candidates that leave a task together
SLACK = 1e-6  # rounding allowance when windows are filtered


class Motif:
    """One packed matrix: number, threshold and k x 4 log-odds."""

    def __init__(self, pwmid, threshold, llr):
        self.pwmid = pwmid
        self.threshold = threshold
        forward = np.maximum(np.asarray(llr, dtype=float).reshape(-1, 4), IMPOSSIBLE)
        self.k = len(forward)
        # The reverse strand reads the matrix backwards with complemented bases.
        self.strands = (forward, forward[::-1, ::-1])
        # What the best base at a place adds to a window that has the given letter there.
        self.gains = [m.max(axis=1, keepdims=True) - m for m in self.strands]
        self.reach = float(self.gains[0].max())


def word_values(rows, combine):
    """Value of each WORD-letter word for the rows; letters after the last row do not count."""
    table = np.zeros((4,) * WORD)
    for axis, row in enumerate(rows):
        table = combine(table, row.reshape([4 if a == axis else 1 for a in range(WORD)]))
    return table.ravel()


def window_values(words, at, rows, combine):
    """Value of the windows ``at`` (a slice or an array); ``words[s]`` begins at ``s``."""
    total = None
    for first in range(0, len(rows), WORD):
        table = word_values(rows[first : first + WORD], combine)
        part = np.take(table, words[first:][at], mode="clip")
        total = part if total is None else combine(total, part, out=total)
    return total


def candidate_positions(scores, spoiled, motif, letters, words, centre):
    """Positions where some window reaches the threshold as is or with another base there."""
    need = max(motif.threshold - SLACK, FLOOR)
    found = np.zeros(len(letters), dtype=bool)
    for score, gain in zip(scores, motif.gains):
        at = np.flatnonzero(score >= need - motif.reach)
        if need > 0:
            at = at[~spoiled[at]]
        at = at[score[at] + window_values(words, at, gain, np.maximum) >= need]
        near = score[at]
        for place in range(motif.k):
            reached = near + gain[place][letters[at + place]] >= need
            found[at[reached] + place] = True
    found &= centre
    return np.flatnonzero(found)


def best_scores(positions, scores, spoiled, motif, letters):
    """Wild type, A, C, G, T, each forward and reverse: best over the k windows, ``(10, n)``.

    The entry of the position's own base is of no use: substituting it is no change.
    """
    best = np.full((5, 2, len(positions)), FLOOR)
    letter = letters[positions]
    for place in range(motif.k):
        window = positions - place
        dead = np.flatnonzero(spoiled[window])
        for strand, (score, matrix) in enumerate(zip(scores, motif.strands)):
            whole = score[window]
            np.maximum(best[0, strand], whole, out=best[0, strand])
            rest = whole - matrix[place][letter]
            changed = rest + matrix[place][:, None]
            changed[:, dead] = 0.0
            np.maximum(best[1:, strand], changed, out=best[1:, strand])
    return best.reshape(10, -1)


def scan_block(codes, centre, motifs):
    """Yield ``(motif, positions, scores)`` for the motifs that have candidates in the block."""
    letters = np.maximum(codes, 1).astype(np.intp) - 1
    words = np.zeros(len(codes), dtype=np.intp)
    for step in range(WORD):
        words *= 4
        words[: len(codes) - step] += letters[step:]
    unknown = np.concatenate(([0], np.cumsum(codes == 0)))
    spoiled_by_length = {}
    for motif in motifs:
        k = motif.k
        if k not in spoiled_by_length:
            spoiled_by_length[k] = unknown[k:] > unknown[:-k]
        spoiled = spoiled_by_length[k]
        scores = []
        for matrix in motif.strands:
            score = window_values(words, slice(len(codes) - k + 1), matrix, np.add)
            score[spoiled] = 0.0
            scores.append(score)
        positions = candidate_positions(scores, spoiled, motif, letters, words, centre)
        if len(positions):
            yield motif, positions, best_scores(positions, scores, spoiled, motif, letters)


def blocks(batch):
    """Tiles of the batch, put end to end up to about BLOCK bases at a time.

    A window that crosses two tiles is harmless: it covers only flank bases, and those are masked.
    """
    tiles = batch.column("tile").to_pylist()
    first = 0
    while first < len(tiles):
        last, size = first, 0
        while last < len(tiles) and (size == 0 or size + len(tiles[last]) <= BLOCK):
            size += len(tiles[last])
            last += 1
        codes = CODES[np.frombuffer(b"".join(tiles[first:last]), dtype=np.uint8)]
        begins = np.concatenate(([0], np.cumsum([len(t) for t in tiles[first:last]])))
        centre = np.zeros(size, dtype=bool)
        for begin, end in zip(begins[:-1], begins[1:]):
            centre[begin + FLANK : end - FLANK] = True
        yield batch.slice(first, last - first), codes, begins[:-1], centre
        first = last


def scan_batches(packed, schema):
    """Function for ``mapInArrow``: tiles in, candidate positions with their scores out.

    ``packed`` is a broadcast of the motifs. Batches of rare hits are put together.
    """

    def run(batches):
        pending, held = [], 0
        for found in candidates(batches):
            pending.append(found)
            held += len(found)
            if held >= ROWS:
                yield from pa.Table.from_batches(pending).combine_chunks().to_batches()
                pending, held = [], 0
        if pending:
            yield from pa.Table.from_batches(pending).combine_chunks().to_batches()

    def candidates(batches):
        motifs = [Motif(*m) for m in packed.value]
        for batch in batches:
            for tiles, codes, begins, centre in blocks(batch):
                chunk, start, offset = (
                    tiles.column(name).to_numpy(zero_copy_only=False)
                    for name in ("chunk_id", "start", "offset")
                )
                chromosome = tiles.column("chromosome")
                first = start + offset - begins + 1
                for motif, positions, scores in scan_block(codes, centre, motifs):
                    tile = np.searchsorted(begins, positions, side="right") - 1
                    n = len(positions)
                    yield pa.RecordBatch.from_arrays(
                        [
                            chromosome.take(pa.array(tile)),
                            pa.array(first[tile] + positions),
                            pa.array(chunk[tile]),
                            pa.array(np.full(n, motif.pwmid)),
                            pa.array(np.full(n, motif.threshold)),
                            pa.array(codes[positions].astype(np.int32)),
                            *(pa.array(s) for s in scores),
                        ],
                        names=schema,
                    )

    return run
