"""Plain definitions that tests hold the kernels and operators against; none of it is fast."""

from collections import Counter

SWAP = dict(zip("ACGT", "TGCA", strict=True))


def other_strand(seq):
    return "".join(SWAP.get(c, c) for c in reversed(seq))


def place(pattern, text):
    """(distance, start, end) of the best place: least distance, then first end, then longest span."""
    # cell[i]: least edits of pattern[:i] to a span that ends here, and the first start of such spans.
    cell = [(i, 0) for i in range(len(pattern) + 1)]
    best = (cell[-1][0], 0, cell[-1][1])
    for end, c in enumerate(text, 1):
        new = [(0, end)]
        for i, p in enumerate(pattern, 1):
            new.append(min((cell[i][0] + 1, cell[i][1]), (new[-1][0] + 1, new[-1][1]), (cell[i - 1][0] + (p != c), cell[i - 1][1])))
        cell = new
        best = min(best, (cell[-1][0], end, cell[-1][1]))
    return best[0], best[2], best[1]


def tiled(unit, ring, least, most):
    """(coverage, mean identity, copies) of one strand: copies are laid one after another, letters under a copy become N."""
    marks, shares, covered = ring, [], 0
    while covered < len(ring) and len(shares) < most:
        distance, start, end = place(unit, marks + marks)
        if 1 - distance / len(unit) < least:
            break
        shares.append(1 - distance / len(unit))
        covered += end - start
        under = {i % len(ring) for i in range(start, end)}
        marks = "".join("N" if i in under else c for i, c in enumerate(marks))
    return min(1.0, covered / len(ring)), sum(shares) / len(shares) if shares else 0.0, len(shares)


def tile(unit, target, least, most):
    one, two = tiled(unit, target, least, most), tiled(unit, other_strand(target), least, most)
    best = two if two[0] > one[0] else one
    return best if best[0] > 0 else (0.0, 0.0, 0)


def turned(seq, anchors, least, enough=0.95):
    """``seq`` as its best anchor would have it, None without one."""
    tries = []
    for start, anchor in anchors:
        for own in (seq, other_strand(seq)):
            distance, at, _ = place(anchor, own * 2)
            shift = (at - start) % len(own)
            tries.append((1 - distance / len(anchor), own[shift:] + own[:shift]))
        if max(share for share, _ in tries) >= enough:
            break
    share, best = max(tries, key=lambda t: t[0], default=(-1, None))
    return best if share >= least else None


def families(seqs, least=0.8, size=3, rounds=15, length=21, offsets=(0.5, 0.25, 0.75, 0.1, 0.9)):
    """Clusters as {position: turned sequence}, in the order found; a round that finds too few uses them up all the same."""
    left, found = dict(enumerate(seqs)), []
    while left and len(left) >= size and rounds:
        rounds -= 1
        median = sorted(map(len, left.values()))[len(left) // 2]
        ref = next(i for i in sorted(left) if len(left[i]) == median)
        starts = [int(median * o) for o in offsets]
        anchors = [(s, seqs[ref][s : s + length]) for s in starts if s + length <= median]
        own = {i: turned(s, anchors, least) for i, s in left.items() if i != ref}
        own = {ref: seqs[ref]} | {i: s for i, s in own.items() if s is not None}
        left = {i: s for i, s in left.items() if i not in own}
        if len(own) >= size:
            found.append(own)
    return found


def voted(columns, gaps):
    """Of each column (a string, ``-`` for a gap) the letters that may win; None for a column that is dropped."""
    out = []
    for column in columns:
        counts = Counter(c for c in column.upper() if c in SWAP)
        kept = counts and column.count("-") < gaps * len(column)
        out.append({c for c, n in counts.items() if n == max(counts.values())} if kept else None)
    return out
