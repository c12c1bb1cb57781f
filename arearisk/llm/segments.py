"""Shingle sets and their segment signatures, for the exact Jaccard join in ``segjoin``.

Two sets of sizes a and b with 100 * |intersection| >= 80 * |union| differ in at most H = floor((a + b) / 9) elements.
Sets are put in size bands (each 1.5 times the one before). In the segmentation of band k the universe of shingle
hashes is cut into m_k equal ranges, and a set's elements inside one range are a segment. Where H is 0 linked sets are
equal, and no element is left out. H differences touch at most
H segments, so two linked sets have at least m_k - H equal segments. Sets of band k, and those smaller ones that may be
linked with a set of band k, are indexed in segmentation k.

The allocation is by cost. Per segmentation it is either one signature per segment (each covers one difference, m_k a
little above H), or, where sets are small and such segments would often be empty or single, half as many segments with
their one-deletion neighbourhoods (each covers two). Per set, empty segments cost most, as all sets without elements
there share them: they are left out wherever the remaining equal segments suffice, which ``slack`` tells; the join
does the same for segments that turn out to be frequent.
"""

from __future__ import annotations

import numpy as np

from . import common as C

SHINGLE = 5
#: of 100; the bound H and the band limits below follow from it
SIMILARITY = 80
GROWTH = 1.5
SPARE = 1.3
#: largest size indexed with one-deletion neighbourhoods
SMALL = 24

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SET_A, _SET_B, _PART = np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7), np.uint64(0x2545F4914F6CDD1D)
_FINE = np.uint64(0x6A09E667F3BCC909)


def _shingles(data: np.ndarray, offs: np.ndarray, seed: int) -> tuple:
    """Words (lower-cased bytes, starts, ends, hashes), each text's first word, and each text's number of shingles, the
    first word and the hash of every shingle."""
    low = C.LOWER[data]
    starts, ends, first = C.word_bounds(C.SPACED[data], offs)
    word = C.word_hashes(low, starts, ends, seed)
    n = np.diff(first)
    size = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    rolled = np.zeros(len(word), np.uint64)
    long_ones = len(word) - SHINGLE + 1
    if long_ones > 0:
        h = word[:long_ones].copy()
        for k in range(1, SHINGLE):
            h = h * _STEP + word[k:k + long_ones]
        rolled[:long_ones] = C.mix(h)
    few = np.flatnonzero((n > 0) & (n < SHINGLE))  # the whole sequence as one shingle
    if len(few):
        h = n[few].astype(np.uint64)
        for k in range(SHINGLE - 1):
            at = np.minimum(first[few] + k, len(word) - 1)
            h = np.where(k < n[few], h * _STEP + word[at], h)
        rolled[first[few]] = C.mix(h)
    before = np.cumsum(size) - size
    at = np.arange(int(size.sum())) + np.repeat(first[:-1] - before, size)
    return (low, starts, ends, word), first, size, at, rolled[at]


def _distinct(out: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, and their bounds."""
    bounds = np.append(0, np.cumsum(size))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            out[a:b].sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[bounds[:-1][size > 0]] = True
    return out[fresh], np.concatenate(([0], np.cumsum(fresh)))[bounds]


def shingle_sets(data: np.ndarray, offs: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts, bounds of each text)."""
    _, _, size, _, out = _shingles(data, offs, seed)
    return _distinct(out, size)


def exact_sets(data: np.ndarray, offs: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """As ``shingle_sets``, but two elements of the block are equal only if their words have the same bytes: the words
    and shingles of a block that share a hash are compared, and in a block where any differ shingles are numbered."""
    (low, starts, ends, word), first, size, at, out = _shingles(data, offs, seed)
    if not len(out):
        return _distinct(out, size)
    order = np.argsort(word, kind="stable")
    same = word[order[1:]] == word[order[:-1]]
    number = np.empty(len(word), np.int64)
    number[order] = np.cumsum(np.append(True, ~same))
    pair = np.flatnonzero(same)
    i, j = order[pair], order[pair + 1]
    good = bool(C.same_spans(low, starts[i], ends[i], low, starts[j], ends[j]).all())
    if good:
        length = np.repeat(np.minimum(np.diff(first), SHINGLE), size)  # words of each shingle
        order = np.argsort(out, kind="stable")
        pair = np.flatnonzero(out[order[1:]] == out[order[:-1]])
        i, j = order[pair], order[pair + 1]
        good = bool((length[i] == length[j]).all())
        for k in range(SHINGLE):
            some = length[i] > k
            good = good and bool((number[np.minimum(at[i] + k, len(word) - 1)] == number[np.minimum(at[j] + k, len(word) - 1)])[some].all())
    if good:
        return _distinct(out, size)
    words = [low[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
    known: dict[tuple, int] = {}
    ends_at = np.repeat(first[1:], size)
    return _distinct(np.array([known.setdefault(tuple(words[a:min(a + SHINGLE, b)]), len(known)) for a, b in zip(at.tolist(), ends_at.tolist())], np.uint64), size)


def _sums(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bounds) - 1, np.uint64)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        out[some] = np.add.reduceat(x, bounds[some])
    return out


def set_hashes(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set."""
    n = np.diff(bounds).astype(np.uint64)
    return C.mix(_sums(C.mix(sets ^ _SET_A), bounds) + n), C.mix(_sums(C.mix(sets ^ _SET_B), bounds) ^ n)


def band_tops() -> np.ndarray:
    """Largest size of each band; band 0 holds size 1."""
    tops = [1]
    while tops[-1] < 1 << 40:
        tops.append(max(tops[-1] + 1, int(tops[-1] * GROWTH)))
    return np.array(tops, np.int64)


TOPS = band_tops()
_H = 2 * TOPS // 9
_DELETING = TOPS <= SMALL
#: segments of each segmentation
PARTS = np.where(_DELETING, _H // 2 + 1, np.ceil((_H + 1) * SPARE).astype(np.int64) + 1)


def most_differences(size: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Largest symmetric difference of a linked pair that a set of this size is in, within a segmentation."""
    return (size + np.minimum(size * 100 // SIMILARITY, TOPS[band])) // 9


def least_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many segments other than empty ones a linked pair of records (n, slack, band) shares at least; 0 where
    that says nothing (one-deletion neighbourhoods, sets with too many empty segments)."""
    band, x, y = a["band"].astype(np.int64), a["n"].astype(np.int64), b["n"].astype(np.int64)
    empty = [PARTS[band] - most_differences(n, band) - r["slack"] for n, r in ((x, a), (y, b))]
    need = PARTS[band] - (x + y) // 9 - np.minimum(*empty)
    told = ~_DELETING[band] & (a["slack"] > 0) & (b["slack"] > 0) & (a["slack"] < 32767) & (b["slack"] < 32767)
    return np.where(told, np.maximum(need, 0), 0)


def _entries(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(set, band) of each segmentation that a set is indexed in."""
    own = np.searchsorted(TOPS, np.maximum(size, 1))
    some = np.flatnonzero(size)
    entry, band, k = [some], [own[some]], own[some]
    for step in (1, 2):  # larger partners may be in the next bands
        reach = size[some] * 100 // SIMILARITY > TOPS[k + step - 1]
        entry.append(some[reach])
        band.append(k[reach] + step)
    entry, band = np.concatenate(entry), np.concatenate(band)
    order = np.argsort(entry, kind="stable")
    return entry[order], band[order]


def _segmented(sets: np.ndarray, bounds: np.ndarray, entry: np.ndarray, parts: np.ndarray) -> tuple:
    """(element, its entry, its segment, whether a segment begins) for all elements of all entries."""
    n = np.diff(bounds)[entry]
    total = int(n.sum())
    element = sets[np.arange(total) + np.repeat(bounds[entry] - (np.cumsum(n) - n), n)]
    which = np.repeat(np.arange(len(entry)), n)
    part = ((element >> np.uint64(32)) * parts[which].astype(np.uint64)) >> np.uint64(32)
    fresh = np.ones(total, bool)
    fresh[1:] = (part[1:] != part[:-1]) | (which[1:] != which[:-1])
    return element, which, part, fresh


#: segments of the second level for each difference that is allowed
FINE = 3


def _resorted(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The elements under another hash, in its order, so that the second partition is independent of the first."""
    out = C.mix(sets ^ _FINE)
    which = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return out[np.lexsort((out, which))], bounds


def fine_signatures(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(set, band, slack, signature) of the segments of a second, finer partition: ``FINE`` segments for each difference
    and one more, so that linked sets share two thirds of them and a set may leave out as many, the most frequent ones.
    Empty segments have signatures only where slack is below 1."""
    size = np.diff(bounds)
    entry, band = _entries(size)
    m = FINE * (_H[band] + 1)
    element, which, part, fresh = _segmented(*_resorted(sets, bounds), entry, m)
    first = np.flatnonzero(fresh)
    sums = np.add.reduceat(C.mix(element ^ _PART), first) if len(element) else np.zeros(0, np.uint64)
    owner = which[first]
    empties = m - np.bincount(owner, minlength=len(entry))
    slack = m - most_differences(size[entry], band) - empties
    made = [C.mix(sums ^ C.mix(band[owner].astype(np.uint64) << np.uint64(40) | part[first]) ^ _FINE)]
    owners = [owner]
    for e in np.flatnonzero((slack < 1) & (empties > 0)).tolist():
        bare = np.setdiff1d(np.arange(m[e]), part[first[owner == e]].astype(np.int64))
        made.append(C.mix(C.mix(np.uint64(int(band[e]) << 40) | bare.astype(np.uint64)) ^ _FINE))
        owners.append(np.full(len(bare), e))
    owner = np.concatenate(owners)
    return entry[owner], band[owner], slack[owner], np.concatenate(made)


def signatures(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(set, band, slack, first signature) of each (set, segmentation), and the signatures.

    slack: how many more segments may be left out than are; below 1 nothing is, and empty segments have signatures.
    """
    entry, band = _entries(np.diff(bounds))
    n, m = np.diff(bounds)[entry], PARTS[band]
    total = int(n.sum())
    element, which, part, fresh = _segmented(sets, bounds, entry, m)
    first = np.flatnonzero(fresh)
    value = C.mix(element ^ _PART)
    sums = np.add.reduceat(value, first) if total else np.zeros(0, np.uint64)
    seg_entry, seg_part = which[first], part[first]
    seed = C.mix(band[seg_entry].astype(np.uint64) << np.uint64(40) | seg_part) if total else np.zeros(0, np.uint64)
    empties = m - np.bincount(seg_entry, minlength=len(entry))
    deleting = _DELETING[band]
    slack = np.where(deleting, 0, m - most_differences(n, band) - empties)

    made, owner = [C.mix(sums ^ seed)], [seg_entry]
    less = np.flatnonzero((deleting & (_H[band] > 0))[which])  # each element of a small set deleted from its segment
    if len(less):
        seg = (np.cumsum(fresh) - 1)[less]
        made.append(C.mix((sums[seg] - value[less]) ^ seed[seg]))
        owner.append(which[less])
    bare = np.flatnonzero((slack <= 0) & (empties > 0))
    if len(bare):  # few and small sets: their empty segments count
        miss = np.ones((len(bare), int(m[bare].max())), bool)
        miss &= np.arange(miss.shape[1]) < m[bare][:, None]
        place = np.full(len(entry), -1)
        place[bare] = np.arange(len(bare))
        inside = place[seg_entry] >= 0
        miss[place[seg_entry[inside]], seg_part[inside].astype(np.int64)] = False
        row, col = np.nonzero(miss)
        made.append(C.mix(C.mix(band[bare[row]].astype(np.uint64) << np.uint64(40) | col.astype(np.uint64))))
        owner.append(bare[row])
    made, owner = np.concatenate(made), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return entry, band, slack, np.append(0, np.cumsum(np.bincount(owner, minlength=len(entry)))), made[order]


# ---- exact checks ----------------------------------------------------------------------------------------------

def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted distinct sets reach the similarity."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= SIMILARITY * (len(a) + len(b) - common)


def parity_maps(sets: np.ndarray, bounds: np.ndarray, bits: int) -> np.ndarray:
    """One bitmap a set: bit (hash mod ``bits``) is the parity of the elements there. Two sets differ in at least as
    many elements as their bitmaps differ in bits."""
    n = len(bounds) - 1
    which = np.repeat(np.arange(n), np.diff(bounds))
    flat = np.bincount(which * bits + (sets % np.uint64(bits)).astype(np.int64), minlength=n * bits) & 1
    return np.packbits(flat.astype(np.uint8).reshape(n, bits), axis=1).view(np.uint64)
