"""Token ids of whole texts through the ``tokenizers`` library, each distinct word encoded once per worker.

Byte-level BPE splits a text before every space that follows a non-space character and between letters, digits and
other signs, so the pieces between such places have the same ids wherever they stand. A worker encodes each new piece with the library, keeps its ids
under a 64-bit hash with a 32-bit check, and builds a text's ids from its pieces by array gathers.
"""

from __future__ import annotations

import os

import numpy as np

from . import common as C

END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
#: pieces above this many bytes are encoded anew each time
LONGEST_KEPT = 256
#: a worker forgets its pieces beyond this many
MOST_KEPT = 500_000

_KEY = C.symbol_table(11)
_CHECK = (C.symbol_table(12) >> np.uint64(20)).astype(np.uint32)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 9, 10, 11, 12, 13, 0x1C, 0x1D, 0x1E, 0x1F]] = True
#: ASCII letters 1, digits 2, other printed characters 3, apostrophe 4; 0: white space, control and non-ASCII
_KIND = np.zeros(256, np.uint8)
for _b in range(0x21, 0x7F):
    _KIND[_b] = 1 if chr(_b).isalpha() else 2 if chr(_b).isdigit() else 4 if _b == 0x27 else 3


def tokenizer_path(name: str = TOKENIZER) -> str:
    """A file name of the public tokenizers, or any path."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_starts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where texts start, spaces after a character that is surely not white space, and changes between ASCII
    letters, digits and other signs (an apostrophe stays with what follows it, for contractions).

    After non-ASCII text only two-byte characters from U+00C0 on count; places left uncut only make a piece longer.
    Texts that hold the string of a special token are not cut between signs: see ``Encoder.encode``.
    """
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        prev, here = data[:-1], data[1:]
        kind = _KIND[data]
        space = here == 0x20
        cut[1:n] = space & ~_WHITE[prev] & (prev < 0x80)
        cut[1:n] |= (kind[:-1] != kind[1:]) & (kind[:-1] - np.uint8(1) < 3) & (kind[1:] > 0) & ~((kind[:-1] == 3) & (kind[1:] == 4))
        if n > 2:
            cut[2:n] |= space[1:] & (data[1:-1] >= 0x80) & (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF)
    cut[offs] = True
    return np.flatnonzero(cut[:n])


class Encoder:
    """Ids of blocks of texts. ``encode`` gives the flat ids and each text's first place among them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(self.size)])
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # the same model without the splitting rule, for pieces that the rule would keep whole
        self.bare = None
        if self.tokenizer.normalizer is None and isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel):
            self.bare = Tokenizer(self.tokenizer.model)
            self.bare.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
        rest = [b for b in range(256) if b not in shown]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)} | {10: "\n"}
        self.forget()

    def forget(self) -> None:
        z = np.zeros(0, np.uint64)
        self.keys, self.checks = z, np.zeros(0, np.uint32)
        self.first, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, self.dtype), 0

    def library(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids by the library, and each piece's first place and length in them.

        One space and letters make one piece of the splitting rule, so many of them go side by side, already split,
        and a token that opens with a space opens the next piece.
        """
        first, length = np.zeros(len(pieces), np.int64), np.full(len(pieces), -1, np.int64)
        flat, used = [], 0
        words = np.array([i for i, p in enumerate(pieces) if p[:1] == b" " and p[1:].decode("utf-8", "replace").isalpha()], np.int64)
        for k in range(0, len(words) if self.bare else 0, 20_000):
            part = words[k:k + 20_000]
            texts = [b"\n".join([pieces[i] for i in part[j:j + 500]]).decode("latin-1").translate(self.letters)
                     for j in range(0, len(part), 500)]
            ids = self._ids(self.bare, texts)[0]
            cuts = np.flatnonzero(self.opens[ids])
            if len(cuts) == len(part) and cuts[0] == 0:
                first[part], length[part] = used + cuts, np.diff(cuts, append=len(ids))
                flat.append(ids)
                used += len(ids)
        rest = np.flatnonzero(length < 0)
        for k in range(0, len(rest), 5_000):
            part = rest[k:k + 5_000]
            ids, sizes = self._ids(self.tokenizer, [pieces[i].decode("utf-8", "replace") for i in part])
            first[part], length[part] = used + np.cumsum(sizes) - sizes, sizes
            flat.append(ids)
            used += len(ids)
        return (np.concatenate(flat) if flat else np.zeros(0, self.dtype)), first, length

    def _ids(self, tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [np.asarray(e.ids, self.dtype) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(got), np.fromiter(map(len, got), np.int64, len(got))

    def _learn(self, data: np.ndarray, a: np.ndarray, b: np.ndarray, keys: np.ndarray, checks: np.ndarray) -> None:
        raw = data.tobytes()
        ids, first, length = self.library([raw[x:y] for x, y in zip(a.tolist(), b.tolist())])
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(ids)] = ids
        first += self.used
        self.used += len(ids)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.checks = np.insert(self.keys, at, keys), np.insert(self.checks, at, checks)
        self.first, self.length = np.insert(self.first, at, first), np.insert(self.length, at, length)

    def _plain(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        ids, sizes = self._ids(self.tokenizer, [raw[x:y].decode("utf-8", "replace") for x, y in zip(offs[:-1].tolist(), offs[1:].tolist())])
        return ids, np.concatenate(([0], np.cumsum(sizes)))

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, self.dtype), np.zeros(len(offs), np.int64)
        if (raw := data.tobytes()) and any(t in raw for t in self.special):
            odd = np.array([any(t in raw[a:b] for t in self.special) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())])
            if odd.all():
                return self._plain(data, offs)
            return self._mixed(data, offs, odd)
        starts = piece_starts(data, offs)
        ends = np.append(starts[1:], len(data))
        if int((ends - starts).max()) > LONGEST_KEPT:
            odd = np.zeros(len(offs) - 1, bool)
            odd[np.searchsorted(offs, starts[ends - starts > LONGEST_KEPT], side="right") - 1] = True
            return self._mixed(data, offs, odd)
        one = C.span_hashes(data, starts, _KEY)
        two = np.add.reduceat(_CHECK[data], starts, dtype=np.uint32) ^ (ends - starts).astype(np.uint32)
        order = np.argsort(one)
        ranked = one[order]
        opens = np.empty(len(one), bool)
        opens[0] = True
        np.not_equal(ranked[1:], ranked[:-1], out=opens[1:])
        keys, at = ranked[opens], order[opens]
        back = np.empty(len(one), np.int64)
        back[order] = np.cumsum(opens) - 1
        checks = two[at]
        if not np.array_equal(checks[back], two):
            return self._plain(data, offs)  # two pieces under one key: the library reads whole texts
        if len(self.keys) > MOST_KEPT:
            self.forget()
        place = np.searchsorted(self.keys, keys)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == keys[known]
        if not known.all():
            new = at[~known]
            self._learn(data, starts[new], ends[new], keys[~known], checks[~known])
            place = np.searchsorted(self.keys, keys)
        if not np.array_equal(self.checks[place], checks):
            return self._plain(data, offs)
        length = self.length[place][back]
        ends_at = np.cumsum(length)
        index = np.repeat(self.first[place][back] - (ends_at - length), length)
        index += np.arange(len(index))
        bounds = np.concatenate(([0], ends_at))[np.searchsorted(starts, offs)]
        return self.flat[index], bounds

    def _mixed(self, data: np.ndarray, offs: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marked texts (a very long piece, a special token's string) go whole to the library."""
        parts, sizes = [], []
        lo = 0
        while lo < len(odd):
            hi = lo + 1
            while hi < len(odd) and odd[hi] == odd[lo]:
                hi += 1
            ids, bounds = (self._plain if odd[lo] else self.encode)(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
            parts.append(ids)
            sizes.append(np.diff(bounds))
            lo = hi
        return np.concatenate(parts), np.concatenate(([0], np.cumsum(np.concatenate(sizes))))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file (kept between tasks)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Append the end id to every text."""
    n = len(bounds) - 1
    out_bounds = bounds + np.arange(n + 1)
    out = np.empty(int(out_bounds[-1]), ids.dtype)
    stop = np.zeros(len(out), bool)
    stop[out_bounds[1:] - 1] = True
    out[stop] = end_id
    out[~stop] = ids
    return out, out_bounds
