"""Source divergence, WARC archives and phrase mining against brute force, with tiny limits so that all spill."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from arearisk.llm import collocations, divergence, warc
from arearisk.session import fresh_path
from tests.llm import cases

SCHEMA = "doc_id long, text string, lang string, source string, rank int, term string, counts long, n long, value long"


def table(spark, rows):
    """(text, lang, source) rows with columns whose names clash."""
    data = [(k, *r, 1, "x", 2, None, 3) for k, r in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(3) if data else spark.createDataFrame([], SCHEMA)


def lower(t):
    return (t or "").translate({k: k + 32 for k in range(65, 91)})


# ---- divergence ---------------------------------------------------------------------------------------------------

def brute_divergence(rows, top):
    docs = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(t)), lang or "", source or "") for t, lang, source in rows]
    out = []
    for lang in {d[1] for d in docs}:
        mine = [d for d in docs if d[1] == lang]
        df = Counter(w for words, _, _ in mine for w in set(words))
        kept = sorted(w for w, n in df.items() if n >= 3)
        count = {s: Counter() for _, _, s in mine}
        for words, _, s in mine:
            count[s].update(w for w in words if df[w] >= 3)
        whole = sum(count.values(), Counter())

        def p(c, w):
            return 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept))

        for s in count:
            pair = [(-sum((p(count[s], w) - p(count[o], w)) ** 2 // p(count[o], w) for w in kept), o.encode(), o) for o in count if o != s]
            term = [(-((p(count[s], w) - p(whole, w)) ** 2 // p(whole, w)), w.encode(), w) for w in kept if count[s][w] > 0 and p(count[s], w) > p(whole, w)]
            out += [(lang, s, "pair", o, -v, k) for k, (v, _, o) in enumerate(sorted(pair), 1)]
            out += [(lang, s, "term", w, -v, k) for k, (v, _, w) in enumerate(sorted(term)[:top], 1)]
    return sorted(out)


def divergence_rows():
    rng = random.Random(5)
    words = ["alpha", "Beta", "été", "ÉTÉ", "日本", "g", "tie", "kin", "z9z", "end"]
    rows = [(" ".join(rng.choice(words[k % 4:]) for _ in range(rng.randint(1, 30))), "en", f"s{k % 4}") for k in range(40)]
    rows += [("only once here", "xx", "a"), ("other words", "xx", "b"), (None, "xx", "c"), ("", None, None), (None, None, "q"), ("1 2 3", "", "q"),
             ("tie kin " * 5000, "en", "s0"), ("tie kin", "en", "sé"), ("tie kin", "en", None), ("alpha\x00beta\x7fgamma ALPHA", "en", "s1")]
    return rows + rows[:3] * 2


@pytest.mark.parametrize("limits,top", [({}, 200), ({"cells": 5, "block": 10}, 3), ({"held": 2, "block": 50}, 4)])
def test_divergence_equals_brute_force(spark, limits, top):
    rows = divergence_rows()
    got = divergence.divergences(table(spark, rows), **limits, terms=top).collect()
    assert sorted(map(tuple, got)) == brute_divergence(rows, top)


def test_divergence_in_small_matrices(spark, monkeypatch):
    monkeypatch.setattr(divergence, "MATRIX", 8)
    rows = divergence_rows()
    assert sorted(map(tuple, divergence.divergences(table(spark, rows), terms=2).collect())) == brute_divergence(rows, 2)


def test_divergence_without_rows(spark):
    assert divergence.divergences(table(spark, [])).count() == 0
    one = divergence.divergences(table(spark, [(None, "en", "a"), ("", "en", "b")])).collect()
    assert sorted(map(tuple, one)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


@given(st.integers(1, 9 * 10**15 - 1), st.data())
def test_scaled_is_exact(total, data):
    count = data.draw(st.integers(0, total))
    assert divergence.scaled(np.array([count]), total)[0] == 10**9 * count // total


# ---- WARC ---------------------------------------------------------------------------------------------------------

def warc_rows():
    same, edge = "<p>" + "same " * 40, "é" * 50
    rows = [(5, "http://a/", same), (3, "http://b/", same), (4, None, same), (None, "http://n/", same), (3, "http://b/", same),
            (6, "u", "x" * 99), (7, "u", "x" * 99), (8, "u", edge), (9, "u", edge), (10, "u\r\nX-Page-ID: 1", None), (11, "u", ""), (None, None, None),
            (12, "http://c/ü?a=b c", "a\r\nb\r\r\n\r\n" * 50), (13, "u", "\r\n"), (14, "u", "WARC/1.1\r\n\r\n0\r\n\r\n"), (15, "u", "日本語ß" * 3000),
            (16, "u", "\r" * 200), (17, "u", "\n" * 200), (18, "u", "\r\n" * 4096), (19, "u", "y" * 300_000), (-2, "u", "y" * 300_000), (20, "u", "\x00\x01" * 60)]
    return rows


def brute_warc(rows):
    out = []
    sizes = [(h or "").encode() for _, _, h in rows]
    for (page, _, _), body in zip(rows, sizes):
        out.append([page, len(body), hashlib.sha256(body).hexdigest(), "response", None])
    for body in set(sizes):
        same = sorted((r for r, b in zip(out, sizes) if b == body), key=lambda r: (r[0] is None, r[0] or 0))
        for r in same[1:] if len(body) >= 100 else []:
            r[3:] = ["revisit", same[0][0]]
    return sorted(map(str, map(tuple, out)))


@pytest.mark.parametrize("chunk", [1 << 16, 3, 128])
def test_archives_round_trip(spark, chunk):
    rows = warc_rows()
    pages = spark.createDataFrame([(*r, 1, "c", True) for r in rows], "page_id long, url string, html string, record long, chunk string, last boolean").repartition(3)
    path = fresh_path(spark, "warc")
    warc.archive_pages(pages, path, chunk=chunk)
    got = warc.read_archives(spark, path).collect()
    number = lambda v: None if v is None else int(v)
    assert sorted(str((number(r.page_id), *r[1:4], number(r.refers_to))) for r in got) == brute_warc(rows)


def test_archives_are_warc_files(spark):
    """An independent reader, by Content-Length alone, finds the same payloads in the files' bytes."""
    rows = warc_rows()
    path = fresh_path(spark, "warc")
    warc.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), path, chunk=100)
    import gzip
    from pathlib import Path

    from arearisk.session import local_path

    bodies, kinds = [], Counter()
    for f in Path(local_path(path)).glob("*.gz"):
        raw, at = gzip.decompress(f.read_bytes()), 0
        while at < len(raw):
            end = raw.index(b"\r\n\r\n", at)
            first, *lines = raw[at:end].decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines)
            assert first == "WARC/1.1" and {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Type"} <= fields.keys()
            block = raw[end + 4:end + 4 + int(fields["Content-Length"])]
            at = end + 4 + len(block) + 4
            assert raw[at - 4:at] == b"\r\n\r\n"
            kinds[fields["WARC-Type"]] += 1
            if fields["WARC-Type"] == "response":
                head, _, rest = block.partition(b"\r\n\r\n")
                body = b""
                while True:
                    size, _, rest = rest.partition(b"\r\n")
                    n = int(size, 16)
                    body += rest[:n]
                    assert rest[n:n + 2] == b"\r\n"
                    rest = rest[n + 2:]
                    if not n:
                        break
                assert not rest and fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(body).hexdigest()
                bodies.append(body)
    want = [(h or "").encode() for _, _, h in rows]
    assert set(bodies) == set(want) and kinds["response"] + kinds["revisit"] == len(rows)


def test_archives_without_rows_and_damage(spark):
    path = fresh_path(spark, "warc")
    warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_archives(spark, path).count() == 0
    good = [b"WARC/1.1", b"WARC-Type: response", b"WARC-Record-ID: <urn:x>", b"WARC-Payload-Digest: sha256:" + hashlib.sha256(b"ab").hexdigest().encode(), b"Content-Length: 9", b"", b"HTTP/1.1 200 OK", b"", b"2"]
    for tail, wrong in (([b"ab", b"0"], False), ([b"ac", b"0"], True), ([b"a"], True)):
        parser = warc.Parser()
        try:
            for piece in good + tail:
                parser.step(piece)
            assert not wrong and len(parser.found) == 1
        except ValueError:
            assert wrong


# ---- collocations -------------------------------------------------------------------------------------------------

def brute_phrases(rows, often, best):
    f, n = Counter(), Counter()
    for text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    found = {}
    every = [(lang, p) for (lang, p), a in f.items() if a >= often and len(p) > 1]
    for lang, p in every:
        a = f[lang, p]
        if any(x == lang and len(q) > len(p) and 100 * f[x, q] >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for x, q in every):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), " ".join(p), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank, text, -a, x, y, n[lang], -s) for lang, v in found.items()
                  for rank, (s, a, _, text, x, y) in enumerate(sorted(v)[:best], 1))


def phrase_rows():
    rng = random.Random(9)
    rows = []
    for k in range(60):
        parts = ["New York City hall", "new york", "a b a b a b a b", "of the", "over and over again now", "é ß\t日 x\x00y"]
        text = "".join(rng.choice(parts) + rng.choice([" ", "  ", ", ", ".", "\n", ":x "]) for _ in range(rng.randint(0, 40)))
        rows.append((text, [None, "en", "und", ""][k % 4], "s"))
    return rows + [(None, "en", None), ("", None, None), ("solo", "zz", "s"), ("tick tock " * 20_000, "en", "s"), ("one  two\tthree", "en", "s")] + rows[:2] * 2


@pytest.mark.parametrize("limits", [{}, {"held": 10, "endings": 10, "burst": 2, "words": 6, "block": 40}, {"held": 3, "endings": 4, "block": 500}])
def test_phrases_equal_brute_force(spark, limits):
    rows = phrase_rows()
    got = collocations.collocations(table(spark, rows), often=6, best=7, **limits).collect()
    assert sorted(map(tuple, got)) == brute_phrases(rows, 6, 7)


def test_phrases_in_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(collocations, "PARTITION", 5000)
    rows = phrase_rows()
    assert sorted(map(tuple, collocations.collocations(table(spark, rows), often=4, best=30).collect())) == brute_phrases(rows, 4, 30)


def test_phrases_with_a_full_bitmap(spark, monkeypatch):
    """Marks that say yes to everything leave the result as it is."""
    monkeypatch.setattr(collocations, "bitmap", lambda frequent, words: np.full(1 << 10, 255, np.uint8))
    rows = phrase_rows()
    assert sorted(map(tuple, collocations.collocations(table(spark, rows), often=6, best=50).collect())) == brute_phrases(rows, 6, 50)


def test_phrases_without_rows(spark):
    assert collocations.collocations(table(spark, [])).count() == 0
    assert collocations.collocations(table(spark, [("a b c", "en", "s")])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 4), min_size=1, max_size=5), st.integers(1, 3)), max_size=60), st.integers(1, 6), st.integers(0, 20))
def test_trie_counts(adds, burst, leave):
    trie, want = collocations.Trie(burst), Counter()
    for phrase, n in adds:
        trie.add(tuple(phrase), n)
        want[tuple(phrase)] += n
    assert trie.size == len(want)
    first = dict(trie.take(trie.largest(leave)))
    assert trie.size <= leave and {p[0] for p in first}.isdisjoint(trie.root)
    rest = dict(trie.take(list(trie.root)))
    assert {**first, **rest} == want and not trie.size


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(1, 5), st.integers(1, 5)), max_size=20), max_size=8), st.integers(0, 20))
def test_shallow_counts(blocks, leave):
    nodes, want = collocations.Shallow(), Counter()
    for block in blocks:
        keys = [a << 32 | b for a, b in block]
        nodes.add(np.array(keys, np.int64))
        want.update(keys)
    first = dict(zip(*(x.tolist() for x in nodes.take(leave))))
    assert nodes.size <= leave and {k >> 32 for k in first}.isdisjoint((nodes.keys >> 32).tolist())
    rest = dict(zip(*(x.tolist() for x in nodes.take(0))))
    assert {**first, **rest} == want and not nodes.size


def test_hashes_are_those_of_spark(spark):
    rows = [("en", "new york"), ("", "é 日"), ("und", "a b")]
    got = spark.createDataFrame(rows, "lang string, phrase string").selectExpr("lang", "phrase", f"{collocations.HASH[1]} AS one", f"{collocations.HASH[2]} AS two").collect()
    for r in got:
        words = collocations.Words(r.lang, None)
        numbers = [words[w.encode()] for w in [r.phrase, *r.phrase.split(" ")]]
        h = np.array(words.hashes, np.uint64)[numbers]
        assert int(h[0]) == r.one % (1 << 64) and int(collocations.pair_hash(h[1:2], h[2:])[0]) == r.two % (1 << 64)
