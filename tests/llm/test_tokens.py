"""Token ids, token files, packing and sharding against plain computations."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from arearisk.llm import common as C
from arearisk.llm import huffman, packing, ring, tokens
from tests.llm import cases


@pytest.fixture(scope="module")
def encoder():
    return tokens.encoder(tokens.tokenizer_path())


def plain(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_ids_equal_the_library(encoder):
    texts = [t for _, t in cases.texts()]
    for lo, hi, data, offs in C.blocks(pa.array(texts, pa.string()), 3000):
        ids, bounds = encoder.encode(data, offs)
        for i in range(lo, hi):
            assert ids[bounds[i - lo]:bounds[i - lo + 1]].tolist() == plain(encoder, texts[i])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab 1,.'\n\t é日ß　$-_<|>")), max_size=25), max_size=4))
def test_ids_equal_the_library_on_odd_texts(texts):
    enc = tokens.encoder(tokens.tokenizer_path())
    for lo, hi, data, offs in C.blocks(pa.array(texts, pa.string())):
        ids, bounds = enc.encode(data, offs)
        for i in range(lo, hi):
            assert ids[bounds[i - lo]:bounds[i - lo + 1]].tolist() == plain(enc, texts[i])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=600), st.integers(6, 18))
def test_huffman_round_trip(ids, limit):
    ids = np.array(ids, np.uint16)
    counts = np.bincount(ids, minlength=41)
    lengths = huffman.code_lengths(counts, limit)
    assert lengths.max() <= limit and sum(2.0 ** -float(x) for x in lengths if x) <= 1
    payload, marks = huffman.encode(ids, lengths, huffman.canonical(lengths))
    assert huffman.Decoder(lengths).decode(payload, marks, len(ids)).tolist() == ids.tolist()


def test_code_lengths_are_optimal():
    import heapq

    rng = np.random.default_rng(3)
    for n in (2, 3, 17, 300):
        counts = rng.integers(1, 1000, n)
        heap = [(int(c), i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        total, k = 0, n
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            total += a[0] + b[0]
            heapq.heappush(heap, (a[0] + b[0], k))
            k += 1
        assert int((huffman.code_lengths(counts, 30) * counts).sum()) == total
        assert (huffman.code_lengths(counts, 9) > 0).all()
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9, int), 3)


def test_token_files(spark, tmp_path, encoder):
    docs = cases.docs(spark)
    huffman.write_tokens(docs, str(tmp_path / "f"))
    got = huffman.read_digests(spark, str(tmp_path / "f")).collect()
    got.sort(key=lambda r: r.start)
    want = sorted((i, crc(plain(encoder, t) + [2]), len(plain(encoder, t)) + 1) for i, t in cases.texts() if i is not None)
    assert [r.doc_id for r in got[:2]] == [None, None]
    assert [r.doc_id for r in got[2:]] == [w[0] for w in want]
    assert sorted((r.doc_id, r.ids_crc32, r.n_tokens) for r in got[2:]) == want
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    full = {(r.doc_id, r.start): list(r.ids) for r in huffman.read_tokens(spark, str(tmp_path / "f")).collect()}
    assert all(crc(full[(r.doc_id, r.start)]) == r.ids_crc32 for r in got)


def test_token_files_with_a_hot_id_and_without_rows(spark, tmp_path):
    hot = cases.docs(spark, [(5 if k % 3 else k, cases.prose(k, 20)) for k in range(300)])
    huffman.write_tokens(hot, str(tmp_path / "h"))
    got = sorted(huffman.read_digests(spark, str(tmp_path / "h")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(5 if k % 3 else k for k in range(300))
    blocks = spark.read.parquet(str(tmp_path / "h/blocks"))
    assert max(r.n for r in blocks.selectExpr("size(doc_ids) n").collect()) < 200  # the hot id spans several parts
    huffman.write_tokens(cases.docs(spark, []), str(tmp_path / "e"))
    assert huffman.read_digests(spark, str(tmp_path / "e")).count() == 0


def test_token_files_of_large_ids(spark, tmp_path):
    """Ids that doubles cannot tell apart, one of them hot, and many null ids: ascending, and dealt over several parts."""
    top = 1 << 62
    ids = [top + k for k in range(300)] + [top + 7] * 300 + [-top - k for k in range(50)] + [(1 << 63) - 1, -(1 << 63), 0] + [None] * 200
    huffman.write_tokens(cases.docs(spark, [(i, cases.prose(k % 50, 6)) for k, i in enumerate(ids)]), str(tmp_path / "l"))
    got = sorted(huffman.read_digests(spark, str(tmp_path / "l")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None] * 200 + sorted(i for i in ids if i is not None)
    parts = spark.read.parquet(str(tmp_path / "l/blocks")).selectExpr("part", "explode(doc_ids) id")
    assert parts.where(f"id = {top + 7}").select("part").distinct().count() > 1 and parts.where("id IS NULL").select("part").distinct().count() > 1


def packed(df):
    return [r.asDict() for r in df.collect()]


def check_packing(got, texts, encoder):
    want = []
    for i, t in texts:
        ids = plain(encoder, t) + [2]
        head = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(head, len(ids) + 1, 1024)]
        want += [(i, k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=key) == sorted(want, key=key)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(bins)


def test_packing(spark, encoder):
    got = packed(packing.pack_documents(cases.docs(spark)))
    total = sum(r["length"] for r in got)
    assert check_packing(got, cases.texts(), encoder) <= -(-total // 1024) + 1
    assert packing.pack_documents(cases.docs(spark, [])).count() == 0


def test_packing_in_many_lanes(spark, encoder, tmp_path):
    """Copies of one row, full pieces, and lanes of a few pieces; the query runs on the whole table."""
    texts = cases.texts() + [(5, "same few words")] * 300 + [(6, cases.prose(3, 1500))] * 5
    cut = C.cut_lineage(packing.pieces(cases.docs(spark, texts)), "pieces")
    got = packed(packing.pack(cut, lane_rows=7))
    assert check_packing(got, texts, encoder) <= -(-sum(r["length"] for r in got) // 1024) + 1
    d = cases.folder(spark, tmp_path, cases.docs(spark, texts))
    check_packing(packed(packing.op3_packing(spark, d)), texts, encoder)
    huffman_rows = sorted(huffman.op1_token_files(spark, d).collect(), key=lambda r: r.start)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in huffman_rows) == sorted((str(i), len(plain(encoder, t)) + 1, crc(plain(encoder, t) + [2])) for i, t in texts)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=60))
def test_patterns_use_every_piece_and_the_fullest_sum(lengths):
    counts = np.bincount(lengths, minlength=31)
    used = np.zeros(31, int)
    for times, combo in packing.patterns(counts, 30):
        assert sum(k * v for k, v in combo) <= 30
        for k, v in combo:
            used[k] += v * times
    assert (used == counts).all()
    sums = {0}
    for x in lengths:
        sums |= {s + x for s in sums if s + x <= 25}
    assert sum(k * v for k, v in packing.fullest(counts, 25)) == max(sums)


def test_ring(spark):
    docs = cases.docs(spark, [(k if k % 3 else 7, cases.prose(k, 5)) for k in range(1000)] + [(None, None)] * 5)
    from pyspark.sql import functions as F

    rows = docs.select("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("c"))
    got = ring.shard_rows(rows, "doc_id", 8).collect()
    assert len(got) == 1005
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(by) == list(range(8))
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert ring.shard_rows(rows.limit(0), "doc_id", 8).count() == 0


def test_ring_of_clashing_columns_and_many_lanes(spark):
    """A caller's columns of any name pass; a hot key's rows are ranked in lanes."""
    from pyspark.sql import functions as F

    names = ["hash", "arc", "lane", "nth", "rank", "before", "first", "cell", "n"]
    rows = spark.range(900).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), *[F.col("id").alias(n) for n in names])
    got = ring.shard_rows(rows, "doc_id", 5, lane_rows=20).collect()
    assert set(names) <= set(got[0].asDict()) and sorted(r["hash"] for r in got) == list(range(900)) == sorted(r["n"] for r in got)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(len(v) for v in by.values()) == [180] * 5 and all(sorted(v) == list(range(180)) for v in by.values())


def test_sharding_query_against_brute_force(spark, tmp_path):
    """The query's columns, the law, and the shard of every row as bounded loads on the ring give it."""
    from pyspark.sql import functions as F

    texts = cases.texts() + [(5, "same")] * 200
    d = cases.folder(spark, tmp_path, cases.docs(spark, texts))
    got = ring.op2_sharding(spark, d).collect()
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    places = ring.ring_places(8)
    hashes = {r.doc_id: r.h for r in cases.docs(spark, texts).select("doc_id", F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(1 << 32)).alias("h")).collect()}
    home = {i: next((s for p, s in places if p >= h), places[0][1]) for i, h in hashes.items()}
    assert all(r.home_shard == home[r.doc_id] for r in got)
    n = [sum(r.shard == s for r in got) for s in range(8)]
    assert max(n) - min(n) <= 1 and sum(n) == len(texts)
    own = [sum(home[r.doc_id] == s for r in got) for s in range(8)]
    bound = [len(texts) // 8 + (s < len(texts) % 8) for s in range(8)]
    assert sum(r.shard == r.home_shard for r in got) == sum(map(min, own, bound))  # only overflow moves


def test_ring_moves_only_overflow_and_keeps_home_when_it_fits():
    places = ring.ring_places(8)
    owner = np.array([s for _, s in places])
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 50, len(places))
    total = int(counts.sum())
    bounds = np.array([total // 8 + (s < total % 8) for s in range(8)])
    parts = ring.settle(counts, owner, bounds)
    taken, home = np.zeros(8, int), 0
    slots = {s: [] for s in range(8)}
    for arc, rules in enumerate(parts):
        ends = [x[0] for x in rules[1:]] + [int(counts[arc])]
        for (first, shard, slot, _), end in zip(rules, ends):
            slots[shard].append((slot, slot + end - first))
            taken[shard] += end - first
            home += (end - first) * (shard == owner[arc])
    for ranges in slots.values():  # gapless from 0
        assert [a for a, _ in sorted(ranges)] == [0, *[b for _, b in sorted(ranges)][:-1]]
    own = np.bincount(owner, counts, 8)
    assert (taken == bounds).all() and home == int(np.minimum(own, bounds).sum())
    assert set(ring.ring_places(8)) <= set(ring.ring_places(9))  # a ninth shard leaves the other places alone
