"""Deduplication, joins and decontamination against brute force, and against their SQL."""

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from arearisk.llm import chunkdedup, components, fmindex, registry, segjoin, segments
from arearisk.llm import common as C
from tests.llm import cases
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.QUERIES[name](spark, SF)
    rel = con.sql(registry.ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(list(rel.columns), rel.fetchall())[0]


def squeezed(t):
    return "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")


@pytest.mark.parametrize("bits", [8, 64])
def test_exact_groups(spark, bits):
    """8-bit identifiers are ambiguous, so the pass starts again with wider ones."""
    got = chunkdedup.group_copies(cases.docs(spark), bits=bits).collect()
    groups = {}
    for i, t in cases.texts():
        groups.setdefault(squeezed(t), []).append((-len(t or ""), i is None, i or 0, i))
    import hashlib

    want = {hashlib.sha256(k.encode()).hexdigest(): (len(v), min(v)[3]) for k, v in groups.items()}
    assert len(got) == len(cases.texts())
    for r in got:
        assert (r.group_size, r.keep_id) == want[r.text_sha256]
    assert sum(r.kept for r in got) == len(want)
    assert chunkdedup.group_copies(cases.docs(spark, [])).count() == 0


def test_chunks_depend_on_content_alone():
    import pyarrow as pa

    texts = [cases.prose(k, 3000) for k in range(3)] + [cases.prose(1, 3000)]
    data, offs = C.text_buffers(pa.array(texts))
    ends = chunkdedup.chunk_ends(data, offs)
    rel = [[e - o for e in x] for x, o in zip(ends, offs.tolist())]
    assert rel[1] == rel[3] and all(len(x) > 3 for x in rel)
    alone = chunkdedup.chunk_ends(*C.text_buffers(pa.array([texts[1]])))[0]
    assert alone == rel[1]
    shifted = "abc" + texts[1]
    cut = chunkdedup.chunk_ends(*C.text_buffers(pa.array([shifted])))[0]
    assert len({e - 3 for e in cut} & set(alone)) > len(alone) // 2


def shingles(t):
    words = (t or "").translate({k: k + 32 for k in range(65, 91)})
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", words)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_groups(rows):
    """(shingle set, number of its component) of each row."""
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * either:
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return [(s, find(k)) for k, s in enumerate(sets)]


def brute_components(rows):
    found = brute_groups(rows)
    groups = {}
    for (i, _), (_, g) in zip(rows, found):
        groups.setdefault(g, []).append(i)
    ids = {g: min((x for x in v if x is not None), default=None) for g, v in groups.items()}
    return [(i, len(s), ids[g] if s else i) for (i, _), (s, g) in zip(rows, found)]


def edits(base, seed, share):
    rng = np.random.default_rng(seed)
    w = base.split()
    for k in np.flatnonzero(rng.random(len(w)) < share):
        w[k] = f"edit{seed}x{k}"
    return " ".join(w)


def key(rows):
    return sorted(rows, key=lambda r: tuple(-1 if v is None else v for v in r))


def test_join_equals_brute_force(spark, monkeypatch):
    """Near copies around the threshold in groups beyond the frequent-signature bound and the block size, short texts,
    shared passages, copies, and the awkward rows."""
    monkeypatch.setattr(segjoin, "BLOCK", 16)
    rows = cases.texts()
    n = 100
    for g, words in enumerate((40, 120, 12, 7, 300)):
        base = cases.prose(50 + g, words)
        for k in range(24):
            n += 1
            rows.append((n, edits(base, n, 0.004 + 0.04 * (k % 6) / 5 if words > 20 else 0.08)))
    passage = cases.prose(99, 80)
    for k in range(30):
        n += 1
        rows.append((n, passage + " " + cases.prose(1000 + k, 15 + 4 * k)))
    got = segjoin.near_components(cases.docs(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert key(map(tuple, got)) == key(brute_components(rows))


def test_join_without_rows(spark):
    assert segjoin.near_components(cases.docs(spark, [])).count() == 0
    one = segjoin.near_components(cases.docs(spark, [(1, None), (2, "")])).select("doc_id", "n_shingles", "component_id").collect()
    assert key(map(tuple, one)) == [(1, 0, 1), (2, 0, 2)]


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6), st.floats(0, 0.12))
def test_linked_sets_share_a_signature(size, seed, share):
    """Pigeonhole: any two linked sets meet in a signature, before frequent ones are left out."""
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
    b = np.unique(np.concatenate([a[rng.random(len(a)) >= share], rng.integers(0, 1 << 63, int(share * size), dtype=np.uint64)]))
    if not len(b) or not segments.linked(a, b):
        return
    sets, bounds = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
    entry, band, slack, first, made = segments.signatures(sets, bounds)
    of = {0: set(), 1: set()}
    shared = {}
    for e in range(len(entry)):
        of[entry[e]].update(made[first[e]:first[e + 1]].tolist())
        shared.setdefault(int(band[e]), {})[int(entry[e])] = (set(made[first[e]:first[e + 1]].tolist()), int(slack[e]))
    assert of[0] & of[1]
    rec = np.zeros(2, [("n", "<u4"), ("slack", "<i2"), ("band", "u1")])
    for k, x in shared.items():
        if len(x) == 2:
            rec["n"], rec["slack"], rec["band"] = [len(a), len(b)], [np.clip(x[0][1], 0, 32767), np.clip(x[1][1], 0, 32767)], k
            if max(len(a), len(b)) <= segments.TOPS[k]:
                assert len(x[0][0] & x[1][0]) >= segments.least_shared(rec[:1], rec[1:])[0]


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6), st.floats(0, 0.12), st.integers(0, 30))
def test_linked_sets_share_a_fine_signature_that_neither_leaves_out(size, seed, share, crowd):
    """The second partition, with others that make some of the segments frequent."""
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
    b = np.unique(np.concatenate([a[rng.random(len(a)) >= share], rng.integers(0, 1 << 63, int(share * size), dtype=np.uint64)]))
    if not len(b) or not segments.linked(a, b):
        return
    sets = [a, b] + [np.unique(np.concatenate([a[:int(len(a) * rng.random())], rng.integers(0, 1 << 63, 1 + size // 2, dtype=np.uint64)])) for _ in range(crowd)]
    which, band, slack, made = segments.fine_signatures(np.concatenate(sets), np.append(0, np.cumsum([len(x) for x in sets])))
    often = {int(k): int(n) for k, n in zip(*np.unique(made, return_counts=True))}
    kept = []
    for i in (0, 1):
        mine = set()
        for k in set(band[which == i].tolist()):
            rows = (which == i) & (band == k)
            by = sorted(made[rows].tolist(), key=lambda v: (-often[v], v))
            mine.update(by[max(0, int(slack[rows][0]) - 1):])
        kept.append(mine)
    assert kept[0] & kept[1]


def test_a_passage_in_common_makes_no_blocks(spark):
    """Texts that share a passage of a third of their words meet in frequent segments of the first partition at most."""
    passage = cases.prose(77, 60)
    rows = [(k, cases.prose(2000 + k, 60) + " " + passage + " " + cases.prose(4000 + k, 60)) for k in range(120)]
    docs = cases.docs(spark, rows)
    sets = segjoin.doc_sets(docs)
    nodes = sets.select("node").distinct()
    scratch = C.Scratch(spark)
    texts = scratch.cut(docs.select("doc_id", "text").join(sets.select("doc_id", "node"), "doc_id").select("node", "text"), "texts")
    fine = segjoin.fine_runs(nodes.select(nodes.node.alias("a")), texts, 0, scratch)
    _, edges = segjoin.open_runs(fine, spark.createDataFrame([], "node long, component long"), scratch)
    assert edges.count() == 0
    scratch.drop()
    got = segjoin.near_components(docs).select("doc_id", "component_id").collect()
    assert all(r.doc_id == r.component_id for r in got)


def test_components_of_a_long_path(spark, tmp_path):
    spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (50, 90)], "a long, b long").write.parquet(str(tmp_path / "e"))
    got = {r.node: r.component for r in components.components(spark.read.parquet(str(tmp_path / "e"))).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100, 50: 50, 90: 50}


def thue_morse(n):
    """Two words of letters that polynomial hashes modulo a power of two confuse."""
    one = "a"
    while len(one) < n:
        one += one.translate({97: 98, 98: 97})
    return one, one.translate({97: 98, 98: 97})


def test_words_are_told_apart(spark):
    """Words built to collide, zero bytes, and long words that differ at the end."""
    one, two = thue_morse(1024)
    rows = [(1, "q w e r " + one), (2, "q w e r " + two), (3, "a\x00b c d e f g"), (4, "a b c d e f g"), (5, "a\x00\x00b c d e f g"),
            (6, "s t u v " + "x" * 300 + "y"), (7, "s t u v " + "x" * 300 + "z"), (8, "\x00"), (9, "\x00\x00"), (10, "\x00")]
    got = segjoin.near_components(cases.docs(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert key(map(tuple, got)) == key(brute_components(rows))
    assert {r.doc_id: r.n_shingles for r in got}[3] == 2


def test_verification_does_not_trust_hashes(monkeypatch):
    """With a hash that knows a word's length only, sets still agree where their words do."""
    import pyarrow as pa

    texts = ["ab cd ef gh ij kl", "xx yy zz ww vv uu", "ab cd ef gh ij kl", "ab cd ef gh ij zz", "AB cd", "yy zz", "ab cd", "", "x" * 99, "y" * 99]
    plain = [segments.exact_sets(*C.text_buffers(pa.array([t]))) for t in texts]
    monkeypatch.setattr(C, "word_hashes", lambda low, starts, ends, seed=0: (ends - starts).astype(np.uint64))
    sets, at = segments.exact_sets(*C.text_buffers(pa.array(texts)))
    of = [set(sets[a:b].tolist()) for a, b in zip(at[:-1], at[1:])]
    want = [shingles(t) for t in texts]
    assert [len(x) for x in of] == [len(x) for x in want] == [len(p[0]) for p in plain]
    assert all((len(of[i] & of[j]) == len(want[i] & want[j])) for i in range(len(texts)) for j in range(i))


def test_edges_go_between_components(spark):
    """A frequent signature of sets that are linked already is no edge, one of two components is one edge."""
    runs = spark.createDataFrame([(1, a) for a in range(100)] + [(2, a) for a in range(50)] + [(3, a) for a in (7, 200, 201)], "run long, a long")
    found = spark.createDataFrame([(a, 0 if a < 50 else 50) for a in range(100)], "node long, component long")
    scratch = C.Scratch(spark)
    members, edges = segjoin.open_runs(runs, found, scratch)
    assert key(map(tuple, edges.collect())) == [(0, 50), (0, 200), (0, 201)]
    assert members.count() == 102
    scratch.drop()


def test_buckets_of_any_number_of_sets(monkeypatch):
    """Sorting by both numbers gives what sorting by one does."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    rec = np.zeros(40, segjoin._ENTRY)
    rec["node"], rec["n"], rec["count"], rec["band"] = rng.integers(0, 25, 40), 30, 3, 12
    keys = rng.integers(0, 12, 120).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array([7], pa.int32()), pa.array([segjoin._columns(rec)]), pa.array([keys])], ["bucket", "entries", "keys"])
    out = []
    for owners in (1 << 24, 0):
        monkeypatch.setattr(segjoin, "OWNERS", owners)
        out.append([b.to_pylist() for b in segjoin.match(iter([batch]))])
    order = lambda rows: sorted(str(sorted(r.items(), key=str)) for b in rows for r in b)
    assert out[0] and order(out[0]) == order(out[1])


def words_of(t):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({k: k + 32 for k in range(65, 91)}))


def brute_contamination(rows, bench):
    phrases = {}
    for i, t in bench:
        w = words_of(t)
        k = min(10, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            phrases.setdefault(tuple(w[j:j + k]), set()).add(str(i) if i is not None else "")
    import hashlib

    out = []
    for i, t in rows:
        w, hit, items = words_of(t), set(), set()
        for p, owners in phrases.items():
            for j in range(len(w) - len(p) + 1):
                if tuple(w[j:j + len(p)]) == p:
                    hit.update(range(j, j + len(p)))
                    items |= owners
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return out


def contaminated_rows():
    one, two = cases.prose(7, 40), cases.prose(8, 12)
    rows = cases.texts() + [(30, cases.prose(9, 50) + " " + one.upper() + ", " + cases.prose(10, 20)), (31, two), (32, two + " " + two),
                            (33, " ".join(two.split()[:9])), (34, one + "\n" + one), (35, "x short item y"), (36, "short"), (37, "Item short item")]
    bench = [(1, one), (2, two), (3, "short item"), (3, "short item"), (4, None), (5, ""), (None, " ".join(one.split()[5:30])), (6, two), (7, "éa ß日 9")]
    return rows + [(38, "zz éa ß日 9 zz")], bench


@pytest.mark.parametrize("group_bytes", [1 << 20, 100])
def test_contamination_equals_brute_force(spark, monkeypatch, group_bytes):
    monkeypatch.setattr(fmindex, "GROUP_BYTES", group_bytes)
    rows, bench = contaminated_rows()
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = fmindex.contamination(cases.docs(spark, rows), b).drop("spans").collect()
    assert key(map(tuple, got)) == key(brute_contamination(rows, bench))


def test_occurrences_are_compared_by_bytes(spark, monkeypatch):
    real = C.word_hashes
    rows = [(1, "one secretA two"), (2, "one secretB two"), (3, "one secreta two"), (4, "x one secretb two y"), (5, "one secretc three")]
    bench = [("i", "one secretA two")]
    # all words of seven letters collide, whatever the seed
    monkeypatch.setattr(C, "word_hashes", lambda low, starts, ends, seed=0: np.where(ends - starts == 7, np.uint64(5), real(low, starts, ends, seed)))
    import pyarrow as pa

    what = fmindex.phrases(bench)
    hit, _, _, first, items = fmindex.scan(*C.text_buffers(pa.array([t for _, t in rows])), what)
    got = [int(hit[a:b].sum()) for a, b in zip(first[:-1], first[1:])]
    assert got == [c[2] for c in brute_contamination(rows, bench)] == [3, 0, 3, 0, 0]
    # two words of the benchmark collide under the first seed, so another is taken
    monkeypatch.setattr(C, "word_hashes", lambda low, starts, ends, seed=0: (ends - starts).astype(np.uint64) if seed == 0 else real(low, starts, ends, seed))
    what = fmindex.phrases([("i", "ab cd ef"), ("j", "gh ij")])
    assert what.seed == 1 and len(what.vocabulary) == 5


def test_words_built_to_collide_are_no_hit(spark):
    one, two = thue_morse(1024)
    rows, bench = [(1, "see " + one), (2, "see " + two), (3, one)], [(1, one)]
    got = fmindex.contamination(cases.docs(spark, rows), spark.createDataFrame(bench, "item_id long, text string")).drop("spans").collect()
    assert key(map(tuple, got)) == key(brute_contamination(rows, bench))


def test_a_hot_item_is_dealt_over_groups(spark, monkeypatch):
    """All texts under one id, in groups of one or two texts: every group is searched and the id counts once."""
    monkeypatch.setattr(fmindex, "GROUP_BYTES", 150)
    texts = [cases.prose(900 + k, 14) for k in range(12)]
    bench = [(7, t) for t in texts] * 3 + [(8, texts[3])]
    rows = [(k, cases.prose(k, 9) + " " + " ".join(texts[k % 12:k % 12 + 1 + k % 3])) for k in range(30)] + [(0, cases.prose(0, 9))] * 4 + cases.texts()
    b = spark.createDataFrame(bench, "item_id long, text string")
    groups, made = fmindex.phrase_groups(b)
    assert groups > 4 and max(len(x.low) for x in made) < 600
    got = fmindex.contamination(cases.docs(spark, rows), b).drop("spans").collect()
    assert key(map(tuple, got)) == key(brute_contamination(rows, bench))


@pytest.mark.parametrize("group_bytes", [1 << 20, 100])
def test_spans_go_and_clean_rows_stay(spark, monkeypatch, group_bytes):
    monkeypatch.setattr(fmindex, "GROUP_BYTES", group_bytes)
    rows, bench = contaminated_rows()
    b = spark.createDataFrame(bench, "item_id long, text string")
    docs = cases.docs(spark, rows)
    out = fmindex.remove_spans(docs, b)
    assert out.columns == docs.columns
    left = [(r.doc_id, r.text) for r in out.collect()]
    dirty = {(i, t) for (i, t), c in zip(rows, brute_contamination(rows, bench)) if c[5]}
    assert {x for x in left} >= {x for x in rows if x not in dirty}
    assert not any(c[5] for c in brute_contamination(left, bench))
    assert all(r.n_chars == len(r.text) for r in out.collect() if r.text)
    assert 31 not in {i for i, _ in left}  # nothing but a passage
    none = fmindex.remove_spans(docs, b.limit(0))
    assert none.count() == docs.count()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=12), min_size=1, max_size=6), st.lists(st.integers(1, 4), min_size=1, max_size=4))
def test_index_finds_every_place(pieces, pattern):
    seq = np.array([x for p in pieces for x in [*p, 0]], np.int64)
    index = fmindex.FMIndex(seq, 4)
    which, low, high = index.search(np.array([pattern]))
    found = index.locate(np.arange(low[0], high[0])).tolist() if len(which) else []
    k = len(pattern)
    assert sorted(found) == [i for i in range(len(seq) - k + 1) if seq[i:i + k].tolist() == pattern]


def test_large_bucket_sorted_in_ranges(monkeypatch):
    """A bucket sorted range by range gives the frequent members and shared counts that one sort gives."""
    import pyarrow as pa
    from collections import Counter

    rng = np.random.default_rng(5)
    rec = np.zeros(300, segjoin._ENTRY)
    rec["node"], rec["n"], rec["count"], rec["band"], rec["slack"] = rng.integers(0, 90, 300), 300, 4, 15, 2
    keys = rng.integers(0, 260, 1200).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array([3], pa.int32()), pa.array([segjoin._columns(rec)]), pa.array([keys])], ["bucket", "entries", "keys"])
    out = []
    for most in (1 << 19, 100):
        monkeypatch.setattr(segjoin, "SORTED", most)
        batches = list(segjoin.match(iter([batch])))
        assert (len(batches) > 5) == (most == 100)
        rows = [r for b in batches for r in b.to_pylist()]
        shared = Counter()
        for r in rows:
            if r["run"] is None:
                shared[r["a"], r["b"], r["band"], r["slack"]] += r["members"]
        out.append((shared, Counter(tuple(r.values()) for r in rows if r["run"] is not None)))
    assert out[0] == out[1] and out[0][0] and out[0][1]


def test_buckets_grow_less_than_their_entries():
    """A set has an entry in each bucket that it falls into: 0.5 GB of text (125 million shingles) makes few buckets, and
    packed entries come back as they were."""
    assert segjoin.bucket_count(125_000_000, 6) <= 40 and segjoin.bucket_count(7_500_000_000, 6) <= 2000
    assert segjoin.bucket_count(0, 6) == 1 and segjoin.bucket_count(25_000_000, 6) == 12
    rec = np.zeros(500, segjoin._ENTRY)
    rng = np.random.default_rng(1)
    for f, top in (("node", 1 << 63), ("n", 20_000), ("slack", 300), ("count", 4), ("band", 20)):
        rec[f] = rng.integers(0, top, 500)
    rec["slack"][::7] = -3
    raw = segjoin._columns(rec)
    assert (segjoin._entries(raw) == rec).all()
    import pyarrow as pa

    assert len(pa.compress(raw, "lz4_raw", asbytes=True)) < 14 * len(rec)
