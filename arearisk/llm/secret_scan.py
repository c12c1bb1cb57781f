"""Secret scans with SQL functions only: fixed patterns, and a battery of randomness tests on long tokens.

Fixed kinds are found by pattern; a match's place comes from running sums over the lengths of the pieces between
matches. Besides them, every maximal token of at least ``SHORTEST`` characters of a base-64 alphabet is tested, and its
parts between "/", "-" and "_" that are as long. A token's encoding is inferred (hexadecimal, base 32, else base 64), and
on the symbols' values in that alphabet run

* a chi-squared test of uniformity (normal by Wilson-Hilferty),
* a runs test about the middle of the alphabet,
* a lag-one serial correlation test.

A token that fails any at ``ALPHA`` is no random string. For the others the three statistics are read against ordinary
text: symbols repeat in it far more often (chi-squared, as the rate of equal pairs), the values cross the middle less
often (runs) and stay closer to their neighbours (serial correlation); and changes between capitals, small letters and
digits are far rarer. The deviations, scaled by what the token's length allows, are combined (Stouffer, weights
``WEIGHTS``) to a p-value under "ordinary token". Benjamini-Hochberg at ``RATE`` over all tokens of the corpus, within each
length band, decides: p-values fall into equal bins of their logarithm, so the control needs one count per band and bin
(a bounded table) and no sort of all tokens.

Work grows with the text and, times a logarithm, with its matches: running sums are made by doubling, and tokens meet the
fixed kinds' spans in one sorted list.

Defined results: a null or empty text has no spans. Repeated rows are scanned each. An empty table gives an empty
result. Places are code points, ends exclusive. A token that overlaps a fixed kind's span is not added, a part of it that
does not may be; a part inside a found token is not added again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: a maximal run of which enough is long enough is the run itself, so these hold the least length
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
SHORTEST = 12
TOKEN = r"[A-Za-z0-9+/_-]{12,}={0,2}"
PART = r"[A-Za-z0-9+]{12,}={0,2}"
ALPHA = 0.001
RATE = 0.01
#: ordinary words: rate of equal letter pairs, sum of cubed letter shares, share of neighbours of different class
PAIR_RATE, CUBES, CHANGES = 0.065, 0.0055, 0.15
#: of ordinary tokens: share of neighbours on different sides of the alphabet's middle, correlation of neighbours
CROSSINGS, NEIGHBOURS = 0.4, 0.2
#: of the deviations of pairs, class changes, crossings and correlation
WEIGHTS = (1.0, 1.0, 0.5, 0.5)
BINS, DEEPEST = 20, 60.0

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _quoted(pattern: str) -> str:
    return "r\"" + pattern.replace('"', r"\x22") + "\""


def running(lengths: str) -> str:
    """SQL: running sums of an array of integers (a lambda variable or field), by doubling."""
    return f"""aggregate(slice(sequence(0, 30), 1, cast(ceil(log2(greatest(size({lengths}), 1))) AS int)), {lengths},
        (a, k) -> transform(a, (x, i) -> x + CASE WHEN i >= shiftleft(1, k) THEN a[i - shiftleft(1, k)] ELSE 0 END))"""


def located(pattern: str, kind: int, keep: str = "true") -> str:
    """SQL: (start, kind, end) of the matches of ``pattern`` in column t; ``keep`` may use i and g (second group)."""
    p = _quoted(pattern)
    group = f"regexp_extract_all(t, {p}, 2)" if "g[" in keep else "array('')"
    found = f"named_struct('m', regexp_extract_all(t, {p}, 0), 's', split(t, {p}, -1), 'g', {group})"
    sized = f"transform(array({found}), f -> named_struct('m', f.m, 'g', f.g, 'l', transform(f.m, (x, i) -> char_length(f.s[i]) + char_length(x))))"
    summed = f"transform({sized}, f -> named_struct('m', f.m, 'g', f.g, 'e', {running('f.l')}))"
    spans = f"transform(f.m, (x, i) -> named_struct('start', f.e[i] - char_length(x), 'kind', {kind}, 'end', f.e[i]))"
    return f"""
    CASE WHEN t RLIKE {p} THEN element_at(transform({summed}, f -> filter({spans}, (y, i) -> {keep.replace('g[', 'f.g[')})), 1)
    ELSE cast(array() AS {_SPAN}) END"""


def apart(spans: str, base: str) -> str:
    """SQL: for each of the sorted, disjoint ``spans`` whether it overlaps none of ``base``: as many of these end at its
    start or before as start before its end. Both counts are running sums over one sorted list."""

    def counted(base_at: str, base_order: int, span_at: str, span_order: int) -> str:
        rows = (f"concat(transform({base}, b -> named_struct('at', b.{base_at}, 'o', {base_order}, 'n', 1)), "
                f"transform({spans}, x -> named_struct('at', x.{span_at}, 'o', {span_order}, 'n', 0)))")
        sums = f"transform(transform(array(array_sort({rows})), e -> named_struct('e', e, 'n', transform(e, r -> r.n))), f -> named_struct('e', f.e, 'r', {running('f.n')}))"
        return (f"element_at(transform({sums}, f -> transform(filter(transform(f.e, (r, i) -> named_struct('n', r.n, 'r', f.r[i])), z -> z.n = 0), z -> z.r)), 1)")

    both = f"array(named_struct('a', {counted('start', 1, 'end', 0)}, 'b', {counted('end', 0, 'start', 1)}))"
    return f"element_at(transform({both}, f -> transform(f.a, (x, i) -> x = f.b[i])), 1)"


def upper_tail(z: str) -> str:
    """SQL: probability that a standard normal exceeds z (Borjesson and Sundberg's bound, within 0.3 percent)."""
    q = "exp(-{0} * {0} / 2) / 2.5066282746 / (0.661 * {0} + 0.339 * sqrt({0} * {0} + 5.51))"
    return f"CASE WHEN {z} >= 0 THEN {q.format(f'({z})')} ELSE 1 - {q.format(f'(-({z}))')} END"


def tested(tokens: DataFrame) -> DataFrame:
    """Add the test statistics to rows with a ``token``: z_uniform, z_runs, z_serial, random, p."""
    out = tokens.withColumn("bare", F.regexp_replace("token", "=+$", "")).withColumn("symbols", F.expr("""
        CASE WHEN bare RLIKE '^([0-9a-f]+|[0-9A-F]+)$' THEN '0123456789abcdef'
             WHEN bare RLIKE '^[A-Z2-7]+$' THEN 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'
             ELSE 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/' END"""))
    out = out.withColumn("v", F.expr("""
        transform(filter(split(CASE WHEN char_length(symbols) = 16 THEN lower(bare) ELSE translate(bare, '-_', '+/') END, ''), x -> x <> ''),
                  x -> instr(symbols, x) - 1)"""))
    out = out.withColumns({
        "n": F.expr("cast(size(v) AS double)"), "k": F.expr("cast(char_length(symbols) AS double)"),
        "mean": F.expr("aggregate(v, 0D, (a, x) -> a + x) / size(v)"),
        "squares": F.expr("aggregate(array_distinct(v), 0D, (a, x) -> a + pow(size(filter(v, y -> y = x)), 2))"),
        "high": F.expr("cast(size(filter(v, x -> 2 * x >= char_length(symbols))) AS double)"),
        "runs": F.expr("1D + size(filter(sequence(1, size(v) - 1), i -> (2 * v[i] >= char_length(symbols)) <> (2 * v[i - 1] >= char_length(symbols))))"),
        "classes": F.expr("""transform(filter(split(bare, ''), x -> x <> ''), x -> CASE WHEN x BETWEEN 'a' AND 'z' THEN 0 WHEN x BETWEEN 'A' AND 'Z' THEN 1 ELSE 2 END)"""),
    })
    out = out.withColumns({
        "chi": F.expr("k / n * squares - n"),
        "changes": F.expr("cast(size(filter(sequence(1, size(classes) - 1), i -> classes[i] <> classes[i - 1])) AS double)"),
        "spread": F.expr("aggregate(v, 0D, (a, x) -> a + pow(x - mean, 2))"),
        "lagged": F.expr("aggregate(sequence(1, size(v) - 1), 0D, (a, i) -> a + (v[i] - mean) * (v[i - 1] - mean))"),
    })
    out = out.withColumns({
        "z_uniform": F.expr("(pow(chi / (k - 1), 1 / 3D) - (1 - 2 / (9 * (k - 1)))) / sqrt(2 / (9 * (k - 1)))"),
        "z_runs": F.expr("""CASE WHEN high = 0 OR high = n THEN -9D ELSE
            (runs - 1 - 2 * high * (n - high) / n) / sqrt(2 * high * (n - high) * (2 * high * (n - high) - n) / (n * n * (n - 1))) END"""),
        "z_serial": F.expr("CASE WHEN spread = 0 THEN 9D ELSE (lagged / spread + 1 / n) * sqrt(n) END"),
        "z_pairs": F.expr(f"""({PAIR_RATE} - (squares - n) / (n * (n - 1)))
            / sqrt(2 * {PAIR_RATE} * (1 - {PAIR_RATE}) / (n * (n - 1)) + 4 * ({CUBES} - {PAIR_RATE} * {PAIR_RATE}) / n)"""),
        "z_changes": F.expr(f"(changes - {CHANGES} * (n - 1)) / sqrt({CHANGES} * (1 - {CHANGES}) * (n - 1))"),
        "z_crossings": F.expr(f"(runs - 1 - {CROSSINGS} * (n - 1)) / sqrt({CROSSINGS} * (1 - {CROSSINGS}) * (n - 1))"),
        "z_neighbours": F.expr(f"CASE WHEN spread = 0 THEN -9D ELSE ({NEIGHBOURS} - lagged / spread - 1 / n) * sqrt(n) END"),
    })
    combined = " + ".join(f"{w} * {z}" for w, z in zip(WEIGHTS, ("z_pairs", "z_changes", "z_crossings", "z_neighbours")))
    out = out.withColumn("z", F.expr(f"({combined}) / sqrt({sum(w * w for w in WEIGHTS)}D)"))
    return out.withColumns({
        "random": F.expr(f"{upper_tail('z_uniform')} >= {ALPHA} AND 2 * ({upper_tail('abs(z_runs)')}) >= {ALPHA} AND 2 * ({upper_tail('abs(z_serial)')}) >= {ALPHA}"),
        "p": F.expr(upper_tail("z")),
    }).withColumns({
        "band": F.expr("CASE WHEN n < 20 THEN 0 WHEN n < 32 THEN 1 WHEN n < 64 THEN 2 ELSE 3 END"),
        "bin": F.expr(f"cast(least({DEEPEST}, greatest(0, -log10(greatest(p, 1e-100)))) * {BINS} AS int)"),
    })


def discoveries(tokens: DataFrame, rate: float = RATE) -> DataFrame:
    """(band, least_bin): tokens of a band in this bin or a deeper one pass Benjamini-Hochberg at ``rate``."""
    counts = tokens.groupBy("band", "bin").agg(F.count("*").alias("here"))  # bands * BINS * DEEPEST rows at most
    deeper = Window.partitionBy("band").orderBy(F.desc("bin"))
    return (counts.withColumn("rank", F.sum("here").over(deeper)).withColumn("all", F.sum("here").over(Window.partitionBy("band")))
            .where(F.expr(f"pow(10D, -bin / {BINS}D) <= {rate} * rank / all")).groupBy("band").agg(F.min("bin").alias("least_bin")))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the spans of every row: counts per kind, digest of the fixed kinds, all spans as text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"),
                       F.monotonically_increasing_id().alias("row"))

    def texts(pattern: str) -> str:
        return f"CASE WHEN t RLIKE {_quoted(pattern)} THEN regexp_extract_all(t, {_quoted(pattern)}, 0) ELSE cast(array() AS array<string>) END"

    found = rows.select(
        "row", "doc_id", F.expr(located(ASSIGN, 0, "char_length(g[i]) >= 12")).alias("assign"), F.expr(located(ACCESS, 1)).alias("access"),
        F.expr(located(HEX, 2)).alias("hex"), *[F.expr(x).alias(n) for n, x in (
            ("runs", located(TOKEN, 3)), ("run_texts", texts(TOKEN)), ("parts", located(PART, 3)), ("part_texts", texts(PART)))])
    found = found.select("row", "doc_id", F.concat("assign", "access", "hex").alias("base"), "runs", "run_texts", "parts", "part_texts",
                         *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]])
    found = C.cut_lineage(found, "spans")  # spans and tokens, no texts

    def free(spans: str, token_texts: str, part: bool):
        """Tokens that overlap no fixed kind; of the parts those that are not whole tokens."""
        each = F.explode(F.arrays_zip(F.col(spans).alias("span"), F.col(token_texts).alias("token"), F.expr(apart(spans, "base")).alias("free")))
        out = found.where(F.size(spans) > 0).select("row", each.alias("x")).where("x.free").select("row", "x.span", "x.token", F.lit(part).alias("part"))
        return out

    whole = free("runs", "run_texts", False)
    inner = free("parts", "part_texts", True)
    parted = found.where("size(runs) > 0").select("row", F.explode("runs").alias("span")).select("row", "span")
    tokens = whole.unionByName(inner.join(parted, ["row", "span"], "left_anti"))
    judged = C.cut_lineage(tested(tokens).select("row", "span", "part", "band", "bin", "random"), "tokens")
    good = (judged.join(F.broadcast(discoveries(judged)), "band")  # four rows at most
            .where("random AND bin >= least_bin").groupBy("row").agg(
                F.collect_list(F.when(~F.col("part"), F.col("span"))).alias("runs_found"), F.collect_list(F.when(F.col("part"), F.col("span"))).alias("parts_found")))  # of one text
    inside = F.expr(apart("parts_found", "runs_found"))
    added = good.withColumns({"runs_found": F.array_sort("runs_found"), "parts_found": F.array_sort("parts_found")}).withColumn("outside", inside).select(
        "row", F.expr("concat(runs_found, transform(filter(arrays_zip(parts_found, outside), z -> z.outside), z -> z.parts_found))").alias("added"))
    added = C.cut_lineage(added, "added")
    base = F.array_sort("base")
    names = ", ".join(f"'{k}'" for k in KINDS)

    def shown(column: str) -> str:
        return f"concat_ws(',', transform({column}, x -> concat_ws(':', element_at(array({names}), x.kind + 1), x.start, x.end)))"

    return (found.join(added, "row", "left").withColumn("base", base)
            .withColumn("every", F.array_sort(F.concat("base", F.coalesce("added", F.expr(f"cast(array() AS {_SPAN})")))))
            .select("doc_id", *[f"n_{k}" for k in KINDS[:3]], F.sha2(F.expr(shown("base")), 256).alias("base_sha256"),
                    F.expr(shown("every")).alias("spans")))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(C.table(spark, sf_dir, "documents"))
