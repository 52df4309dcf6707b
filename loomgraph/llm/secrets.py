"""Secret scans with a randomness test battery, in SQL functions only.

Base spans come from three patterns (assignments, access keys, hex strings). The battery adds
spans of kind `random`: unlabelled tokens of 20 or more characters. Each token's encoding
is inferred from its characters; in that alphabet of k symbols three tests look at it: the
chi-squared statistic of the symbol counts against uniformity, the runs of the upper and lower
half of the alphabet, and the serial correlation of neighbours. Fisher's method joins their
p-values: near 1 the token looks drawn at random, near 0 it doesn't.

Their p-values are those of the tests' own null distributions, that of tokens drawn at random. In
each length class Benjamini and Hochberg's rule at the rate `q` rejects that for the distinct
tokens of letters and digits; those left look random and are admitted. So of the tokens set aside
as patterned about a share of q is random at most; copies count once, and a token needs
no others beside it. Added spans never overlap base spans.

The p-values are asymptotic: of 8,000 tokens drawn at random, 20 to 64 characters long, 7 to 8 % fall
below 0.05.

Positions are code points. A null text counts as empty; texts of any length are searched whole, and
each admitted token is compared with the base spans of its text. Each row of the documents gives one row, repeated rows one each;
empty tables give empty tables; columns other than the id and the text are not read. Nothing
is shuffled but hashes of the tokens.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.session import cut

ASSIGN = r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"  # runs of capitals and digits from the first AKIA, 20 characters or more
HEX = r"[0-9a-f]{24,}"  # whole runs of 24 or more
TOKEN = r"[A-Za-z0-9+/_-]{20,}"

#: Kinds in the order of ties.
KINDS = ("assign", "access", "hex", "random")
#: Least lengths of the length classes.
CLASSES = (20, 28, 40, 64)
BINS = 200


def _prefix(lens: str, first: str) -> str:
    """Start of each element of an int array, if the first starts at `first`."""
    return f"aggregate({lens}, named_struct('p', {first}, 'o', cast(array() as array<bigint>)), (s, x) -> named_struct('p', s.p + x, 'o', concat(s.o, array(s.p)))).o"


def _starts(lens: str) -> str:
    """The same for arrays of any length: blocks of 256, then within each."""
    sums = f"transform(sequence(0, (size({lens}) - 1) div 256), b -> aggregate(slice({lens}, b * 256 + 1, 256), 0L, (s, x) -> s + x))"
    inner = _prefix(f"slice({lens}, b * 256 + 1, 256)", "p")
    return f"if(size({lens}) = 0, cast(array() as array<bigint>), flatten(transform({_prefix(sums, '0L')}, (p, b) -> {inner})))"


def _matches(df: DataFrame, kind: str, pattern: str) -> DataFrame:
    """Adds <kind>_m: array of (s, e, m) of all matches of the pattern in text, from left to right."""
    has = F.col("text").rlike(pattern)
    m, g, lens, at = (f"_{kind}_{x}" for x in ("m", "g", "l", "at"))
    df = df.withColumn(m, F.when(has, F.regexp_extract_all("text", F.lit(pattern), 0)).otherwise(F.expr("cast(array() as array<string>)")))
    df = df.withColumn(g, F.when(F.size(m) > 0, F.transform(F.split("text", pattern, -1), F.length)).otherwise(F.expr("cast(array() as array<int>)")))
    df = df.withColumn(lens, F.expr(f"transform({m}, (x, i) -> {g}[i] + length(x))"))
    df = df.withColumn(at, F.expr(_starts(lens)))
    spans = F.expr(f"transform({m}, (x, i) -> named_struct('s', {at}[i] + {g}[i], 'e', {at}[i] + {g}[i] + length(x), 'm', x))")
    return df.withColumn(f"{kind}_m", spans).drop(m, g, lens, at)


def _upper_tail(z: str) -> str:
    """The normal distribution beyond z (Abramowitz and Stegun 26.2.17), at least 1e-30."""
    t = f"(1 / (1 + 0.2316419 * abs({z})))"
    poly = f"({t} * (0.319381530 + {t} * (-0.356563782 + {t} * (1.781477937 + {t} * (-1.821255978 + {t} * 1.330274429)))))"
    tail = f"(exp(-least(abs({z}), 37.0) * least(abs({z}), 37.0) / 2) * 0.3989422804014327 * {poly})"
    return f"greatest(1e-30D, if({z} >= 0, {tail}, 1 - {tail}))"


def _battery(token: str) -> str:
    """(lc, bin, cand) of a token: its length class, bin of the joined p-value, and if it mixes letters and digits."""
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    alphabets = [("^[0-9]+$", digits), ("^[0-9a-f]+$", digits + "abcdef"), ("^[0-9A-F]+$", digits + "ABCDEF"), ("^[a-z]+$", lower), ("^[A-Z]+$", upper), ("^[A-Z2-7]+$", upper + "234567"), ("^[a-z0-9]+$", lower + digits), ("^[A-Z0-9]+$", upper + digits), ("^[A-Za-z]+$", upper + lower), ("^[A-Za-z0-9]+$", upper + lower + digits), ("^[A-Za-z0-9+/]+$", upper + lower + digits + "+/")]
    alphabet = "case " + " ".join(f"when t rlike '{p}' then '{a}'" for p, a in alphabets) + f" else '{upper + lower + digits}-_+/' end"
    classes = " ".join(f"when n >= {least} then {k}" for k, least in reversed(list(enumerate(CLASSES))))
    # Each step binds names for the next one: transform over a one-element array is SQL's let.
    steps = [
        ("t", token),
        ("d", f"named_struct('t', t, 'n', length(t), 'a', {alphabet})"),
        ("d", "named_struct('n', d.n, 'k', length(d.a), 't', d.t, 'x', transform(filter(split(d.t, ''), c -> c <> ''), c -> cast(instr(d.a, c) - 1 as double)))"),
        ("d", "named_struct('n', d.n, 'k', d.k, 't', d.t, 'x', d.x, 'mean', aggregate(d.x, 0D, (s, v) -> s + v) / d.n, 'up', aggregate(d.x, 0D, (s, v) -> s + if(v >= d.k / 2, 1D, 0D)), 'sq', aggregate(array_distinct(d.x), 0D, (s, v) -> s + pow(size(filter(d.x, w -> w = v)), 2)), 'y', slice(d.x, 2, d.n))"),
        ("d", "named_struct('n', d.n, 'k', d.k, 't', d.t, 'chi', (d.k * d.sq / d.n - d.n - (d.k - 1)) / sqrt(2D * (d.k - 1) * (1 - 1D / d.n)), 'runs', 1 + aggregate(zip_with(slice(d.x, 1, d.n - 1), d.y, (v, w) -> if((v >= d.k / 2) = (w >= d.k / 2), 0D, 1D)), 0D, (s, v) -> s + v), 'er', 2 * d.up * (d.n - d.up) / d.n + 1, 'cov', aggregate(zip_with(slice(d.x, 1, d.n - 1), d.y, (v, w) -> (v - d.mean) * (w - d.mean)), 0D, (s, v) -> s + v), 'var', aggregate(d.x, 0D, (s, v) -> s + (v - d.mean) * (v - d.mean)))"),
        ("d", "named_struct('n', d.n, 't', d.t, 'chi', d.chi, 'rz', if(d.er <= 2, 10D, abs(d.runs - d.er) / sqrt((d.er - 1) * (d.er - 2) / (d.n - 1))), 'sz', if(d.var = 0, 10D, abs(d.n * d.cov / d.var + 1) / sqrt(d.n)))"),
        ("d", f"named_struct('n', d.n, 't', d.t, 'f', -(ln({_upper_tail('d.chi')}) + ln(least(1D, 2 * {_upper_tail('d.rz')})) + ln(least(1D, 2 * {_upper_tail('d.sz')}))))"),
        ("d", "named_struct('n', d.n, 't', d.t, 'lp', d.f - ln(1 + d.f + d.f * d.f / 2))"),
    ]
    out = f"named_struct('lc', {'case ' + classes.replace('n >=', 'd.n >=') + ' end'}, 'bin', cast(least({BINS}D, floor(d.lp * 4)) as int), 'cand', d.t rlike '[0-9]' and d.t rlike '[A-Za-z]')"
    for name, value in reversed(steps):
        out = f"transform(array({value}), {name} -> {out})[0]"
    return out


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base (array of (s, r, e): start, number of the kind, end), tokens (s, e and the battery's results)."""
    df = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    for kind, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("token", TOKEN)):
        df = _matches(df, kind, pattern)
    quoted = ASSIGN.replace("\\", "\\\\").replace("'", "\\'")
    df = df.withColumn("assign_m", F.expr(f"filter(assign_m, x -> length(regexp_extract(x.m, '{quoted}', 2)) >= 6)"))
    base = F.concat(*(F.expr(f"transform({kind}_m, x -> named_struct('s', x.s, 'r', {r}, 'e', x.e))") for r, kind in enumerate(KINDS[:3])))
    tokens = F.expr(f"transform(token_m, x -> named_struct('s', x.s, 'e', x.e, 'h', xxhash64(x.m), 'b', {_battery('x.m')}))")
    return df.select("doc_id", F.array_sort(base).alias("base"), tokens.alias("tokens"))


def admitted_bins(scanned: DataFrame, q: float = 0.05) -> dict[int, int]:
    """The largest admitted bin of each length class (-1: none)."""
    distinct = scanned.select(F.explode("tokens").alias("t")).where("t.b.cand").select("t.b.lc", "t.b.bin", "t.h").distinct()
    rows = distinct.groupBy("lc", "bin").count().collect()  # 4 x 201 at most
    out = {}
    for lc in range(len(CLASSES)):
        cands = [0] * (BINS + 1)
        for r in rows:
            if r.lc == lc:
                cands[r.bin] += r["count"]
        out[lc] = BINS
        for b in range(BINS, -1, -1):
            # A token of bin b has a p-value of exp(-b / 4) at most.
            if sum(cands[b:]) and math.exp(-b / 4) * sum(cands) / sum(cands[b:]) <= q:
                out[lc] = b - 1
    return out


def find_secrets(docs: DataFrame, q: float = 0.05) -> DataFrame:
    """doc_id, base, spans: arrays of (s, r, e) in order; r numbers KINDS."""
    scanned = cut(scan(docs))
    bins = " ".join(f"when {lc} then {b}" for lc, b in admitted_bins(scanned, q).items())
    added = F.expr(f"transform(filter(tokens, t -> t.b.cand and t.b.bin <= (case t.b.lc {bins} end) and not exists(base, x -> x.s < t.e and t.s < x.e)), t -> named_struct('s', t.s, 'r', 3, 'e', t.e))")
    return scanned.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def _text(spans: str) -> Column:
    kinds = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.array_join(F.expr(f"transform({spans}, x -> concat({kinds}[x.r], ':', x.s, ':', x.e))"), ",")


def secret_digests(docs: DataFrame, q: float = 0.05) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = find_secrets(docs, q)
    counts = [F.expr(f"cast(size(filter(base, x -> x.r = {r})) as bigint)").alias(f"n_{kind}") for r, kind in enumerate(KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(_text("base"), 256).alias("base_sha256"), _text("spans").alias("spans"))
