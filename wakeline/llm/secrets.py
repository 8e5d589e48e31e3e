"""Secret scans: three fixed patterns, and a battery of randomness tests (DataFrame functions only).

Besides the patterns' matches, every long enough token is a candidate. Its encoding (hex, base 32, letters and digits,
base 64) is inferred from its characters. Three tests ask whether it looks drawn evenly from that alphabet: a
chi-squared test of the characters' counts, a runs test about the middle of the alphabet, and a test of the serial
correlation of neighbours. Fisher's method joins their p-values to one statistic: small for random text.

Two things are asked of a token. By the tests' own distribution (Fisher's statistic of random text is chi-squared with
six degrees of freedom) the battery must not rule out that it is random. And it must not be words, numbers and
separators: a chain over characters, its letter pairs counted in all words of all texts, is the null. Under it the ratio
of the two likelihoods (drawn evenly, by the chain) is t or more with a chance of 1/t at most, so
the number of alphabets over t is a p-value that resolves any rate, for any length and in tables of any size. The Benjamini-Hochberg procedure over
the distinct candidates holds the false discoveries to a given rate.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import running

#: The base patterns (group 0 is the span), and how long a match (assign: its second group) has to be.
PATTERNS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),  # the same spans as of [0-9a-f]+ with 32 characters or more: such runs are maximal
}
#: Candidates: runs of so many of these characters.
TOKEN, LEAST = r"[A-Za-z0-9+/_-]{20,}", 20
RATE = 0.01
#: Fisher's statistic is larger than that for one random token of 1,000 (chi-squared, six degrees of freedom).
RANDOM = 22.458
#: The logarithm of the ratio is counted in whole steps up to a limit that is telling among any number of candidates.
MOST = 100
_ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "alnum": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}

_CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/-_"]
_CHARS = "".join(_CLASSES)
#: Chances of the next character's class in words, numbers and separators: a row for each class, the last for the start.
_NEXT = [(0.85, 0.03, 0.03, 0.09), (0.45, 0.45, 0.05, 0.05), (0.05, 0.05, 0.75, 0.15), (0.5, 0.15, 0.25, 0.1), (0.5, 0.15, 0.25, 0.1)]


_NONE = "cast(array() as array<struct<s:int,e:int,t:string>>)"
_ADD = lambda a, b: f"({a} + {b})"


def spans(text: str, pattern: str, group: int, least: int) -> str:
    """SQL for an array of (s, e, t): start and end in code points of each match, leftmost first and not overlapping, whose
    group has least characters; t is the match. What lies between matches is what split() leaves."""
    quoted = "r'" + pattern.replace("'", "\\x27") + "'"
    found, between, size = f"regexp_extract_all({text}, {quoted}, 0)", f"split({text}, {quoted}, -1)", f"regexp_extract_all({text}, {quoted}, {group})"
    ends = running("zip_with(slice(q.b, 1, size(q.m)), q.m, (x, y) -> length(x) + length(y))", _ADD)
    every = f"zip_with({ends}, q.m, (z, y) -> struct(z - length(y) as s, z as e, y as t))"
    long = f"filter(zip_with({every}, q.g, (x, y) -> if(length(y) >= {least}, x, null)), x -> x is not null)"
    return f"if({text} rlike {quoted}, transform(array(struct({found} as m, {between} as b, {size} as g)), q -> {long})[0], {_NONE})"


def apart(tokens: str, others: str) -> str:
    """SQL for those of tokens, an array of (s, e, t), that overlap none of others, an array with s and e.

    Both in one order: a token is clear of what starts before it if the largest end so far is not behind its start, and of what
    starts later if the smallest start from there on is not before its end."""
    every = f"array_sort(concat(transform({others}, x -> struct(x.s as s, x.e as e, 1 as o, '' as t)), transform({tokens}, x -> struct(x.s as s, x.e as e, 0 as o, x.t as t))))"
    before = running("transform(r.v, x -> if(x.o = 1, x.e, -1))", lambda a, b: f"greatest({a}, {b})")
    after = f"reverse({running('reverse(transform(r.v, x -> if(x.o = 1, x.s, 2147483647)))', lambda a, b: f'least({a}, {b})')})"
    kept = "filter(transform(u.v, (x, k) -> if(x.o = 0 and u.b[k] <= x.s and u.a[k] >= x.e, struct(x.s as s, x.e as e, x.t as t), null)), x -> x is not null)"
    return f"if(size({others}) = 0 or size({tokens}) = 0, {tokens}, transform(transform(array(struct({every} as v)), r -> struct(r.v as v, {before} as b, {after} as a)), u -> {kept})[0])"


def _normal_tail(z: str) -> str:
    """SQL for the chance of a standard normal above z (a logistic form of it, right to three places)."""
    return f"1 / (1 + exp(least(700D, 1.5976D * ({z}) + 0.07056D * power({z}, 3))))"


def _alphabet(token: str) -> str:
    """SQL for the alphabet that a token's characters tell."""
    return (
        f"case when {token} rlike '^[0-9a-f]+$' and {token} rlike '[0-9]' then '{_ALPHABETS['hex']}' when {token} rlike '^[0-9A-F]+$' and {token} rlike '[0-9]' then '{_ALPHABETS['HEX']}' "
        f"when {token} rlike '^[A-Z2-7]+$' and {token} rlike '[0-9]' then '{_ALPHABETS['base32']}' when {token} rlike '^[a-z]+$' then '{_ALPHABETS['lower']}' when {token} rlike '^[A-Z]+$' then '{_ALPHABETS['upper']}' "
        f"when {token} rlike '^[A-Za-z0-9]+$' then '{_ALPHABETS['alnum']}' else '{_ALPHABETS['base64']}' end"
    )


def randomness(token: str) -> str:
    """SQL for Fisher's statistic of the three tests for a token of LEAST characters or more: 0 and up, small if random."""
    kind = _alphabet(token)
    values = f"transform(split({token}, ''), c -> cast(instr({kind}, c) - 1 as double))"
    letters = f"cast(length({kind}) as double)"
    step = (
        f"transform(array(struct({values} as v, {letters} as k)), q -> struct(q.v as v, q.k as k, cast(size(q.v) as double) as n, "
        "transform(array_distinct(q.v), x -> power(cast(size(filter(q.v, y -> y = x)) as double), 2D)) as f, "
        "transform(q.v, x -> x >= q.k / 2) as b, aggregate(q.v, 0D, (s, x) -> s + x) / size(q.v) as m))[0]"
    )
    stats = (
        f"transform(array({step}), q -> struct(q.n as n, q.k - 1 as df, aggregate(q.f, 0D, (s, x) -> s + x) * q.k / q.n - q.n as chi, "
        "cast(size(filter(q.b, x -> x)) as double) as up, "
        "1D + size(filter(zip_with(q.b, slice(q.b, 2, size(q.b)), (x, y) -> x <> y), x -> x)) as runs, "
        "aggregate(zip_with(q.v, slice(q.v, 2, size(q.v)), (x, y) -> (x - q.m) * (y - q.m)), 0D, (s, x) -> s + coalesce(x, 0D)) as cov, "
        "aggregate(q.v, 0D, (s, x) -> s + power(x - q.m, 2D)) as var))[0]"
    )
    scores = (
        f"transform(array({stats}), q -> array("
        "(power(greatest(q.chi, 1e-9D) / q.df, 1D / 3) - (1 - 2 / (9 * q.df))) / sqrt(2 / (9 * q.df)), "
        "if(q.up = 0 or q.up = q.n, sqrt(q.n), abs(q.runs - 1 - 2 * q.up * (q.n - q.up) / q.n) / sqrt(greatest(1e-9D, 2 * q.up * (q.n - q.up) * (2 * q.up * (q.n - q.up) - q.n) / (q.n * q.n * (q.n - 1))))), "
        "if(q.var = 0, sqrt(q.n), abs(q.cov / q.var) * sqrt(q.n))))[0]"
    )
    tails = f"transform(transform({scores}, z -> least(20D, greatest(-20D, z))), (z, i) -> if(i = 0, {_normal_tail('z')}, least(1D, 2 * {_normal_tail('z')})))"
    return f"aggregate({tails}, 0D, (s, p) -> s - 2 * ln(greatest(p, 1e-30D)))"


def _span(place: int, kind: str):
    return lambda x: F.struct(x["s"].alias("s"), F.lit(place).alias("o"), x["e"].alias("e"), F.lit(kind).alias("kind"))


def fit_chain(texts: DataFrame) -> str:
    """SQL for an array with the logarithms of the chain's chances: of a character (column) after another (row; the last is the start).

    texts has one column, text. All words of all texts count, each as often as it occurs; counts of letter pairs are all that is
    gathered. Each count starts at one, so that without texts all are alike."""
    words = texts.select(F.explode(F.expr("regexp_extract_all(text, '(?<![A-Za-z0-9+/_-])[A-Za-z]{2,}(?![A-Za-z0-9+/_-])', 0)")).alias("w")).select(F.lower("w").alias("w"))
    words = words.groupBy("w").agg(F.count("*").alias("n"))
    pairs = words.select("n", F.explode(F.expr("transform(sequence(1, length(w) - 1), i -> substring(w, i, 2))")).alias("pair"))
    seen = {r.pair: r.n for r in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect()}  # 676 rows at most
    letters = _CLASSES[0]
    after = {x: 26 + sum(seen.get(x + y, 0) for y in letters) for x in letters}
    out = []
    for x in [*_CHARS, ""]:
        of = next((i for i, chars in enumerate(_CLASSES) if x and x in chars), 4)
        for y in _CHARS:
            to = next(i for i, chars in enumerate(_CLASSES) if y in chars)
            pair = (1 + seen.get((x + y).lower(), 0)) / after[x.lower()] if of < 2 and to < 2 else 1 / len(_CLASSES[to])
            out.append(math.log(_NEXT[of][to] * pair))
    return "cast(split('" + ",".join(f"{v:.6f}" for v in out) + "', ',') as array<double>)"


def surprise(token: str, chain: str) -> str:
    """SQL for the whole steps of the ratio's logarithm, 0 to MOST; 0 if the battery rules out that the token is random."""
    n = len(_CHARS)
    at = f"transform(split({token}, ''), c -> instr('{_CHARS}', c))"
    by_chain = f"aggregate({at}, struct({n + 1} as p, 0D as s), (a, c) -> struct(c as p, a.s + element_at({chain}, (a.p - 1) * {n} + c) as s), a -> a.s)"
    ratio = f"-length({token}) * ln(length({_alphabet(token)})) - {by_chain}"
    return f"cast(if(({ratio}) < 1 or {randomness(token)} > {RANDOM}D, 0, least(floor({ratio}), {MOST})) as int)"


def least_step(steps: dict[int, int], rate: float = RATE) -> int | None:
    """The smallest step that the procedure accepts, by the numbers of distinct candidates with each step; None if there is none."""
    every, found, out = sum(steps.values()), 0, None
    for s in range(MOST, 0, -1):
        found += steps.get(s, 0)
        if found and len(_ALPHABETS) * math.exp(-s) * every / found <= rate:
            out = s
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """Per row: its id, base (array of (s, o, e, kind), by start, then kind as listed in PATTERNS) and spans (the same with the
    spans of kind 'random' that the battery adds where no base span lies). Starts and ends are code points, ends exclusive.

    A null text is empty. Repeated rows are scanned each for itself; null ids stay null; an empty table gives an empty
    result; other columns are not read. Whole texts are scanned where they lie: words with their counts and the candidates'
    hashes are all that is shuffled. The work of a row is about in proportion to its text and its matches.
    """
    base = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    kinds = [F.transform(F.expr(spans("__text", pattern, group, least)), _span(o, kind)) for o, (kind, (pattern, group, least)) in enumerate(PATTERNS.items())]
    once = lambda df, **columns: df.select("__id", F.inline(F.array(F.struct(*[x.alias(c) for c, x in columns.items()]))))  # noqa: E731, what inline() makes is never made again
    rows = once(base, base=F.array_sort(F.concat(*kinds)), tokens=F.expr(spans("__text", TOKEN, 0, LEAST)))
    rows = once(rows, base=F.col("base"), tokens=F.expr(apart("tokens", "base")))
    chain = fit_chain(base.select(F.col("__text").alias("text")))
    rows = once(rows, base=F.col("base"), tokens=F.expr(f"transform(tokens, t -> struct(t.s as s, t.e as e, t.t as t, {surprise('t.t', chain)} as step))"))
    distinct = rows.select(F.explode("tokens").alias("t")).select(F.xxhash64("t.t").alias("token"), F.col("t.step").alias("step")).distinct()
    least = least_step({r.step: r.n for r in distinct.groupBy("step").agg(F.count("*").alias("n")).collect()}, rate)  # MOST + 1 rows
    if least is None:
        return rows.select(F.col("__id").alias(id_col), "base", F.col("base").alias("spans"))
    random = F.transform(F.expr(f"filter(tokens, t -> t.step >= {least})"), _span(len(PATTERNS), "random"))
    return rows.select(F.col("__id").alias(id_col), "base", F.array_sort(F.concat("base", random)).alias("spans"))
