"""Removal of repeated lines, up to one word's edit, by a deletion-neighbourhood join (DataFrame functions only).

Lines at a distance of one edit become equal when the right word is deleted from one or both. So each line emits
a hashed key for each of its variants with one word deleted, in order, and one for itself; lines with an equal key
join; the edit distance of what joins is verified on the words; and the earliest line stays. Two shortcuts lose nothing:
copies of a line are one line, and a line emits variants only if it shares its first or its last half with another line
of about its length, since one edit leaves one half of the line as it is.

Lines are numbered in their order, so that a variant is a key and a number. A key keeps its smallest and largest
number only, before it is shuffled; the variants of the few keys that lines share are then picked out where they lie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, broadcast_if_small, clear_of, discard, durable, running

#: Lines with fewer words have to be equal to be repeats: there one word is more than a fifth of the line.
MIN_WORDS = 5

#: Words a and b differ in one place (b as long as a), or a is b with one word more.
_ONE_SUBSTITUTED = "size(filter(zip_with(a, b, (x, y) -> x = y), z -> not z)) <= 1"
_ONE_DELETED = "slice(a, p + 1, size(a)) = slice(b, p, size(b))"


def _normal(line: str) -> str:
    """SQL for a line with white space trimmed and runs of it as one space; most lines need no regular expression."""
    odd = " or ".join(f"contains({line}, '{x}')" for x in ("  ", "\\t", "\\r", "\\u000C", "\\u000B"))
    return f"trim(if({odd}, regexp_replace({line}, r'\\s+', ' '), {line}))"


def _written(line: str) -> str:
    """SQL for whether there is more than white space in a line; it looks no further than the first other character."""
    return f"trim(leading ' \\t\\r\\u000C\\u000B' from {line}) <> ''"


def _lines(docs: DataFrame) -> DataFrame:
    cut = docs.select("__did", "__rid", F.posexplode(F.split("__text", "\n")).alias("pos", "line"))
    norm = cut.filter(_written("line")).select("__did", "__rid", "pos", F.expr(_normal("line")).alias("norm"))
    return norm.withColumn("n", F.expr("octet_length(norm) - octet_length(replace(norm, ' ', '')) + 1"))


def _variants(lines: DataFrame) -> DataFrame:
    """(key, i, l): for each line l itself (i = 0) and each of its variants without word i. A key is a sum without carry of
    the hashes of words and their places, so each variant's is that of the words before and of those after, moved up by one."""
    xor = lambda a, b: f"({a} ^ {b})"
    before = running("transform(w, (x, j) -> xxhash64(x, j))", xor)
    after = f"reverse({running('reverse(transform(w, (x, j) -> xxhash64(x, j - 1)))', xor)})"
    keys = (
        f"transform(array(struct({before} as b, {after} as a)), q -> concat(array(struct(xxhash64(n, q.b[n - 1]) as key, 0 as i)), "
        "transform(sequence(1, n), i -> struct(xxhash64(n - 1, if(i > 1, q.b[greatest(i - 2, 0)], 0L) ^ if(i < n, q.a[least(i, n - 1)], 0L)) as key, i as i))))[0]"
    )
    return lines.select("l", F.inline(F.expr(keys))).select("key", "i", "l")


def _near(distinct: DataFrame, docs: DataFrame) -> DataFrame:
    """Keys (h, g) of lines that have an earlier line at one edit's distance."""
    long = distinct.filter(F.col("n") >= MIN_WORDS)
    halves = long.select("h", F.explode(F.expr("array(xxhash64('P', n + 1, a), xxhash64('Q', n + 1, b), xxhash64('P', n, c), xxhash64('Q', n, d))")).alias("key"))
    shared = durable(halves.groupBy("key").agg(F.count("*").alias("lines")).filter("lines > 1").select("key"))
    partners = durable(halves.join(broadcast_if_small(shared, shared.count(), 16), "key", "left_semi").select("h").distinct())
    found = partners.count()
    some = long.join(broadcast_if_small(partners, found, 16), "h", "left_semi").select("h", "g", "did", "rid", "pos")
    texts = docs.join(broadcast_if_small(some, found, 64), (F.col("did") == F.col("__did")) & (F.col("rid") == F.col("__rid")))
    lines = texts.select("h", "g", "did", "rid", "pos", F.expr("split(__text, '\n')[pos]").alias("line"))
    lines = lines.select("h", "g", "did", "rid", "pos", F.split(F.expr(_normal("line")), " ").alias("w"))
    lines = lines.dropDuplicates(["h", "g"]).sort("did", "rid", "pos", "h", "g")  # ids rise with partitions and rows, so they keep this order
    lines = durable(lines.select(F.monotonically_increasing_id().alias("l"), "h", "g", F.size("w").alias("n"), "w"))
    discard(shared, partners)

    variants = _variants(lines)
    met = durable(variants.groupBy("key").agg(F.min("l").alias("least"), F.max("l").alias("most")).filter("least < most").select("key"))
    some = durable(variants.join(broadcast_if_small(met, met.count(), 16), "key"))
    first = some.filter("i > 0").groupBy("key", "i").agg(F.min("l").alias("l2"))
    substituted = some.join(first, ["key", "i"]).filter("l > l2").select("l", "l2")
    whole = some.filter("i = 0").select("key", F.col("l").alias("l2"))
    uneven = some.filter("i > 0").join(whole, "key").filter("l <> l2").select(F.greatest("l", "l2").alias("l"), F.least("l", "l2").alias("l2"))
    pairs = substituted.unionAll(uneven).distinct()
    left = lines.select("l", "h", "g", F.col("w").alias("a"))
    right = lines.select(F.col("l").alias("l2"), F.col("w").alias("b"))
    checked = pairs.join(left, "l").join(right, "l2")
    checked = checked.select("h", "g", F.expr("if(size(a) >= size(b), a, b)").alias("a"), F.expr("if(size(a) >= size(b), b, a)").alias("b"))
    checked = checked.withColumn("p", F.expr("cast(array_position(zip_with(a, b, (x, y) -> x <=> y), false) as int)"))
    checked = checked.filter(F.expr(f"(size(a) = size(b) and {_ONE_SUBSTITUTED}) or (size(a) = size(b) + 1 and {_ONE_DELETED})"))
    near = durable(checked.select("h", "g", F.lit(True).alias("near")).distinct())
    discard(lines, met, some)
    return near


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs with repeated lines taken out of the text, and lines_in, lines_removed (long).

    Lines end at newlines and are compared with white space trimmed and runs of it as one space. A line goes if
    an earlier line (smaller id, then a fixed order of texts, then position) is equal or, from MIN_WORDS words
    on, one inserted, deleted or substituted word away. This is judged on the input: lines that go count as
    earlier lines as well. Blank lines stay and are not counted. A null text stays null; a null id comes after
    all others; rows alike in id and text are one document and lose the same lines. Lines that stay are unchanged.
    All columns are kept; columns named lines_in or lines_removed are replaced. An empty table stays empty.
    """
    cleared, names = clear_of(docs)
    of = dict(zip(docs.columns, names))
    marked = cleared.withColumns({"__did": F.coalesce(F.col(of[id_col]).cast("long"), F.lit(LAST_ID)), "__text": F.col(of[text_col]).cast("string")})
    marked = marked.withColumn("__rid", F.xxhash64("__did", "__text"))
    keys = marked.select("__did", "__rid", "__text")
    lines = _lines(keys).withColumns({"h": F.expr("xxhash64(norm)"), "g": F.expr("hash('line', norm)")})
    half = "xxhash64(substring_index(norm, ' ', {}))"
    lines = lines.select(
        "h", "g", "n", F.struct(F.col("__did").alias("did"), F.col("__rid").alias("rid"), "pos").alias("at"),
        F.expr(half.format("n div 2")).alias("a"), F.expr(half.format("-(n - n div 2)")).alias("b"), F.expr(half.format("(n - 1) div 2")).alias("c"), F.expr(half.format("-(n - 1 - (n - 1) div 2)")).alias("d"),
    )
    distinct = lines.groupBy("h", "g").agg(F.min("at").alias("at"), F.count("*").alias("times"), *[F.first(x).alias(x) for x in ("n", "a", "b", "c", "d")])
    distinct = durable(distinct.select("h", "g", "at.*", "times", "n", "a", "b", "c", "d"))
    near = _near(distinct, keys)
    repeated = distinct.select("h", "g", "times", F.struct("did", "rid", "pos").alias("first")).join(near, ["h", "g"], "left").filter("times > 1 or near")
    places = _lines(keys).select(F.expr("xxhash64(norm)").alias("h"), F.expr("hash('line', norm)").alias("g"), "__did", "__rid", "pos")
    gone = places.join(repeated, ["h", "g"]).filter("near or struct(__did, __rid, pos) > struct(first.did, first.rid, first.pos)")
    gone = gone.groupBy("__did", "__rid").agg(F.collect_set("pos").alias("__gone"))
    out = marked.join(gone, ["__did", "__rid"], "left").withColumn("__gone", F.coalesce("__gone", F.expr("array()").cast("array<int>")))
    out = out.withColumn("__lines", F.split("__text", "\n"))
    kept = F.expr("array_join(transform(array_sort(array_except(sequence(0, size(__lines) - 1), __gone)), i -> __lines[i]), '\n')")
    count = F.coalesce(F.expr(f"cast(size(filter(__lines, x -> {_written('x')})) as long)"), F.lit(0).cast("long"))
    text = F.when(F.size("__gone") > 0, kept).otherwise(F.col("__text"))
    added = {"lines_in": count, "lines_removed": F.size("__gone").cast("long")}
    every = [(added[c.lower()] if c.lower() in added else text if c == text_col else F.col(n)).alias(c) for c, n in zip(docs.columns, names)]
    return out.select(*every, *[x.alias(c) for c, x in added.items() if c not in map(str.lower, docs.columns)])
