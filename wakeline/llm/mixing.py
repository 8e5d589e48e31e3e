"""Mixing sources to target weights: temperature, bisected to a target, realised as budgeted block permutations.

A source's weight is its share of all tokens to the power of alpha, normalised. alpha = 1 leaves the shares as they
are, alpha = 0 makes them equal. Sources are repeated more the smaller alpha is and the entropy of the weights rises,
so the smallest alpha is bisected at which no source is repeated more than the limit allows and, if a target entropy
is given, the entropy is not above it. Each round of the bisection looks at 2**LEVELS - 1 inner points in one
aggregation over the sources, which is LEVELS halvings; nothing of the sources comes to the driver but one row.

A source's budget is its weight times all tokens. It is spent on whole passes over the source and a last, partial one:
the source's documents lie in blocks by a hash of their ids, the partial pass takes the blocks in the order of a
permutation, and within the block where the budget runs out the documents in the order of a hash, as long as they fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, clear_of, durable

ADDED = ("mix_source", "mix_tokens", "mix_block", "mix_weight", "mix_passes", "mix_copies")
ROUNDS, LEVELS = 5, 6
#: Tokens in a block on average.
BLOCK_TOKENS = 20_000


def exponent(sources: DataFrame, repeats: float, entropy: float | None = None, cover: bool = False) -> float:
    """alpha, to 2**-(ROUNDS * LEVELS): sources has tokens (long, above 0) for each source."""
    step, low = 1.0, 0.0
    total = sources.agg(F.sum("tokens")).first()[0]
    if not total:
        return 1.0
    points = 1 << LEVELS
    for _ in range(ROUNDS):
        step /= points
        alphas = F.transform(F.sequence(F.lit(0), F.lit(points)), lambda i: F.lit(low) + i * F.lit(step))
        share = F.col("tokens") / F.lit(float(total))
        at = sources.select(share.alias("p"), F.explode(alphas).alias("alpha"))
        power = F.exp(F.col("alpha") * F.ln("p"))
        sums = at.groupBy("alpha").agg(F.sum(power).alias("z"), F.max(power / F.col("p")).alias("m"), F.min(power / F.col("p")).alias("l"), F.sum(power * F.col("alpha") * F.ln("p")).alias("e"))
        good = F.col("m") / (F.col("l") if cover else F.col("z")) <= F.lit(float(repeats) + 1e-9)
        if entropy is not None:
            good = good & (F.ln("z") - F.col("e") / F.col("z") <= F.lit(entropy + 1e-9))
        first = sums.filter(good).agg(F.min("alpha")).first()[0]
        if first is None:
            return 1.0
        if first <= low:
            return low
        low = first - step
    return low + step


def count_tokens(text) -> Column:
    """Runs of characters other than white space; a null text has none."""
    parts = F.split(text, r"\s+")
    ends = F.when(F.element_at(parts, 1) == "", 1).otherwise(0) + F.when(F.element_at(parts, -1) == "", 1).otherwise(0)
    return F.coalesce(F.greatest(F.size(parts) - ends, F.lit(0)), F.lit(0)).cast("long")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", repeats: float = 4.0, entropy: float | None = None, seed: str = "mix", cover: bool = False) -> DataFrame:
    """The rows of docs with mix_source, mix_tokens, mix_block, mix_weight (of the source), mix_passes (whole passes over the source) and
    mix_copies (long): how often the document is in the mixture; 0: not at all.

    A token is a run of characters other than white space. A null source is a source of its own. A document without
    tokens takes no budget and is in each whole pass. Rows alike in id and text count as one document for the order
    within a block but each spends its tokens; A null id comes last. All columns are kept (columns with these names
    are replaced); an empty table stays empty. All budgets together are all tokens of the input: what is taken from
    frequent sources goes to rare ones. With cover they are so many more that each source is taken once at least, and
    the limit on repeats holds for the one that is taken most. Texts are not shuffled: where the partial pass of each source ends, a block and a
    place in it, is all that the rows need.
    """
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    cleared, names = clear_of(docs.select(*[F.col(f"`{c}`") for c in kept]))
    of = dict(zip(kept, names))
    marked = cleared.withColumns({
        "mix_source": F.coalesce(F.concat(F.lit("="), F.col(of[source_col]).cast("string")), F.lit("")),
        "mix_tokens": count_tokens(F.col(of[text_col]).cast("string")),
        "__id": F.coalesce(F.col(of[id_col]).cast("string"), F.lit("")),
    })
    rows = durable(marked.select("mix_source", "mix_tokens", "__id"))
    sources = durable(rows.groupBy("mix_source").agg(F.sum("mix_tokens").alias("tokens")))
    some = sources.filter("tokens > 0")
    alpha = exponent(some, repeats, entropy, cover)
    power = F.exp(F.lit(alpha) * F.ln(F.col("tokens")))
    n_sources, total, z, rarest = some.agg(F.count("*"), F.sum("tokens"), F.sum(power), F.min(power / F.col("tokens"))).first()
    total, z = total or 0, z or 1.0
    if cover and rarest:
        total = int(z / rarest)  # the source with the least weight for its tokens is taken once
    full = F.col("tokens") > 0
    weights = sources.withColumn("mix_weight", F.when(full, F.round(power / F.lit(z), 9)).otherwise(F.lit(0.0)))
    weights = weights.withColumn("budget", F.floor(F.col("mix_weight") * F.lit(total)).cast("long"))
    if cover:
        weights = weights.withColumn("budget", F.greatest("budget", "tokens"))
    weights = weights.withColumn("mix_passes", F.when(full, F.expr("budget div greatest(tokens, 1)")).otherwise(F.lit(1)).cast("long"))
    weights = weights.withColumn("room", F.when(full, F.expr("budget - mix_passes * tokens")).otherwise(F.lit(0)).cast("long"))
    weights = weights.withColumn("blocks", F.ceil(F.greatest(F.col("tokens"), F.lit(1)) / BLOCK_TOKENS).cast("long")).drop("tokens", "budget")
    hashed = lambda *x: F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *x)), 1, 15), 16, 10).cast("long")
    block = F.pmod(hashed("mix_source", "__id"), F.col("blocks"))
    turn = F.struct(hashed("mix_source", F.lit("block"), F.col("mix_block").cast("string")).alias("t"), F.col("mix_block"))
    place = F.struct(hashed("mix_source", F.lit("document"), "__id").alias("t"), F.col("__id").alias("i"))
    weights = broadcast_if_small(weights, sources.count(), 200)

    placed = rows.join(weights, "mix_source").withColumn("mix_block", block)
    blocks = placed.groupBy("mix_source", "mix_block").agg(F.sum("mix_tokens").alias("n"), F.first("room").alias("room"))
    blocks = blocks.withColumn("turn", turn).withColumn("part", F.expr("shiftright(turn.t, 48)"))
    parts = blocks.groupBy("mix_source", "part").agg(F.sum("n").alias("n"))  # 4096 parts a source at most: no task holds all blocks of a source
    upto = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("mix_source", "part", upto(Window.partitionBy("mix_source").orderBy("part")).alias("before"))
    blocks = blocks.withColumn("inner", upto(Window.partitionBy("mix_source", "part").orderBy("turn"))).join(parts, ["mix_source", "part"])
    first = blocks.filter("before + inner + n > room").groupBy("mix_source").agg(F.min(F.struct("turn", (F.col("room") - F.col("before") - F.col("inner")).alias("room"))).alias("first"))
    first = first.select("mix_source", F.col("first.turn").alias("edge"), F.col("first.room").alias("space"))
    inside = placed.join(first, "mix_source").filter("mix_block = edge.mix_block").withColumn("place", place)
    spent = F.sum("mix_tokens").over(Window.partitionBy("mix_source").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    last = inside.withColumn("spent", spent).filter("spent <= space").groupBy("mix_source").agg(F.max("place").alias("last"))
    edges = durable(first.join(last, "mix_source", "left").select("mix_source", "edge", "last"))

    out = marked.join(weights, "mix_source").join(broadcast_if_small(edges, n_sources, 200), "mix_source", "left").withColumn("mix_block", block)
    taken = F.when(F.col("edge").isNull() | (turn < F.col("edge")), 1).when((turn == F.col("edge")) & (place <= F.col("last")), 1).otherwise(0)
    taken = F.when(F.col("room") > 0, taken).otherwise(0)
    out = out.withColumn("mix_copies", (F.col("mix_passes") + taken).cast("long"))
    out = out.withColumn("mix_source", F.expr("if(mix_source = '', null, substr(mix_source, 2))"))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, kept)], *ADDED)
