"""Mixing sources to target weights by temperature, with DataFrame functions only.

The share of each source's tokens is raised to an exponent between 0 (all sources alike) and 1 (as they
are) and normalised. The exponent is found by bisection, several steps in one small aggregation: the flattest mix in
which no source is repeated more often than a limit, or the one closest to the shares whose entropy
reaches a target. A budget of tokens then gives every source its number of passes: whole ones, in which
each of its rows comes once, and a part of one.

Passes are block permutations. A source has about as many blocks as its blocks have rows (the square root
of its rows), so that neither a list of blocks nor a block is large where a source holds a third of all
rows. In each pass the blocks, and the rows in each block, come in a new order by a hash. The last part
of a pass takes whole blocks in that order while the budget lasts, then rows of one block.

Without a budget the smallest one is taken that has every row at least once: nothing is dropped.

Defined results: null sources and empty names are one source; null texts have no tokens; a row without
tokens comes wherever it stands in a pass; a source without any token is passed once; rows that repeat
an id are rows of their own (their order is that of their tokens); an empty table gives an empty one; input
columns that are named like an added one come back as ``input_`` and their name; ``mixed`` leaves all names alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapewright.llm.util import named, packed, saved

STEPS = 15  # exponents tried in one aggregation: four bisections
TOLERANCE = 1e-12
ADDED = ("mix_copy", "mix_block", "mix_tokens", "mix_weight", "mix_order")
WORD = r"[^ \t\n\x0B\f\r]+"


def token_count(text: Column) -> Column:
    """Words between blanks; the unit of shares and budgets."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _entropy(exponent: float) -> Column:
    power = F.pow("share", F.lit(exponent))
    return F.log(F.sum(power)) - F.sum(power * F.log(power)) / F.sum(power)


def find_exponent(shares: DataFrame, repetition_limit: float | None, target_entropy: float | None, budget_share: float | None) -> float:
    """``shares``: one row (share) for each source with tokens.

    Every pass over the sources returns one row; the bounds move until they meet.
    """
    if (repetition_limit is None) == (target_entropy is None):
        raise ValueError("give a repetition limit or a target entropy")

    def reached(exponent: float) -> Column:
        if target_entropy is not None:
            return _entropy(exponent) >= target_entropy
        most = F.max(F.pow("share", F.lit(exponent - 1)))
        if budget_share is not None:  # passes are weight * budget / tokens
            return most / F.sum(F.pow("share", F.lit(exponent))) * budget_share <= repetition_limit
        return most / F.min(F.pow("share", F.lit(exponent - 1))) <= repetition_limit

    # the entropy falls with the exponent, and so do repetitions
    low, high = 0.0, 1.0
    first = shares.agg(reached(0.0).alias("low"), reached(1.0).alias("high")).first()
    wanted_low = target_entropy is not None
    if first["low"] is None or first["low" if wanted_low else "high"] is not True:
        return low if wanted_low else high
    if first["high" if wanted_low else "low"]:
        return high if wanted_low else low
    while high - low > TOLERANCE:
        tried = [low + (high - low) * (k + 1) / (STEPS + 1) for k in range(STEPS)]
        row = shares.agg(*[reached(x).alias(f"x{k}") for k, x in enumerate(tried)]).first()
        fits = [bool(x) for x in row]
        # one side of the bounds reaches the target, the other does not
        turn = next((k for k, fit in enumerate(fits) if fit != wanted_low), STEPS)
        bounds = [low, *tried, high]
        low, high = bounds[turn], bounds[turn + 1]
    return low if wanted_low else high


def _number(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def plan(
    counted: DataFrame, repetition_limit: float | None, target_entropy: float | None, budget_tokens: int | None
) -> DataFrame:
    """One row a source: mix_source, total, blocks, weight, passes (a double), whole, part (tokens)."""
    sources = counted.groupBy("mix_source").agg(F.sum("mix_tokens").alias("total"), F.count("*").alias("n"))
    sources = saved(sources, "sources")
    every = float(max(1, sources.agg(F.sum("total").alias("t")).first()["t"] or 0))
    share = F.col("total") / F.lit(every)
    shares = sources.where("total > 0").select(share.alias("share"))
    ratio = None if budget_tokens is None else budget_tokens / every
    exponent = find_exponent(shares, repetition_limit, target_entropy, ratio)
    summed = shares.agg(
        F.sum(F.pow("share", F.lit(exponent))).alias("sum"), F.min(F.pow("share", F.lit(exponent - 1))).alias("least")
    ).first()
    weight = F.when(F.col("total") > 0, F.pow(share, F.lit(exponent)) / F.lit(summed["sum"])).otherwise(0.0)
    per_token = F.pow(share, F.lit(exponent - 1))
    if ratio is None:
        passes = per_token / F.lit(summed["least"])
    else:
        passes = per_token / F.lit(summed["sum"]) * F.lit(ratio)
    passes = F.when(F.col("total") > 0, passes).otherwise(1.0)
    return sources.select(
        "mix_source",
        "total",
        F.ceil(F.sqrt("n")).cast("long").alias("mix_blocks"),
        weight.alias("mix_weight"),
        F.floor(passes).cast("long").alias("mix_whole"),
        F.ceil((passes - F.floor(passes)) * F.col("total")).cast("long").alias("mix_part"),
    )


def _own_name(column: str, docs: DataFrame) -> str:
    """What an input column is called in the result."""
    name = column
    while name in ADDED or (name != column and name in docs.columns):
        name = f"input_{name}"
    return name


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``mix`` with the input's columns alone."""
    found = mix(docs, **options)
    return found.select(*[named(_own_name(c, docs))[0].alias(c) for c in docs.columns])


def mix(
    docs: DataFrame,
    source_column: str = "source",
    id_column: str = "doc_id",
    text_column: str = "text",
    repetition_limit: float | None = None,
    target_entropy: float | None = None,
    budget_tokens: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """The input's rows, as often as their source's budget has them.

    Columns: those of the input, then mix_copy (the pass), mix_block, mix_tokens, mix_weight, and mix_order,
    by which the rows of a pass over a source are sorted.
    """
    source, key, text = named(source_column, id_column, text_column)
    source, key = (F.coalesce(c.cast("string"), F.lit("")) for c in (source, key))
    counted = docs.select(source.alias("mix_source"), token_count(text).alias("mix_tokens"))
    sources = saved(plan(counted, repetition_limit, target_entropy, budget_tokens), "mix-plan")
    whole = docs.select(
        packed(docs).alias("row"),
        source.alias("mix_source"),
        key.alias("mix_key"),
        token_count(text).alias("mix_tokens"),
    )
    placed = whole.join(sources, "mix_source").withColumn(
        "mix_block", F.pmod(_number(F.concat(F.lit(f"{seed}:block:"), "mix_key")), F.col("mix_blocks"))
    )

    def row_order(copy: Column) -> Column:
        return F.md5(F.concat_ws(":", F.lit(str(seed)), copy.cast("string"), "mix_key"))

    def block_order(copy: Column) -> Column:
        return F.md5(F.concat_ws(":", F.lit(str(seed)), copy.cast("string"), "mix_source", F.col("mix_block").cast("string")))

    # tokens before each block in the pass that is not whole; one row a block
    light = placed.select("mix_source", "mix_block", "mix_tokens", "mix_whole", "mix_part")
    blocks = light.groupBy("mix_source", "mix_block", "mix_whole", "mix_part").agg(F.sum("mix_tokens").alias("size"))
    inside = Window.partitionBy("mix_source").orderBy(block_order(F.col("mix_whole")), "mix_block")
    blocks = blocks.select("mix_source", "mix_block", (F.sum("size").over(inside) - F.col("size")).alias("mix_before"))
    rows = placed.join(blocks, ["mix_source", "mix_block"])
    within = Window.partitionBy("mix_source", "mix_block").orderBy(row_order(F.col("mix_whole")), "mix_tokens")
    before = F.col("mix_before") + F.sum("mix_tokens").over(within) - F.col("mix_tokens")
    copies = F.col("mix_whole") + (before < F.col("mix_part")).cast("long")
    rows = rows.withColumn("mix_copies", copies).where("mix_copies > 0")
    rows = rows.withColumn("mix_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mix_copies") - 1)))
    order = F.concat(block_order(F.col("mix_copy")), row_order(F.col("mix_copy")))
    own = [F.col("row")[c].alias(_own_name(c, docs)) for c in docs.columns]
    return rows.select(*own, "mix_copy", "mix_block", "mix_tokens", "mix_weight", order.alias("mix_order"))
