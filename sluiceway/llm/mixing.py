"""Mix sources to target weights by repeating documents.

Words are added up per source. A source's target is its share, by weight, of a total amount;
a source that would have to be repeated too often is held at its limit and the excess goes to
the others by weight, until none is above. From its repetition rate, every document is taken
``floor(rate)`` times, plus once more with a probability equal to the fraction, decided by a
hash of the seed and the document's id. The draw needs no random state: a retried task and a
second run decide alike.

Documents are never moved: only the sums of sources are shuffled, pre-aggregated by task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.texts import fresh, quoted
from sluiceway.operators import dense_key, stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SEED = "mix-1"
#: Hexadecimal digits of the hash that make the draw: exact in a double.
_DIGITS = 13

PLAN = ("source_size", "target", "rate")


def n_words(text: Column) -> Column:
    """Number of words; null and empty texts have none."""
    # A word begins where a non-space follows a space or the beginning.
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def plan_rates(
    sizes: DataFrame,
    source: str,
    size: str,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target`` and ``rate``.

    ``sizes`` has one row per document. Sources in code point order, null last, take the
    weights in turn. The targets add up to ``share`` times all words, unless every source is
    at its limit of ``most`` times its own. A source without words has target and rate 0.
    """
    summed = sizes.groupBy(source).agg(F.sum(size).alias("source_size"))
    # Ranked by range partitions, so the list of sources may be long.
    ranked = dense_key(stage(summed, "mix-sources"), [source], "_place", label="mix-rank")
    turns = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<double>")
    turn = (F.col("_place") % len(weights)).cast("int")
    weighed = stage(
        ranked.select(
            source,
            "source_size",
            F.get(turns, turn).alias("_weight"),
            (F.col("source_size") * F.lit(float(most))).alias("_limit"),
        ),
        "mix-weights",
    )

    # The level is the amount per unit of weight. Each pass holds more sources at their limit;
    # it ends when a pass holds no further one, so it runs at most once per source.
    total = share * (weighed.agg(F.sum("source_size")).head()[0] or 0)
    level, held = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("_limit") < F.col("_weight") * F.lit(level)
        row = weighed.agg(
            F.count(F.when(above, 1)).alias("held"),
            F.sum(F.when(above, F.col("_limit")).otherwise(0.0)).alias("full"),
            F.sum(F.when(~above, F.col("_weight")).otherwise(0.0)).alias("open"),
        ).head()
        if row["held"] == held or not row["open"]:
            break
        held, level = row["held"], (total - row["full"]) / row["open"]
    by_level = F.col("_limit") if level is None else F.col("_weight") * F.lit(level)
    target = F.least(F.col("_limit"), by_level)
    return weighed.select(
        source,
        "source_size",
        target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def draw(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the MD5 of seed and key; a null key counts as empty."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    whole = F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("bigint").cast("double")
    return whole / F.lit(float(16**_DIGITS))


def plan_mix(
    df: DataFrame,
    key: str,
    text: str,
    source: str,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    seed: str = SEED,
) -> DataFrame:
    """``df`` with ``size``, ``source_size``, ``target``, ``rate`` and ``copies`` of each document.

    A null text has size 0; a null source is a source of its own; a null key draws like an
    empty one. Rows with the same key draw alike. An empty table stays empty. Input columns
    named like an output column are replaced.
    """
    names = ("size", *PLAN, "copies")
    size, own = fresh(df, "size", "source")
    kept = [F.col(quoted(c)) for c in df.columns if c not in names]
    inputs = {c: F.col(quoted(c)) for c in (key, source)}
    drawn, by = fresh(df, "draw", "by")
    sized = df.select(
        *kept,
        n_words(F.col(quoted(text)).cast("string")).alias(size),
        inputs[source].alias(by),
        draw(inputs[key], seed).alias(drawn),
    )
    rates = plan_rates(sized.select(F.col(by).alias(own), size), own, size, weights, share, most)
    joined = sized.join(rates, F.col(by).eqNullSafe(F.col(own)), "left")
    fraction = F.col("rate") - F.floor("rate")
    extra = (F.col(drawn) < fraction).cast("long")
    return joined.select(
        *kept, F.col(size).alias("size"), *PLAN, (F.floor("rate") + extra).alias("copies")
    )


def repeat_rows(df: DataFrame, copies: str) -> DataFrame:
    """Every row as often as its column ``copies`` says, without that column."""
    times = F.explode(F.array_repeat(F.lit(0).cast("byte"), F.col(quoted(copies)).cast("int")))
    (copy,) = fresh(df, "copy")
    return df.withColumn(copy, times).drop(copy, copies)
