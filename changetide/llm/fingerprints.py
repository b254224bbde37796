"""SimHash fingerprints of 128 bits by weighted word pairs, and near ones by permuted block tables.

All of it is DataFrame functions. The terms of a text are its pairs of adjacent words, each as often as it
occurs, weighted by the letters of the pair; each votes on every bit by the hash of the term. Votes of
two bits share a number (32 bits each), so a term adds to 64 sums in one generated loop.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from changetide.llm.common import stored, text_or_empty
from changetide.llm.linking import linked_classes

_SPACES = r"[\x20\x09-\x0D]+"
_LAST = (1 << 63) - 1
_LANES = (1 << 32) | 1
BITS, BLOCKS, RADIUS, HEAVIEST = 128, 8, 6, 16


def terms(words: Column) -> Column:
    """Hash and weight of each pair of neighbours; of a single word if there is but one; else none."""
    count = F.size(words)
    letters = lambda a, b: F.least(F.length(a) + F.length(b), F.lit(HEAVIEST)).cast("long")
    pair = lambda a, b: F.struct(F.xxhash64(a, b).alias("h"), letters(a, b).alias("w"))
    pairs = F.zip_with(F.slice(words, 1, F.greatest(count - 1, F.lit(0))), F.slice(words, 2, F.greatest(count - 1, F.lit(0))), pair)
    alone = F.transform(words, lambda a: pair(a, F.lit("")))
    return F.when(count > 1, pairs).otherwise(alone)


def votes(hash_: str, name: str) -> list[Column]:
    """Weighted sums for bits i and i + 32 of a hash, as one number each."""
    bit = lambda i: F.shiftrightunsigned(F.col(hash_), i).bitwiseAND(F.lit(_LANES))
    return [F.sum(bit(i) * F.col("w")).alias(f"{name}{i}") for i in range(32)]


def majority(name: str) -> Column:
    """64 bits from the sums: set where over half of the weight voted for it."""

    def wins(value: Column, at: int) -> Column:
        return F.shiftleft((2 * value > F.col("weight")).cast("long"), at)

    low = [wins(F.col(f"{name}{i}").bitwiseAND(F.lit((1 << 32) - 1)), i) for i in range(32)]
    high = [wins(F.shiftrightunsigned(F.col(f"{name}{i}"), 32), i + 32) for i in range(32)]
    return F.coalesce(reduce(Column.bitwiseOR, low + high), F.lit(0).cast("long"))


def simhash(texts: DataFrame, keys: list[str]) -> DataFrame:
    """Fingerprint halves of each row's text: keys, hi, lo. Rows need distinct keys; no words, all bits zero."""
    words = F.array_remove(F.split(F.lower(F.coalesce("text", F.lit(""))), _SPACES), "")
    split = texts.select(*keys, F.explode(F.array(words)).alias("words"))  # a generator splits once
    voters = split.select(*keys, F.explode_outer(terms(F.col("words"))).alias("term"))
    voters = voters.select(*keys, F.col("term.h").alias("h"), F.col("term.w").alias("w"))
    voters = voters.withColumn("g", F.xxhash64(F.lit(7), "h"))
    sums = voters.groupBy(*keys).agg(F.sum("w").alias("weight"), *votes("h", "h"), *votes("g", "g"))
    return sums.select(*keys, majority("h").alias("hi"), majority("g").alias("lo"))


def hexadecimal(hi: Column, lo: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def differing(a_hi: Column, a_lo: Column, b_hi: Column, b_lo: Column) -> Column:
    return F.bit_count(a_hi.bitwiseXOR(b_hi)) + F.bit_count(a_lo.bitwiseXOR(b_lo))


def block_keys(items: DataFrame) -> DataFrame:
    """Keys of the permuted tables: items within RADIUS bits agree in two of eight blocks at least.

    `items` has the column item, a struct of hi and lo. Each pair of blocks is a table: bucket, item, side.
    """
    width = BITS // BLOCKS

    def block(i: int) -> Column:
        half = F.col("item.hi" if i < BLOCKS // 2 else "item.lo")
        return F.shiftrightunsigned(half, (i % (BLOCKS // 2)) * width).bitwiseAND(F.lit((1 << width) - 1))

    pairs = [(i, j) for i in range(BLOCKS) for j in range(i)]
    keys = [
        F.lit(n << 32).bitwiseOR(F.shiftleft(block(i), width)).bitwiseOR(block(j)) for n, (i, j) in enumerate(pairs)
    ]
    return items.select(F.explode(F.array(*keys)).alias("bucket"), "item", F.lit(3).cast("byte").alias("side"))


def near_classes(items: DataFrame) -> DataFrame:
    """Classes of distinct fingerprints linked within RADIUS bits: item, root; for linked ones only."""
    near = lambda a, b: differing(a["hi"], a["lo"], b["hi"], b["lo"]) <= RADIUS
    return linked_classes(block_keys(items), near)


def following(sizes: DataFrame) -> DataFrame:
    """The next larger id of each: k, n, next_k; after the largest comes the smallest.

    Ids lie in ranges, each ordered alone; only the ranges' first ids, one row a range, are ordered together.
    """
    ranged, _ = stored(sizes.repartitionByRange("k").withColumn("part", F.spark_partition_id()), "ids")
    inside = ranged.withColumn("next_k", F.lead("k").over(Window.partitionBy("part").orderBy("k")))
    firsts = ranged.groupBy("part").agg(F.min("k").alias("first"))
    later = firsts.select("part", F.lead("first").over(Window.orderBy("first")).alias("then"))
    start = ranged.agg(F.min("k").alias("start"))
    found = inside.join(later, "part").crossJoin(start)  # one row
    return found.select("k", "n", F.coalesce("next_k", "then", "start").alias("next_k"))


def fingerprint_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, near_group.

    The edited text has the last half of its characters replaced by the first as many of the next
    document's. Likeness is the share of equal bits. `near_group` is the smallest id among the
    documents linked, directly or through others, within six bits. A null text is empty, a null id the
    largest; of several rows with an id the smallest text stands for it as a next document; every row
    comes out. Other columns are not read. An empty table gives an empty result.
    """
    named = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST)).alias("k"), text_or_empty(text_column).alias("text")
    )
    order, _ = stored(following(named.groupBy("k").agg(F.max(F.length("text")).alias("n"))), "order")
    # Both uses below read one exchange of the texts; a filter on the row number would change it.
    same_id = Window.partitionBy("k").orderBy("text")
    rows = named.withColumns({"row": F.row_number().over(same_id), "opens": F.lag("k").over(same_id).isNull()})
    wanted = order.select(F.col("next_k").alias("k"), F.col("k").alias("before"), F.floor(F.col("n") / 2).cast("int").alias("most"))
    heads = rows.where("opens").join(wanted, "k").select(F.col("before").alias("k"), F.expr("left(text, most)").alias("head"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) AS int))"), F.substring("head", F.lit(1), half))
    both = rows.join(heads, "k").select("k", "row", "text", n.cast("long").alias("n_chars"), edited.alias("edited"))
    kinds = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"))
    )
    variants = both.select("k", "row", "n_chars", F.sha2("edited", 256).alias("sha"), F.inline(kinds))
    prints = simhash(variants, ["k", "row", "n_chars", "sha", "kind"])
    only = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    prints = prints.groupBy("k", "row", "n_chars", "sha").agg(
        only(0, "hi").alias("hi"), only(0, "lo").alias("lo"), only(1, "hi").alias("edited_hi"), only(1, "lo").alias("edited_lo")
    )
    prints, _ = stored(prints, "fingerprints")
    item = F.struct("hi", "lo").alias("item")
    least, _ = stored(prints.groupBy(item).agg(F.min("k").alias("least")), "items")
    placed = least.join(near_classes(least), "item", "left").withColumn("root", F.coalesce("root", "item"))
    groups = placed.groupBy("root").agg(F.min("least").alias("near_group"))
    groups, _ = stored(placed.join(groups, "root").select("item", "near_group"), "groups")
    nexts = prints.where("row = 1").select(F.col("k").alias("next_k"), F.col("hi").alias("next_hi"), F.col("lo").alias("next_lo"))
    found = prints.join(order.select("k", "next_k"), "k").join(nexts, "next_k").withColumn("item", item).join(groups, "item")
    share = lambda a, b: 1 - differing(F.col("hi"), F.col("lo"), F.col(a), F.col(b)) / F.lit(float(BITS))
    back = lambda c: F.when(F.col(c) < _LAST, F.col(c)).cast(docs.schema[id_column].dataType)
    return found.select(
        back("k").alias(id_column),
        "n_chars",
        F.col("sha").alias("edited_sha256"),
        hexadecimal(F.col("hi"), F.col("lo")).alias("fingerprint"),
        hexadecimal(F.col("edited_hi"), F.col("edited_lo")).alias("edited_fingerprint"),
        share("edited_hi", "edited_lo").alias("near_edited"),
        share("next_hi", "next_lo").alias("near_next"),
        back("near_group").alias("near_group"),
    )
