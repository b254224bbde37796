"""The trie of conversation prefixes, as a burst trie.

A turn is an id, the hash of its role and text; a prefix of a conversation is known by the combined hashes
of its turns. A container holds the suffixes of all conversations that share a prefix and the next turn.
One with more than LIMIT turns bursts: its prefix becomes a trie head, and its suffixes are dealt by
their next turn to smaller containers. As the turns under a prefix are a sum, bursting is done at all
depths at once: the heads are the prefixes with more turns than the limit. The containers left go to
shards (a partition each), where their suffixes are sorted and swept into nodes. What a subtree adds up
to is handed from containers to heads by sums along each conversation, so there are no pairs of
nodes and ancestors. Equal conversations are one with a weight.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from changetide.llm.common import map_arrow, stored
from changetide.llm.order import batches_of, placed, running, runs, side_by_side
from changetide.llm.quality import split_words
from changetide.session import drop_scratch

#: Turns in a container; ids that are joined to one text; rows of a prefix that meet its head in one task.
LIMIT, IDS, SALTS = 8192, 4096, 16
PREFIX = ["place", "a", "b"]
NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string, a bigint, b bigint"


def turn_id(role: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))


def identified(turns: DataFrame) -> DataFrame:
    """Turns as conv_id, turn, tid, words; a null role or text is empty, rows without a conv_id go."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        turn_id(role, text).alias("tid"),
        F.size(split_words(text)).cast("long").alias("words"),
    )


class Scratch:
    """Stored tables of a job, dropped together."""

    def __init__(self, spark):
        self.spark, self.folders = spark, []

    def __call__(self, rows: DataFrame, name: str) -> DataFrame:
        table, folder = stored(rows, name)
        self.folders.append(folder)
        return table

    def drop(self) -> None:
        for folder in self.folders:
            drop_scratch(self.spark, folder)


def rebuilt(turns: DataFrame, keep: Scratch, group: int = 20, shared: int = 4) -> tuple[DataFrame, DataFrame]:
    """Every conversation c with the first h turns of conversation c-c%20 before its own turns after its first h.

    h is crc32(c) % 4. Returns conversations (conv_id, n_turns) and their turns (conv_id, place from 1, tid, words).
    """
    own, folder = placed(identified(turns), ["conv_id"], ["turn", "tid"], "turns")
    keep.folders.append(folder)
    own = keep(own.select("conv_id", (F.col("place") + 1).alias("place"), "tid", "words", F.col("size").alias("n")), "own")
    sizes = own.groupBy("conv_id").agg(F.first("n").alias("n"))
    origin = sizes.select(F.col("conv_id").alias("origin"), F.col("n").alias("n_origin"))
    head = F.crc32(F.col("conv_id").cast("string")) % shared
    shapes = sizes.withColumns({"h": head, "origin": F.col("conv_id") - F.col("conv_id") % group}).join(origin, "origin", "left")
    taken = F.least("h", F.coalesce("n_origin", F.lit(0)))
    shapes = shapes.select("conv_id", "origin", "h", taken.alias("taken"), (taken + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("n_turns"))
    shapes = keep(shapes, "shapes")
    rest = own.join(shapes, "conv_id").where(F.col("place") > F.col("h"))
    rest = rest.select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "tid", "words", "n_turns")
    first = own.where(F.col("place") < shared).select(F.col("conv_id").alias("origin"), "place", "tid", "words")
    lent = shapes.where("taken > 0").join(first, "origin").where(F.col("place") <= F.col("taken"))
    lent = lent.select("conv_id", "place", "tid", "words", "n_turns")
    return shapes.select("conv_id", "n_turns"), keep(rest.unionByName(lent), "rebuilt")


def with_turn_hashes(turns: DataFrame) -> DataFrame:
    return turns.withColumns({n: F.xxhash64(F.lit(seed), "place", "tid") for n, seed in (("h", 1), ("g", 2))})


def distinct_conversations(convs: DataFrame, turns: DataFrame, keep: Scratch) -> DataFrame:
    """One row per sequence of turns: conv_id (the smallest that has it), n_turns, weight, ends (hash of all that have it)."""
    hashes = turns.groupBy("conv_id").agg(F.expr("bit_xor(h)").alias("a"), F.expr("bit_xor(g)").alias("b"))
    zero = F.lit(0).cast("long")
    known = convs.join(hashes, "conv_id", "left").select("conv_id", "n_turns", F.coalesce("a", zero).alias("a"), F.coalesce("b", zero).alias("b"))
    known = keep(known, "known")
    same = ["n_turns", "a", "b"]
    classes = keep(known.groupBy(*same).agg(F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("weight")), "classes")
    # Only conversations with copies are looked at again.
    copies = classes.where("weight > 1").select(*same, "least")
    ends, folder = ids_digest(known.join(copies, same).select(F.col("least").alias("key"), F.col("conv_id").alias("id")))
    keep.folders.append(folder)
    alone = F.sha2(F.col("least").cast("string"), 256)
    found = classes.join(ends, F.col("least") == F.col("key"), "left")
    return keep(found.select(F.col("least").alias("conv_id"), "n_turns", "weight", F.coalesce("digest", alone).alias("ends")), "distinct")


def ids_digest(rows: DataFrame) -> tuple[DataFrame, str]:
    """SHA-256 of a key's ids, in order and joined by commas: key, digest; and a folder to drop later.

    Parts of the text are made by many tasks; the hash itself, which is sequential, streams through them.
    """
    numbered, folder = placed(rows, ["key"], ["id"], "ids")
    ids = F.transform(F.array_sort(F.collect_list("id")), lambda i: i.cast("string"))
    parts = numbered.groupBy("key", F.floor(F.col("place") / IDS).alias("part")).agg(F.array_join(ids, ",").alias("text"))

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("key", pa.int64()), ("digest", pa.string())])

        def whole():
            key, state = None, None
            for batch in batches:
                for k, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                    if state is not None and k == key:
                        state.update(b",")
                    else:
                        if state is not None:
                            yield {"key": [key], "digest": [state.hexdigest()]}
                        key, state = k, hashlib.sha256()
                    state.update(text.as_buffer())
            if state is not None:
                yield {"key": [key], "digest": [state.hexdigest()]}

        return batches_of(whole(), kinds)

    return map_arrow(side_by_side(parts, ["key"], ["part"]), digest, "key bigint, digest string"), folder


def prefixes(distinct: DataFrame, turns: DataFrame) -> DataFrame:
    """A row per prefix of each distinct conversation, the empty one included.

    place (its number of turns), a and b (its hash), pa and pb (the hash without the last turn), tid and words
    of the last turn, n_turns, weight, ends (at the whole conversation, else null).
    """
    rolled = running(turns.join(distinct.select("conv_id"), "conv_id", "left_semi"), "conv_id", "place", ["h", "g"], "bit_xor")
    rows = rolled.join(distinct, "conv_id").select(
        "conv_id", "place", F.col("h").bitwiseXOR(F.col("h_before")).alias("a"), F.col("g").bitwiseXOR(F.col("g_before")).alias("b"),
        F.col("h_before").alias("pa"), F.col("g_before").alias("pb"), "tid", "words", "n_turns", "weight", "ends",
    )
    zero = F.lit(0).cast("long")
    empty = distinct.select("conv_id", zero.alias("place"), zero.alias("a"), zero.alias("b"), zero.alias("pa"), zero.alias("pb"), zero.alias("words"), "n_turns", "weight", "ends")
    both = rows.unionByName(empty, allowMissingColumns=True)
    return both.withColumn("ends", F.when(F.col("place") == F.col("n_turns"), F.col("ends")))


def burst(rows: DataFrame, limit: int) -> DataFrame:
    """Trie heads: prefixes under which lie more than `limit` turns, and the root."""
    load = F.sum(F.col("n_turns") - F.col("place") + 1)
    found = rows.groupBy(*PREFIX).agg(
        load.alias("load"), F.min("conv_id").alias("least"), F.sum("weight").alias("members"), F.max("words").alias("head_words"),
        F.max("ends").alias("head_ends"), F.max("pa").alias("head_pa"), F.max("pb").alias("head_pb"),
    )
    return found.where((F.col("load") > limit) | (F.col("place") == 0)).drop("load")


def meet_heads(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Adds `least` and `members` of the head that a row's prefix is; a head may have most rows, so it is salted."""
    salted = heads.select(*PREFIX, "least", "members", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, [*PREFIX, "salt"], "left").drop("salt")


def sweep(run: dict[str, list]) -> dict[str, list]:
    """Nodes of one container, which is a subtree: its suffixes are sorted, and each opens the nodes it does not share.

    Rows are in order of conversation and place. The node of the container's first turn comes first; a and b are
    the prefix it hangs from, and null in all other nodes.
    """
    suffixes: dict[int, list[int]] = {}
    for row, conv in enumerate(run["conv_id"]):
        suffixes.setdefault(conv, []).append(row)
    tids, words, weights, ends = run["tid"], run["words"], run["weight"], run["ends"]
    ordered = sorted(suffixes.items(), key=lambda item: [tids[r] for r in item[1]])
    depth, nodes, open_, last = run["place"][0], [], [], []

    def close() -> None:
        node = open_.pop()
        node["saved"] += (node["members"] - 1) * node["words"]
        node["leaves"] += not node["children"]
        if open_:
            up = open_[-1]
            up["children"] += 1
            for name in ("members", "saved", "leaves"):
                up[name] += node[name]
            up["least"] = min(up["least"], node["least"])
            node["up"] = up

    for conv, rows in ordered:
        path = [tids[r] for r in rows]
        shared = 0
        while shared < min(len(path), len(last)) and path[shared] == last[shared]:
            shared += 1
        while len(open_) > shared:
            close()
        for r in rows[shared:]:
            node = {"depth": depth + len(open_), "words": words[r], "members": 0, "saved": 0, "leaves": 0, "children": 0, "least": conv, "ends": None, "up": None}
            nodes.append(node)
            open_.append(node)
        # Sorted, a suffix ends at the node opened last; distinct ones end at different nodes.
        open_[-1]["members"] += weights[rows[-1]]
        open_[-1]["least"] = min(open_[-1]["least"], conv)
        open_[-1]["ends"] = ends[rows[-1]]
        last = path
    while open_:
        close()
    return {
        "conv_id": [n["least"] for n in nodes],
        "depth": [n["depth"] for n in nodes],
        "parent_conv_id": [n["up"]["least"] if n["up"] else run["head_least"][0] for n in nodes],
        "n_convs": [n["members"] for n in nodes],
        "n_children": [n["children"] for n in nodes],
        "n_leaves": [n["leaves"] for n in nodes],
        "saved_tokens": [n["saved"] for n in nodes],
        "ends": [n["ends"] for n in nodes],
        "a": [None if n["up"] else run["ha"][0] for n in nodes],
        "b": [None if n["up"] else run["hb"][0] for n in nodes],
    }


def sweep_containers(rows: DataFrame) -> DataFrame:
    """Nodes of all containers. A container is keyed by its head (depth, ha, hb) and the next turn."""
    kinds = pa.schema([(n, pa.string() if n == "ends" else pa.int64()) for n in (field.split()[0] for field in NODE.split(", "))])

    def shard(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(map(sweep, runs(batches, ["depth", "ha", "hb", "next"])), kinds)

    return map_arrow(side_by_side(rows, ["depth", "ha", "hb", "next"], ["conv_id", "place"]), shard, NODE)


def trie_nodes(turns: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Per distinct prefix of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Turns of a conversation are in order of their number, null first; turns of one number are in order of
    the MD5 of their length-marked role and text, repeated rows are turns each. A null role or text is
    empty. Rows without a conv_id are no conversation's and are left out. The origin of a negative id
    follows SQL's remainder, which has the sign of the id. Other columns are not read. An empty table has no
    conversation and gives no rows, not even a root. Turns and prefixes are told apart by 128 bits of hash.
    """
    keep = Scratch(turns.sparkSession)
    convs, seq = rebuilt(turns, keep)
    seq = with_turn_hashes(seq)
    distinct = distinct_conversations(convs, seq, keep)
    rows = keep(prefixes(distinct, seq.drop("n_turns")), "prefixes")
    heads = keep(burst(rows, limit), "heads")
    met = keep(meet_heads(rows, heads), "met")
    is_head = F.col("least").isNotNull()
    # The container of a conversation hangs from the last head on its path.
    first = F.min(F.when(~is_head, F.struct("place", "pa", "pb", "tid"))).alias("first")
    hung = met.groupBy("conv_id").agg(first, F.max_by("least", F.when(is_head, F.col("place"))).alias("head_least"))
    hung = hung.where("first is not null").select(
        "conv_id", "head_least", F.col("first.place").alias("depth"), F.col("first.pa").alias("ha"), F.col("first.pb").alias("hb"), F.col("first.tid").alias("next")
    )
    contained = met.where(~is_head).select("conv_id", "place", "tid", "words", "weight", "ends").join(hung, "conv_id")
    swept = keep(sweep_containers(contained), "swept")
    tops = swept.where("a is not null")
    in_heads = head_nodes(met.where(is_head), heads, tops)
    nodes = swept.drop("a", "b").unionByName(in_heads)
    nodes, _ = stored(nodes.withColumn("ends_sha256", F.coalesce("ends", F.sha2(F.lit(""), 256))).drop("ends"), "nodes")
    keep.drop()
    return nodes


def head_nodes(on_heads: DataFrame, heads: DataFrame, tops: DataFrame) -> DataFrame:
    """Nodes of the trie heads: what lies below is summed along conversations, and then over each head's conversations.

    A node is counted by the smallest conversation that has it, a container by that of its first node; what
    a conversation counts from a place on is a running sum.
    """
    spoken = F.col("least") == F.col("conv_id")
    value = F.when(spoken, (F.col("members") - 1) * F.col("words")).otherwise(0).cast("long")
    told = running(on_heads.select("conv_id", *PREFIX, value.alias("v")), "conv_id", "place", ["v"], "sum")
    tail = tops.select("conv_id", F.col("saved_tokens").alias("tail"), F.col("n_leaves").alias("tail_leaves"))
    below = told.join(tail, "conv_id", "left").groupBy(*PREFIX).agg(
        F.sum(F.col("v_all") - F.col("v_before") + F.coalesce("tail", F.lit(0))).alias("saved_tokens"),
        F.sum(F.coalesce("tail_leaves", F.lit(0))).alias("leaves_below"),
    )
    child_heads = heads.where("place > 0").select((F.col("place") - 1).alias("place"), F.col("head_pa").alias("a"), F.col("head_pb").alias("b"))
    child_containers = tops.select((F.col("depth") - 1).alias("place"), "a", "b")
    children = child_heads.unionByName(child_containers).groupBy(*PREFIX).agg(F.count(F.lit(1)).alias("n_children"))
    parents = heads.select((F.col("place") + 1).alias("place"), F.col("a").alias("head_pa"), F.col("b").alias("head_pb"), F.col("least").alias("parent_conv_id"))
    found = heads.join(below, PREFIX).join(children, PREFIX, "left").join(parents, ["place", "head_pa", "head_pb"], "left")
    n_children = F.coalesce("n_children", F.lit(0)).cast("long")
    return found.select(
        F.col("least").alias("conv_id"),
        F.col("place").alias("depth"),
        "parent_conv_id",
        F.col("members").alias("n_convs"),
        n_children.alias("n_children"),
        F.when(n_children == 0, F.lit(1)).otherwise(F.col("leaves_below")).cast("long").alias("n_leaves"),
        "saved_tokens",
        F.col("head_ends").alias("ends"),
    )
