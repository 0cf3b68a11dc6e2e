"""A Merkle manifest of a documents table: leaf, root and proof of every row, by nested-struct rollup.

Rows get their rank within their language. The rank is cut into digits; the digit columns are grouped away one
after the other, lowest first, and every group becomes one struct that nests the structs of its members and
holds, for each member, the siblings on its way up. Digits are grouped away within blocks of BLOCK ranks, so the
nested struct of a block is bounded however many rows a language has; block tops are the ranks of the next
round, until one top is left. The tops of the languages are rolled up in the same way. On the way down, the path
of a block's top joins its block as one more member of a group, and the nested structs are exploded, which gives
each row its whole path; the proof is a function of the path.

A digit stands for DIGIT levels of the tree. Within a group the levels are computed on the list of hashes: every
RUN consecutive ones, the last run being shorter if need be, become their hash, as long as more than one node of
that level is left in the whole tree.

Defined cases: null values of any column are part of the leaf as `-`; a null doc_id comes first and is
never tampered; rows of equal doc_id are ordered by leaf, and rows that are equal in all columns take
neighbouring places, in any order. A null or empty text is a leaf like any other. An empty table gives an empty
manifest. Only the five columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.operators.numbering import numbered
from playmart.shared import saved

RUN = 2  # nodes that become one
DIGIT = 3  # levels of the tree that one digit of the rank stands for
DIGITS = 3  # digits that are grouped away within a block
FAN = RUN**DIGIT
BLOCK = FAN**DIGITS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_hash(changed: dict[str, Column] | None = None) -> Column:
    """Hash of the fields in order: `-`, or UTF-8 byte count, colon, value."""
    parts = []
    for name in FIELDS:
        value = (changed or {}).get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return digest(*parts)


def _height(n: Column) -> Column:
    """Levels above n leaves: the number of times that n is divided by RUN, rounded up, until it is one."""
    if RUN != 2:
        raise NotImplementedError("height is read off the binary digits")
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _above(nodes: Column) -> Column:
    """The next level: a hash for every RUN nodes, the last run as long as it is."""
    starts = F.sequence(F.lit(0), F.size(nodes) - 1, F.lit(RUN))
    return F.transform(starts, lambda k: F.sha2(F.array_join(F.slice(nodes, k + 1, RUN), ""), 256))


def _run_around(nodes: Column, at: Column) -> Column:
    """What stands left and right of a node in its run."""
    first = at - at % RUN
    left = F.array_join(F.slice(nodes, first + 1, at % RUN), "")
    right = F.array_join(F.slice(nodes, at + 2, RUN - 1 - at % RUN), "")
    return F.struct(left.alias("left"), right.alias("right"))


def _rolled_up(nodes: DataFrame, keys: list[str], level: int) -> DataFrame:
    """One digit grouped away: from (keys, digit, height, node) to (keys, height, node).

    A node is a struct of its hash and of its members, each with its path up to the node.
    """
    members = F.sort_array(F.collect_list(F.struct("digit", "node")))
    grouped = nodes.groupBy(*keys).agg(members.alias("members"), F.max("height").alias("height"))
    names = ["level0"]
    out = grouped.withColumn("level0", F.transform("members", lambda m: m["node"]["hash"]))
    for k in range(DIGIT):
        names.append(f"level{k + 1}")
        here = F.when(F.col("height") > level + k, _above(F.col(names[-2]))).otherwise(F.col(names[-2]))
        out = out.withColumn(names[-1], here)

    def with_path(m: Column) -> Column:
        steps = [
            F.when(F.col("height") > level + k, F.array(_run_around(F.col(names[k]), (m["digit"] / RUN**k).cast("int"))))
            .otherwise(F.array().cast(PATH))
            for k in range(DIGIT)
        ]
        return F.struct(F.concat(*steps).alias("path"), m["node"].alias("node"))

    node = F.struct(F.get(names[-1], F.lit(0)).alias("hash"), F.transform("members", with_path).alias("members"))
    return out.select(*keys, "height", node.alias("node"))


def _blocks(nodes: DataFrame, group: str, level: int) -> DataFrame:
    """(group, rank, height, node) rolled up to (group, block, height, node), all digits in one shuffle."""
    digits = [f"digit{k}" for k in range(DIGITS)]
    rank = F.col("rank") % BLOCK
    parts = [(F.floor(rank / FAN**k) % FAN).cast("int").alias(d) for k, d in enumerate(digits)]
    block = F.floor(F.col("rank") / BLOCK).alias("block")
    out = nodes.select(group, block, *parts, "height", "node").repartition(group, "block")
    for k, digit in enumerate(digits):
        out = out.withColumnRenamed(digit, "digit")
        out = _rolled_up(out, [group, "block", *digits[k + 1 :]], level + k * DIGIT)
    return out


def _forest(leaves: DataFrame, group: str) -> tuple[DataFrame, list[DataFrame]]:
    """(group, hash) of the top of each group's tree, and the blocks of every round, lowest first."""
    rounds = []
    nodes, level = leaves, 0
    while True:
        rounds.append(saved(_blocks(nodes, group, level)))
        tops = rounds[-1].select(group, F.col("block").alias("rank"), "height", F.col("node.hash").alias("hash"))
        if tops.where("rank > 0").isEmpty():
            return tops.select(group, "hash"), rounds
        nodes = tops.select(group, "rank", "height", F.struct("hash").alias("node"))
        level += DIGIT * DIGITS


def _handed_down(blocks: DataFrame, above: DataFrame, group: str) -> DataFrame:
    """(group, rank, above, node) of the members of all blocks; above (group, rank, above) is of the blocks' tops.

    Both kinds of rows meet in a group of two.
    """
    kind = blocks.schema["node"].dataType, above.schema["above"].dataType
    tree = blocks.select(group, "block", "node", F.lit(None).cast(kind[1]).alias("above"))
    path = above.select(group, F.col("rank").alias("block"), F.lit(None).cast(kind[0]).alias("node"), "above")
    met = tree.unionByName(path).groupBy(group, "block").agg(
        F.first("node", ignorenulls=True).alias("node"), F.first("above", ignorenulls=True).alias("above")
    )
    rank, path = F.col("block"), F.col("above.path")
    out = met.select(group, rank.alias("rank"), "node", path.alias("path"), "above")
    for _ in range(DIGITS):
        out = out.select(group, "rank", "path", "above", F.posexplode("node.members").alias("digit", "member"))
        out = out.select(
            group,
            (F.col("rank") * FAN + F.col("digit")).alias("rank"),
            F.concat("member.path", "path").alias("path"),
            "above",
            F.col("member.node").alias("node"),
        )
    return out.select(group, "rank", F.col("above").withField("path", F.col("path")).alias("above"), "node")


def _down(rounds: list[DataFrame], tops: DataFrame, group: str) -> DataFrame:
    """(group, above, node) of all leaves, from (group, above) of the tops."""
    above = tops.select(group, F.lit(0).cast("bigint").alias("rank"), "above")
    for blocks in reversed(rounds[1:]):
        above = _handed_down(blocks, above, group).drop("node")
    return _handed_down(rounds[0], above, group).select(group, "above", "node")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda now, step: F.sha2(F.concat(step["left"], now, step["right"]), 256))


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, siblings (a path from the leaf up) and checked_leaf of every row.

    checked_leaf is the leaf of the row as it is found now: with 1 added to n_chars where `tampered` holds.
    """
    changed = F.when(F.coalesce(tampered, F.lit(False)), F.col("n_chars").cast("bigint") + 1)
    now = leaf_hash({"n_chars": F.coalesce(changed, F.col("n_chars").cast("bigint"))}) if tampered is not None else leaf_hash()
    # The row number only tells equal rows apart.
    rows = saved(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "lang", leaf_hash().alias("hash"), now.alias("checked"),
        F.monotonically_increasing_id().alias("row"),
    ))
    ranked = numbered(rows, ["doc_id", "hash", "row"], within=["lang"], name="rank", start=0)
    sizes = saved(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    sizes = sizes.select(F.col("lang").alias("of"), _height(F.col("n")).alias("height"))
    leaves = ranked.join(sizes, F.col("lang").eqNullSafe(F.col("of"))).select(
        "lang", "rank", "height", F.struct("hash", "doc_id", "checked").alias("node")
    )
    subroots, rounds = _forest(leaves, "lang")

    # The same over the languages, as one group.
    subroots = saved(subroots)
    height = F.lit(subroots.count()).cast("bigint")
    named = numbered(subroots, ["lang"], name="rank", start=0).select(
        F.lit(0).alias("all"), "rank", _height(height).alias("height"), F.struct("hash", "lang").alias("node")
    )
    root, top_rounds = _forest(named, "all")
    empty = F.array().cast(PATH).alias("path")
    top = root.select("all", F.struct(empty, F.col("hash").alias("root")).alias("above"))
    by_lang = _down(top_rounds, top, "all").select(
        F.col("node.lang").alias("lang"), F.col("above").withField("subroot", F.col("node.hash")).alias("above")
    )
    out = _down(rounds, saved(by_lang), "lang")
    return out.select(
        "node.doc_id", F.col("node.hash").alias("leaf"), "above.subroot", "above.root",
        F.col("above.path").alias("siblings"), F.col("node.checked").alias("checked_leaf"),
    )


def proof_hash(path: Column) -> Column:
    """Hash of the siblings, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)
