"""SimHash near-duplicates by covering locality-sensitive hashing.

Each bit of a fingerprint has a non-zero vector of three bits; a table per non-zero vector
compares the bits whose own vector is not orthogonal to it. The vectors of any two bits leave
some third one orthogonal to both, so every pair within two differing bits agrees in the
whole key of at least one of the seven tables: no pair is missed. Buckets hold distinct
fingerprints, so copies cost nothing. The few large buckets are not compared pairwise: two
fingerprints within two bits have a common neighbour within one, and no point has more
than 65 neighbours. Links form components by alternating star contractions, each written
to the shared folder.

Defined results: a null or wordless text has fingerprint zero and is linked like any other;
repeated rows each get their own, equal row; rows with a null id take part, but a component
is named by its smallest id that is not null (null if there is none); an empty table
gives an empty one; other columns are not read, and returned unchanged by ``drop_near``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import annotate, free_name, texts_of

SHINGLE = 3
RADIUS = 2  # the tables and the neighbours below are made for two bits
SEED = 42
#: Buckets of more fingerprints are linked through common neighbours instead of pairs.
PAIRED = 64
_BLOCK = 1 << 16


def shingles(words: list[bytes], size: int) -> list[bytes]:
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return [b" ".join(s) for s in zip(*[words[i:] for i in range(size)])]


def fingerprinter(size: int = SHINGLE) -> Callable[[], Callable[[bytes], dict]]:
    def make() -> Callable[[bytes], dict]:
        import xxhash

        digest = xxhash.xxh64_intdigest

        def fingerprint(text: bytes) -> dict:
            own = shingles(text.lower().split(), size)
            counts = np.zeros(64, np.int64)
            for i in range(0, len(own), _BLOCK):
                hashes = np.array([digest(s, SEED) for s in own[i : i + _BLOCK]], "<u8")
                bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                counts += bits.sum(axis=0, dtype=np.int64)
            set_bits = np.packbits(2 * counts > len(own), bitorder="little")
            return {"fingerprint": int(set_bits.view("<i8")[0])}

        return fingerprint

    return make


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE
) -> DataFrame:
    """``id, fingerprint``; the 64 bits as a signed number."""
    texts = texts_of(docs, id_col, text_col)
    return annotate(texts, "text", fingerprinter(size), "fingerprint long", ["id"])


def masks() -> list[int]:
    """The bits that each table compares, as signed numbers."""
    found = []
    for table in range(1, 8):
        mask = sum(1 << bit for bit in range(64) if (table & (bit % 7 + 1)).bit_count() % 2)
        found.append(mask - (mask >> 63 << 64))
    return found


def links(nodes: DataFrame, paired: int = PAIRED) -> DataFrame:
    """``a, b``: enough of the pairs of distinct ``fingerprint`` values within two bits to
    connect all that such pairs connect; every pair where buckets are small."""
    node = F.col("fingerprint")
    keys = F.array(
        *[
            F.struct(F.lit(i).alias("table"), node.bitwiseAND(F.lit(m).cast("long")).alias("key"))
            for i, m in enumerate(masks())
        ]
    )
    rows = nodes.select("fingerprint", F.explode(keys).alias("k")).select("fingerprint", "k.*")
    sizes = rows.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1")
    sized = rows.join(sizes, ["table", "key"])
    small = (
        sized.where(F.col("n") <= paired)
        .groupBy("table", "key")
        .agg(F.collect_list("fingerprint").alias("all"))
        .select(F.explode("all").alias("a"), "all")
    )
    near = small.select(
        "a",
        F.explode(
            F.filter(
                "all",
                lambda x: (x > F.col("a")) & (F.bit_count(x.bitwiseXOR(F.col("a"))) <= RADIUS),
            )
        ).alias("b"),
    )
    flips = F.transform(
        F.array(*[F.lit((1 << i) - ((1 << i) >> 63 << 64)).cast("long") for i in range(64)]),
        lambda bit: bit.bitwiseXOR(node),
    )
    around = (
        sized.where(F.col("n") > paired)
        .select("fingerprint")
        .distinct()
        .select("fingerprint", F.explode(F.concat(F.array(node), flips)).alias("point"))
        .groupBy("point")
        .agg(F.sort_array(F.collect_list("fingerprint")).alias("all"))
        .where(F.size("all") > 1)
        .select(
            F.col("all")[0].alias("a"),
            F.explode(F.slice("all", F.lit(2), F.size("all") - 1)).alias("b"),
        )
    )
    return near.union(around).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each linked node can reach.

    ``edges`` has pairs ``a, b``. Large and small stars alternate until only stars are left,
    which one count by node tells; each round is written, and the number of rounds grows with
    the logarithm of the size of the largest component. A node with many neighbours is a
    large key of a join, not of a group, and adaptive execution splits it.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "links")
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # At most a row for each edge, so equal rows are left to the small stars.
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u != v"), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        edges = written(small, "small-star")
        if _all_stars(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _all_stars(edges: DataFrame) -> bool:
    """Whether each ``u`` has one ``v`` and no ``v`` is itself a ``u``; every ``u > v``."""
    roles = edges.select(
        F.explode(
            F.array(
                F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
            )
        ).alias("role")
    ).select("role.*")
    counted = roles.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counted.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE
) -> DataFrame:
    """``id, fingerprint, component``: the component is the smallest id that can be reached."""
    rows = written(fingerprints(docs, id_col, text_col, size), "fingerprints")
    nodes = written(
        rows.groupBy("fingerprint").agg(F.min("id").alias("least")), "distinct-fingerprints"
    )
    roots = components(links(nodes))
    named = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    of_node = named.join(least, "root").select("fingerprint", "component")
    return rows.join(of_node, "fingerprint").select("id", "fingerprint", "component")


def drop_near(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE
) -> DataFrame:
    """The documents, all columns, that have their component's smallest id; one row of each.

    Rows with a null id cannot be told apart and all stay.
    """
    groups = written(near_groups(docs, id_col, text_col, size), "near-groups")
    key = free_name(docs, "kept_id")
    keepers = written(
        groups.where(F.col("id") == F.col("component"))
        .groupBy(F.col("id").alias(key))
        .agg(F.count("*").alias("rows")),
        "kept-ids",
    )
    own = F.col(f"`{id_col}`")

    def among(ids: DataFrame) -> DataFrame:
        # The same plan at every size: the ids grow with the documents, so no broadcast.
        return docs.join(ids.select(key).hint("merge"), own == F.col(key), "left_semi")

    if keepers.where("rows > 1").isEmpty():
        kept = among(keepers)
    else:
        repeated = among(keepers.where("rows > 1")).dropDuplicates([id_col])
        kept = among(keepers.where("rows = 1")).union(repeated)
    return kept.union(docs.where(own.isNull()))


def digits(fingerprint: Column) -> Column:
    """A fingerprint's 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
