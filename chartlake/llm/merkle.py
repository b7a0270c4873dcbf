"""Merkle manifest of a dataset, with a persistent (path-copying) version per changed row.

Rows are leaves; per language, ordered by doc_id, every FANOUT consecutive nodes have a
parent, up to one subroot; the subroots, ordered by language, likewise lead to the root.

The leaves are cut into aligned blocks of FANOUT ** HEIGHT leaves, so a block is a subtree of
HEIGHT levels and one bounded row. A changed leaf makes a version that shares all nodes
it doesn't touch: inside its block only the leaf's ancestors are copied; above it the
version goes on along the block's upper path, which the distributed upper levels (runs of
FANOUT nodes, joined level by level) have laid beside the block. No task holds a language,
and no version meets another one in a shuffle.
"""
from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import gapless_index, materialise

FANOUT = 8
HEIGHT = 3                         # levels inside a block
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_PATH = "array<struct<left:string,right:string>>"
_RESULT = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
           "folded_root string, verified boolean, version array<string>")


def leaf_digest(**instead: Column) -> Column:
    """Digest of a row's FIELDS: each ``-`` if null, else its UTF-8 bytes' number, ``:``
    and the value; ``instead`` gives other values for some of them."""
    parts = []
    for name in FIELDS:
        value = instead.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _parent(nodes: list[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def block_tree(leaves: list[str], whole: bool, height: int = HEIGHT) -> list[list[str]]:
    """Levels of a block, its leaves first. A block that is a ``whole`` language ends at
    the first level of one node, any other has ``height`` levels above its leaves."""
    levels = [leaves]
    while len(levels[-1]) > 1 if whole else len(levels) <= height:
        below = levels[-1]
        levels.append([_parent(below[i:i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return levels


def _siblings(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    """What stands left and right of leaf ``i``'s path in its run, level by level."""
    out = []
    for level in levels[:-1]:
        at = i - i % FANOUT
        out.append(("".join(level[at:i]), "".join(level[i + 1:at + FANOUT])))
        i //= FANOUT
    return out


def copy_path(leaf: str, path: list[tuple[str, str]]) -> list[str]:
    """The nodes a version copies: ``leaf`` and its ancestors, everything beside the
    path being shared."""
    copied = [leaf]
    for left, right in path:
        copied.append(sha256((left + copied[-1] + right).encode()).hexdigest())
    return copied


def _roots(height: int):
    def run(batches):
        for b in batches:
            rows, n = b.column("rows").to_pylist(), b.column("n").to_pylist()
            nodes = [block_tree([r["leaf"] for r in x], k <= FANOUT ** height, height)[-1][0] for x, k in zip(rows, n)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(nodes, pa.string())], names=[*b.schema.names, "node"])
    return run


def _versions(height: int):
    def run(batches):
        for b in batches:
            for block in b.to_pylist():
                yield _of_block(block, height)
    return run


def _of_block(block: dict, height: int) -> pa.RecordBatch:
    rows = block["rows"]
    levels = block_tree([r["leaf"] for r in rows], block["n"] <= FANOUT ** height, height)
    upper = [(s["left"], s["right"]) for s in block["path"]]
    out = []
    for i, r in enumerate(rows):
        path = _siblings(levels, i) + upper
        proof = sha256("".join([a + b for a, b in path]).encode()).hexdigest()
        copied = copy_path(r["changed"] or r["leaf"], path)
        out.append((r["doc_id"], r["leaf"], block["subroot"], block["root"], proof, copied[-1],
                    copied[-1] == block["root"], copied if r["changed"] not in (None, r["leaf"]) else []))
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.list_(pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                      names=[f.split()[0] for f in _RESULT.split(", ")])


def _raise(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Upper levels over ``nodes`` (key, idx, node; idx gapless per key): per level its
    runs (key, idx, nodes) with the parent ``node``, and the tops (key, node)."""
    most = nodes.agg(F.max("idx")).first()[0]
    levels = []
    while most is not None and most > 0:
        runs = (nodes.groupBy("key", F.expr(f"idx div {FANOUT}").alias("idx"))
                .agg(F.array_sort(F.collect_list(F.struct("idx", "node")))["node"].alias("nodes"))
                .withColumn("single", (F.col("idx") == 0) & (F.size("nodes") == 1))
                .withColumn("node", F.when(F.col("single"), F.col("nodes")[0])
                            .otherwise(F.sha2(F.concat_ws("", "nodes"), 256))))
        levels.append(materialise(runs, name))
        nodes, most = levels[-1].select("key", "idx", "node"), most // FANOUT
    return levels, nodes.select("key", "node")


def _paths(levels: list[DataFrame], tops: DataFrame, name: str) -> DataFrame:
    """(key, idx, path) of the lowest nodes: what stands left and right of their way up."""
    paths = tops.select("key", F.lit(0).cast("long").alias("idx"), F.expr(f"CAST(array() AS {_PATH})").alias("path"))
    for runs in reversed(levels):
        below = (runs.select("key", "idx", "single", "nodes", F.posexplode("nodes").alias("at", "_node"))
                 .select("key", "idx", "single", "at",
                         F.struct(F.concat_ws("", F.expr("slice(nodes, 1, at)")).alias("left"),
                                  F.concat_ws("", F.expr(f"slice(nodes, at + 2, {FANOUT})")).alias("right")).alias("beside")))
        paths = below.join(paths, ["key", "idx"]).select(
            "key", (F.col("idx") * FANOUT + F.col("at")).alias("idx"),
            F.when(F.col("single"), F.col("path")).otherwise(F.concat(F.array("beside"), "path")).alias("path"))
        paths = materialise(paths, name)
    return paths


def manifest(docs: DataFrame, changed: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256 (digest of the
    siblings on the leaf's way up, of nothing if it has none), folded_root (of the changed
    leaf, else the own one, up the original siblings), verified (equals root) and version
    (the changed leaf and the copied ancestors up to the version's root; empty if the leaf
    stays the same). ``height``: levels of a block, which only moves work.

    ``changed`` gives a row's text after tampering, or null where it was left alone (a
    null text stays null). Nulls in FIELDS are digested as ``-``; a null language is
    a language of its own and comes first, as a null doc_id does in its language. Rows that
    share language and doc_id are ordered by their leaves, so equal rows may change places
    without changing the tree; each gives a row. Texts are digested whole. An empty table
    gives none; columns other than FIELDS are not read."""
    text = F.lit(None).cast("string") if changed is None else changed
    rows = docs.select(*FIELDS).select(
        "doc_id", F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("key"),
        leaf_digest().alias("leaf"), F.when(text.isNotNull(), leaf_digest(text=text)).alias("changed"))
    rows = materialise(rows.withColumn("tie", F.monotonically_increasing_id()), "leaves")
    order = ["doc_id", "leaf", "tie"]
    placed = gapless_index(rows.repartitionByRange("key", *order), "key", order, "pos")
    counts = rows.groupBy("key").agg(F.count("*").alias("n"))
    blocks = (placed.groupBy("key", F.expr(f"pos div {FANOUT ** height}").alias("idx"))
              .agg(F.array_sort(F.collect_list(F.struct("pos", "doc_id", "leaf", "changed"))).alias("rows"))
              .join(counts, "key"))
    with_node = T.StructType([*blocks.schema.fields, T.StructField("node", T.StringType())])
    blocks = materialise(blocks.mapInArrow(_roots(height), with_node), "blocks")

    levels, tops = _raise(blocks.select("key", "idx", "node"), "upper")
    of_blocks = _paths(levels, tops, "paths")
    langs = tops.repartitionByRange("key").select(F.lit("").alias("all"), "key", F.col("node").alias("subroot"))
    langs = materialise(gapless_index(langs, "all", ["key"], "idx"), "languages")
    levels, root = _raise(langs.select(F.col("all").alias("key"), "idx", F.col("subroot").alias("node")), "upper")
    of_langs = _paths(levels, root, "paths").withColumnRenamed("key", "all").withColumnRenamed("path", "last")
    langs = (langs.join(of_langs, ["all", "idx"])
             .join(root.select(F.col("key").alias("all"), F.col("node").alias("root")), "all")
             .select("key", "subroot", "root", "last"))
    up = (of_blocks.join(langs, "key")
          .select("key", "idx", "subroot", "root", F.concat("path", "last").alias("path")))
    return blocks.drop("node").join(up, ["key", "idx"]).mapInArrow(_versions(height), _RESULT)


def tampered(every: int = 3) -> Column:
    """The text of each document whose crc32 of the decimal doc_id ``every`` divides, with
    A-Z in lower case; null elsewhere."""
    return F.when(F.crc32(F.col("doc_id").cast("string")) % every == 0, F.translate("text", UPPER, LOWER))
