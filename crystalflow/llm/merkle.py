"""Merkle manifest of a dataset: one 8-ary tree per group of rows, and one over the groups' subroots.

A tree is an append log of its nodes in the order in which they complete: every
leaf, and after the last leaf below a node that node, lower levels first. So a
node's place in the log follows from subtree sizes alone (``position``), and
siblings are found by arithmetic.

Builders are aligned: one takes the 8^4 nodes below one node four levels up, and
appends what completes there, which is one contiguous run of the log. Their
tops are the leaves of the next round, so a group with most of the rows is
spread over as many tasks as it has builders, and no task sees more than 8^4
digests however many rows there are. Proofs run the other way: a round's
builders read back their run, address siblings in it, and hand each node below
the path above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from crystalflow.llm.helpers import running_totals
from crystalflow.operators.scratch import materialise

ARITY = 8
RISE = 4  # levels per round
SPAN = ARITY**RISE
PATH = "array<struct<before: string, after: string>>"  # hex digests of a run on the two sides, bottom up


def height(count: int) -> int:
    """Levels above ``count`` leaves until one node is left."""
    levels = 0
    while count > 1:
        count, levels = -(-count // ARITY), levels + 1
    return levels


def position(level: int, index: int, count: int) -> int:
    """Place of a node in the log of a tree over ``count`` leaves.

    Before its last leaf come all earlier leaves, and of each level above the
    nodes that those completed; after it, the lower nodes that it completes.
    """
    last = min((index + 1) * ARITY**level, count) - 1
    before, done = last, last // ARITY
    while done:
        before, done = before + done, done // ARITY
    return before + level


def combined(texts: bytes) -> bytes:
    """The hex digest of joined hex digests."""
    return hashlib.sha256(texts).hexdigest().encode()


def append_all(leaves: Sequence[bytes], levels: int) -> list[bytes]:
    """The log over ``leaves`` up to ``levels``: hex digests in completion order."""
    log: list[bytes] = []
    open_runs: list[list[bytes]] = [[] for _ in range(levels)]
    for i, node in enumerate(leaves):
        log.append(node)
        for level in range(levels):
            open_runs[level].append(node)
            if len(open_runs[level]) < ARITY and i < len(leaves) - 1:
                break
            node = combined(b"".join(open_runs[level]))
            open_runs[level] = []
            log.append(node)
    return log


@dataclass
class Run:
    """A builder's stretch of the log, with siblings addressed by ``position``."""

    log: Sequence[bytes]
    count: int
    levels: int

    @cached_property
    def sides(self) -> list[list[tuple[bytes, bytes]]]:
        """Per level below the top and node: its run's digests before and after it."""
        out, width = [], self.count
        for level in range(self.levels):
            nodes = [self.log[position(level, k, self.count)] for k in range(width)]
            runs = [nodes[s : s + ARITY] for s in range(0, width, ARITY)]
            out.append([(b"".join(r[:k]), b"".join(r[k + 1 :])) for r in runs for k in range(len(r))])
            width = len(runs)
        return out

    def path(self, index: int) -> list[tuple[bytes, bytes]]:
        return [self.sides[level][index // ARITY**level] for level in range(self.levels)]


def field_text(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Lowercase hex sha256 of the fields' texts in a row."""
    return F.sha2(F.concat(*map(field_text, fields)), 256)


@dataclass
class Manifest:
    """What was built.

    ``leaves``: the rows given with ``tree``, ``index`` and ``count``;
    ``rounds``: a table per round with one row per builder (``tree``,
    ``builder``, ``count`` and ``nodes``: what the round and the builder start
    from, ``levels``, ``log``: its hex digests joined, in completion order,
    ``top``); ``tops``: the last digest of each tree; ``groups``: each group
    with its ``tree``, ``count`` and ``subroot``; ``upper``: the manifest over
    the subroots.
    """

    leaves: DataFrame
    rounds: list[DataFrame]
    tops: DataFrame
    groups: DataFrame | None = None
    upper: Manifest | None = None


def _raise_trees(leaves: DataFrame, digest: str) -> Manifest:
    """Build all trees of ``leaves`` (tree, index, count and the digest column), a round of four levels at a time."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("index")
        tree, count, builder = (table.column(c)[0].as_py() for c in ("tree", "count", "builder"))
        levels = min(RISE, height(count))
        log = append_all([d.encode() for d in table.column("digest").to_pylist()], levels)
        return pa.table(
            {
                "tree": pa.array([tree], pa.int64()),
                "builder": pa.array([builder], pa.int64()),
                "count": pa.array([count], pa.int64()),
                "nodes": pa.array([table.num_rows], pa.int64()),
                "levels": pa.array([levels], pa.int32()),
                "log": pa.array([b"".join(log).decode()], pa.string()),
                "top": pa.array([log[-1].decode()], pa.string()),
            }
        )

    kind = "tree long, builder long, count long, nodes long, levels int, log string, top string"
    nodes = leaves.select("tree", "index", "count", F.col(digest).alias("digest"))
    largest = leaves.agg(F.max("count")).first()[0] or 0
    rounds, tops = [], None
    while True:
        held = nodes.withColumn("builder", F.floor(F.col("index") / SPAN))
        run = materialise(held.groupBy("tree", "builder").applyInArrow(build, kind))
        rounds.append(run)
        done = run.where(F.col("count") <= SPAN).select("tree", F.col("top").alias("digest"))
        tops = done if tops is None else tops.unionByName(done)
        if largest <= SPAN:
            return Manifest(leaves, rounds, tops)
        largest = -(-largest // SPAN)
        nodes = run.where(F.col("count") > SPAN).select(
            "tree", F.col("builder").alias("index"), F.ceil(F.col("count") / SPAN).alias("count"), F.col("top").alias("digest")
        )


def build(rows: DataFrame, group: str, order: Sequence[str], digest: str) -> Manifest:
    """Trees over the hex digests of ``rows``: one per value of ``group`` (null is one), leaves ascending by ``order``.

    The trees' subroots, by group (null first, else bytewise), are the leaves of
    the tree at ``upper``. Nulls in ``order`` come first; rows that tie in it
    ascend by digest, and equal rows are a leaf each. No rows give no trees and
    no root. Column names ``tree``, ``index``, ``count`` and ``place`` are
    taken by the manifest.
    """
    sorted_by = [F.col(c).asc_nulls_first() for c in (group, *order, digest)]
    placed = materialise(running_totals(rows, sorted_by, {"place": F.lit(1).cast("long")}))
    sizes = placed.groupBy(group).agg(F.count(F.lit(1)).alias("count"), F.min("place").alias("start"))
    sizes = materialise(running_totals(sizes, [F.col(group).asc_nulls_first()], {"tree": F.lit(1).cast("long")}))
    keys = sizes.select(F.col(group).alias("_group"), "count", "start", "tree")
    leaves = placed.join(keys, F.col(group).eqNullSafe(F.col("_group")))
    leaves = leaves.withColumn("index", F.col("place") - F.col("start")).drop("_group", "start", "place")
    made = _raise_trees(materialise(leaves), digest)
    subroots = made.tops.withColumnRenamed("digest", "subroot")
    made.groups = materialise(sizes.select(group, "tree", "count").join(subroots, "tree"))
    number = F.lit(made.groups.count()).cast("long")
    over = made.groups.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("index"), number.alias("count"), "subroot")
    made.upper = _raise_trees(materialise(over), "subroot")
    return made


def _runs(made: Manifest, at: int, above: DataFrame) -> DataFrame:
    """The builders of round ``at`` with ``path``, the path above each one's top."""
    run = made.rounds[at]
    if at == len(made.rounds) - 1:
        return run.join(above, "tree")
    higher = _paths(made, at + 1, above).withColumnRenamed("index", "builder")
    ends = run.where(F.col("count") <= SPAN).join(above, "tree")
    goes_on = run.where(F.col("count") > SPAN).join(higher, ["tree", "builder"])
    return ends.unionByName(goes_on.select(*ends.columns))


def _paths(made: Manifest, at: int, above: DataFrame) -> DataFrame:
    """(tree, index, path) of every node that is a leaf to round ``at``, up to the end of ``above`` (tree, path)."""

    def walk(table: pa.Table) -> pa.Table:
        row = table.to_pylist()[0]
        run = _run_of(row)
        upper = [(p["before"], p["after"]) for p in row["path"]]
        own = [[(b.decode(), a.decode()) for b, a in run.path(k)] + upper for k in range(run.count)]
        step = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
        return pa.table(
            {
                "tree": pa.array([row["tree"]] * run.count, pa.int64()),
                "index": pa.array(range(row["builder"] * SPAN, row["builder"] * SPAN + run.count), pa.int64()),
                "path": pa.array([[{"before": b, "after": a} for b, a in p] for p in own], step),
            }
        )

    return _runs(made, at, above).groupBy("tree", "builder").applyInArrow(walk, f"tree long, index long, path {PATH}")


def _run_of(row: dict) -> Run:
    text = row["log"].encode()
    return Run([text[k : k + 64] for k in range(0, len(text), 64)], row["nodes"], row["levels"])


def log_of(made: Manifest) -> DataFrame:
    """The logs as rows: tree, position, level, index and digest of every node."""
    sizes = made.leaves.groupBy("tree").agg(F.first("count").alias("total"))

    def unfold(base: int):
        def run(table: pa.Table) -> pa.Table:
            row = table.to_pylist()[0]
            own, out = _run_of(row), []
            for level in range(1 if base else 0, row["levels"] + 1):  # a round's leaves are tops of the one below
                width = ARITY**level
                for k in range(-(-own.count // width)):
                    index = row["builder"] * (SPAN // width) + k
                    digest = own.log[position(level, k, own.count)].decode()
                    out.append((row["tree"], position(base + level, index, row["total"]), base + level, index, digest))
            return pa.table([pa.array(c, t) for c, t in zip(zip(*out), schema.types, strict=True)], schema=schema) if out else schema.empty_table()

        return run

    schema = pa.schema([("tree", pa.int64()), ("position", pa.int64()), ("level", pa.int32()), ("index", pa.int64()), ("digest", pa.string())])
    kind = "tree long, position long, level int, index long, digest string"
    rounds = [r.join(sizes, "tree").groupBy("tree", "builder").applyInArrow(unfold(k * RISE), kind) for k, r in enumerate(made.rounds)]
    out = rounds[0]
    for more in rounds[1:]:
        out = out.unionByName(more)
    return out


def root(made: Manifest) -> str | None:
    """The digest over all groups; none without rows."""
    found = made.upper.tops.first()
    return found["digest"] if found else None


def prove(made: Manifest, digest: str, changed: str | None = None) -> DataFrame:
    """Every leaf row with its proof, checked: ``proof_sha256``, ``folded_root``, ``subroot``, ``root`` and ``verified``.

    The proof of a leaf is its siblings, level by level to the root over all
    groups; ``proof_sha256`` is the digest of their joined hex digests.
    ``folded_root`` is recomputed from the digest in column ``changed`` where
    that is not null, else from the leaf, with the siblings the log holds.
    """
    over = _paths(made.upper, 0, _no_path(made))
    above = materialise(over.select(F.col("index").alias("tree"), "path"))
    runs = _runs(made, 0, above).select("tree", "builder", "nodes", "levels", "log", "path")
    columns = [c for c in made.leaves.columns if c not in ("tree", "index", "count")]
    given = made.leaves.withColumn("builder", F.floor(F.col("index") / SPAN))

    def check(leaves: pa.Table, run_rows: pa.Table) -> pa.Table:
        row = run_rows.to_pylist()[0]
        run = _run_of(row)
        upper = [(p["before"].encode(), p["after"].encode()) for p in row["path"]]
        rest: dict[int, tuple[bytes, list]] = {}  # by parent: what its leaves' proofs share
        proofs, folded = [], []
        own = leaves.column(changed if changed is not None else digest).to_pylist()
        for index, first, other in zip(leaves.column("index").to_pylist(), leaves.column(digest).to_pylist(), own, strict=True):
            k = index - row["builder"] * SPAN
            parent = k // ARITY
            if parent not in rest:
                higher = (run.path(k)[1:] if run.levels else []) + upper
                rest[parent] = b"".join(b + a for b, a in higher), higher
            shared, steps = rest[parent]
            steps = [*run.path(k)[:1], *steps] if run.levels else steps
            proofs.append(combined((b"".join(steps[0]) if run.levels else b"") + shared).decode())
            node = (first if other is None else other).encode()
            for before, after in steps:
                node = combined(before + node + after)
            folded.append(node.decode())
        kept = leaves.select(["tree", *columns])
        return kept.append_column("proof_sha256", pa.array(proofs, pa.string())).append_column("folded_root", pa.array(folded, pa.string()))

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.select("tree", *columns).schema)
    groups = given.groupBy("tree", "builder").cogroup(runs.groupBy("tree", "builder"))
    checked = groups.applyInArrow(check, f"{kind}, proof_sha256 string, folded_root string")
    subroots = made.groups.select("tree", "subroot")
    out = checked.join(subroots, "tree").withColumn("root", F.lit(root(made)).cast("string"))
    return out.select(*columns, "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _no_path(made: Manifest) -> DataFrame:
    """The path above the tree over all groups: empty."""
    return made.upper.tops.select("tree", F.array().cast(PATH).alias("path"))
