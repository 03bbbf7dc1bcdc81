"""Exact n-gram Jaccard join in size-banded tiles with hashed bitmap signatures.

1. Each document becomes the sorted array of its distinct shingle hashes, a
   bitmap (one bit per hash slot, flipped by every shingle there) and a count
   of shingles per slot of a fixed-size sketch. Documents of equal sets form a
   class; all later work is on classes.
2. In any order of the shingles, two sets that are similar enough share one
   among the first n - ceil(t n) + 1. The sketch puts common shingles last, so
   that passages many documents share rarely count among them. These shingles
   are the tiles; sizes inside are banded by powers of 1 / t.
   A pair is met in the tile of its first shared shingle or not at all: there
   the places of that shingle bound what the two can share.
3. Each tile's band is compared with its centre, the class that shares most of
   its own leading shingles. The links found give components, and all pairs in
   a tile whose classes are still in different components are compared next.
   Where every link is asked for, all pairs in a tile are compared instead,
   block by block.
4. A pair is compared by its bitmaps first: the number of differing bits is at
   most the size of the sets' difference, which bounds the overlap from above.
   Only pairs that pass are intersected exactly, as sorted arrays, in tasks
   that hold the arrays of one group of probable copies at a time.

Nothing is sampled or capped: a pair is left out only when it cannot be a link
or, where components alone are asked for, when both classes are known to be in
one component.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from crystalflow.llm.components import components
from crystalflow.llm.helpers import chunks, id_and_text, mixed, window_hashes, word_hashes
from crystalflow.operators.scratch import materialise

WIDTH = 5
PERCENT = 80
SKETCH_BITS = 20
SKETCH_PIECES = 64
TILE_ROWS = 50_000  # a shingle counted more often than this is dealt over several tasks
GROUP_ROWS = 2_000
BLOCK_ROWS = 1_000
FILTER_BITS = 24


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words; of the whole sequence if there are fewer."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return mixed(window_hashes(word_hashes(words), len(words)) + np.uint64(len(words)))
    return np.unique(window_hashes(word_hashes(words), width))


def bitmap(values: np.ndarray) -> bytes:
    """A power of two of bits, at least as many as values; a bit is the parity of the values in its slot."""
    bits = max(64, 1 << int(len(values) - 1).bit_length()) if len(values) else 64
    odd = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def most_overlap(a: bytes, b: bytes, n_a: int, n_b: int) -> int:
    """No less than the two sets' overlap: each bit that differs stands for a value in one set only."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):  # parity bitmaps fold: both halves share their slots in the smaller one
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return (n_a + n_b - int(np.bitwise_count(x ^ y).sum())) // 2


def set_name(values: bytes) -> int:
    """A signed 64-bit hash of a whole set."""
    return xxhash.xxh3_64_intdigest(values) - (1 << 63)


def is_link(overlap: int, n_a: int, n_b: int, percent: int) -> bool:
    return 100 * overlap >= percent * (n_a + n_b - overlap)


def leading(n: int, percent: int) -> int:
    """How many shingles of a set of ``n`` are tiles."""
    return n - (percent * n + 99) // 100 + 1 if n else 0


@dataclass(frozen=True)
class Links:
    """``documents``: id, n_shingles, set_id (null for empty sets); ``links``: a, b, pairs of set ids; ``roots``: set_id, root."""

    documents: DataFrame
    links: DataFrame
    roots: DataFrame


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """Per document its id, n_shingles, set_id and bitmap; and per task the pieces of its sketch, with null ids."""
    schema = f"id {docs.schema['id'].dataType.simpleString()}, n_shingles long, set_id long, bits binary, piece int, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, kind = np.zeros(1 << SKETCH_BITS, np.int64), None
        for batch in chunks(batches):
            kind = batch.column("id").type
            sizes, names, bits = [], [], []
            for text in batch.column("text").to_pylist():
                values = shingles(text, width)
                np.add.at(sketch, (values >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
                sizes.append(len(values))
                names.append(set_name(values.tobytes()) if len(values) else None)
                bits.append(bitmap(values) if len(values) else None)
            nothing = pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), pa.array(bits, pa.binary()), *nothing],
                names=["id", "n_shingles", "set_id", "bits", "piece", "counts"],
            )
        if kind is not None:
            parts = [(k, zlib.compress(p.tobytes(), 1)) for k, p in enumerate(np.split(sketch, SKETCH_PIECES)) if p.any()]
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(len(parts), t) for t in (kind, pa.int64(), pa.int64(), pa.binary())), pa.array([k for k, _ in parts], pa.int32()), pa.array([c for _, c in parts], pa.binary())],
                names=["id", "n_shingles", "set_id", "bits", "piece", "counts"],
            )

    return docs.mapInArrow(run, schema)


def _sketch(sets: DataFrame) -> np.ndarray:
    """The tasks' sketches in one: 2^20 counts, whatever the input."""

    def add(part: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), np.int64) for c in part["counts"])
        return pd.DataFrame({"piece": part["piece"].iloc[:1], "counts": [zlib.compress(total.tobytes(), 1)]})

    schema = "piece int, counts binary"
    given = sets.where("counts IS NOT NULL").select("piece", "counts")
    # in two steps, so that no task gets a piece of every other task
    some = given.withColumn("some", F.pmod(F.xxhash64("counts"), F.lit(16)))
    summed = some.groupBy("piece", "some").applyInPandas(add, schema).groupBy("piece").applyInPandas(add, schema)
    out = np.zeros((SKETCH_PIECES, (1 << SKETCH_BITS) // SKETCH_PIECES), np.int64)
    for piece, counts in summed.collect():  # 64 pieces
        out[piece] = np.frombuffer(zlib.decompress(counts), np.int64)
    return out.reshape(-1)


def _tiles(docs: DataFrame, sketch: np.ndarray, width: int, percent: int) -> DataFrame:
    """Rows (shingle, salt, set_id, n, place) for the leading shingles of every set, once per task.

    ``place`` counts a set's shingles from 0 in the common order.

    ``salt`` is 0 but for very common shingles, whose sets are dealt over 1, 2, ...
    """
    common = sketch.astype(np.uint32 if sketch.max(initial=0) < 2**32 else np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in chunks(batches):
            keys, salts, names, sizes, places = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                values = shingles(text, width)
                name = set_name(values.tobytes())
                if len(values) == 0 or name in seen:
                    continue
                seen.add(name)
                counts = common[(values >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                first = np.lexsort((values, counts))[: leading(len(values), percent)]
                keys.append(values[first].view(np.int64))
                parts = 1 + counts[first].astype(np.int64) // TILE_ROWS
                salts.append(np.where(parts > 1, 1 + name % parts, 0))
                names.append(np.full(len(first), name, np.int64))
                sizes.append(np.full(len(first), len(values), np.int32))
                places.append(np.arange(len(first), dtype=np.int32))
            if keys:
                columns = [pa.array(np.concatenate(c)) for c in (keys, salts, names, sizes, places)]
                yield pa.RecordBatch.from_arrays(
                    [columns[0], columns[1].cast(pa.int64()), *columns[2:]], names=["shingle", "salt", "set_id", "n", "place"]
                )

    return docs.select("text").mapInArrow(run, "shingle long, salt long, set_id long, n int, place int")


def _band(percent: int) -> Column:
    """Sizes that may be linked lie in one band or in neighbouring ones."""
    return F.floor(F.log(F.col("n")) / F.lit(math.log(100 / percent))).cast("int")


def _similar_size(a: str, b: str, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _can_overlap(a: str, b: str, percent: int) -> Column:
    """Whether two sets can be linked if this tile holds the first shingle they share.

    What they can share then lies from here on, in both. A link is found in the
    tile of its first shared shingle, so pairs that fail are left to other tiles.
    """
    left = F.least(F.col(f"n{a}") - F.col(f"place{a}"), F.col(f"n{b}") - F.col(f"place{b}"))
    return left * (100 + percent) >= (F.col(f"n{a}") + F.col(f"n{b}")) * percent


def _shared_tiles(rows: DataFrame, percent: int) -> DataFrame:
    """The rows of tiles that hold at least two sets, each set once per tile, with their band."""
    banded = rows.withColumn("band", _band(percent)).repartition("shingle", "salt")
    order = Window.partitionBy("shingle", "salt", "band").orderBy("set_id")
    once = banded.withColumn("previous", F.lag("set_id").over(order)).where("previous IS NULL OR previous <> set_id")
    counted = once.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy("shingle", "salt")))
    # a shingle dealt over several tasks is common, and counts as shared
    return counted.where("held > 1 OR salt > 0").select("shingle", "salt", "band", "set_id", "n", "place")


def _central_pairs(tiles: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of each tile's band centre with all others in it that it can be linked with."""
    shared = tiles.groupBy("set_id").agg((F.count(F.lit(1)) / F.max("n")).alias("share"))
    rated = tiles.join(shared, "set_id")
    best = F.max(F.struct("share", "set_id", "n", "place")).over(Window.partitionBy("shingle", "salt", "band"))
    centred = rated.withColumn("centre", best).select(
        "set_id", "n", "place", *[F.col(f"centre.{c}").alias(f"{c}_c") for c in ("set_id", "n", "place")]
    )
    met = centred.where((F.col("set_id") != F.col("set_id_c")) & _can_overlap("", "_c", percent))
    return met.select(F.least("set_id", "set_id_c").alias("a"), F.greatest("set_id", "set_id_c").alias("b")).distinct()


def _other_pairs(tiles: DataFrame, roots: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """Pairs that share a tile, may be similar by size, lie in different components and were not tried.

    As in ``_all_pairs``, a task meets two blocks of a tile's band at a time.
    """
    named = tiles.drop("salt").join(roots.select("set_id", "root"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    named = materialise(named)
    mixed_tiles = named.groupBy("shingle").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("parts")
    ).where("low <> high")
    left = materialise(named.join(materialise(mixed_tiles.select("shingle", "parts")), "shingle"))
    per_root = left.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("rows"))
    major = materialise(per_root.groupBy("shingle").agg(F.max(F.struct("rows", "root"))["root"].alias("major")))
    marked = left.join(major, "shingle")
    block, blocks = F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int"), F.sequence(F.lit(0), F.col("parts") - 1)
    minor = marked.where("root <> major").select(
        "shingle", "band", block.alias("block_x"), F.explode(blocks).alias("block_y"),
        F.col("set_id").alias("x"), F.col("n").alias("n_x"), F.col("place").alias("place_x"), F.col("root").alias("root_x"),
    )
    minor = minor.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    others = marked.select(
        "shingle", "band", "major", F.explode(blocks).alias("block_x"), block.alias("block_y"),
        *[F.col(c).alias(f"{to}_y" if to else "y") for c, to in (("set_id", ""), ("n", "n"), ("place", "place"), ("root", "root"))],
    )
    once = (F.col("root_y") == F.col("major")) | (F.col("x") < F.col("y"))
    met = minor.join(others, ["shingle", "band", "block_x", "block_y"])
    met = met.where((F.col("root_x") != F.col("root_y")) & once & _can_overlap("_x", "_y", percent))
    pairs = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    return pairs.join(tried, ["a", "b"], "left_anti")


def _all_pairs(tiles: DataFrame, percent: int) -> DataFrame:
    """All pairs that share a tile and may be links if it is their first; a task meets two blocks of a tile's band at a time."""
    sizes = tiles.groupBy("shingle").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("parts"))
    large = materialise(sizes.where("parts > 1"))
    # written, so that Spark can split a shingle that many sets lead with
    cut = materialise(tiles.join(large, "shingle", "left").withColumn("parts", F.coalesce("parts", F.lit(1))))
    block, blocks = F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int"), F.sequence(F.lit(0), F.col("parts") - 1)
    x = cut.select(
        "shingle", block.alias("block_x"), F.explode(blocks).alias("block_y"), F.col("band").alias("band_x"),
        F.col("set_id").alias("x"), F.col("n").alias("n_x"), F.col("place").alias("place_x"),
    ).select("*", F.explode(F.array("band_x", F.col("band_x") + 1)).alias("band"))
    y = cut.select(
        "shingle", F.explode(blocks).alias("block_x"), block.alias("block_y"), "band",
        F.col("set_id").alias("y"), F.col("n").alias("n_y"), F.col("place").alias("place_y"),
    )
    once = (F.col("band_x") < F.col("band")) | (F.col("x") < F.col("y"))
    met = x.join(y, ["shingle", "band", "block_x", "block_y"])
    met = met.where(once & _similar_size("n_x", "n_y", percent) & _can_overlap("_x", "_y", percent))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _passing(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps allow a link."""
    sides = [classes.select(F.col("set_id").alias(s), F.col("n").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}")) for s in "ab"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                is_link(min(most_overlap(r["bits_a"], r["bits_b"], r["n_a"], r["n_b"]), r["n_a"], r["n_b"]), r["n_a"], r["n_b"], percent)
                for r in batch.select(["n_a", "bits_a", "n_b", "bits_b"]).to_pylist()
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(sides[0], "a").join(sides[1], "b").where(_similar_size("n_a", "n_b", percent))
    return joined.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInArrow(run, "a long, b long")


def _groups(named: DataFrame, rows: int | None = None) -> DataFrame:
    """Pairs (a, b, root) as a, b and the group that compares them, of about ``rows`` pairs at most.

    The pairs of a component are dealt by ``b``. A set that is the ``b`` of more
    pairs than a group holds, as the centre of a star is, has groups of its own,
    dealt by ``a``.
    """
    rows = rows or GROUP_ROWS
    parts = F.ceil(F.count(F.lit(1)) / rows)
    sizes = materialise(named.groupBy("root").agg(parts.alias("parts")).where("parts > 1"))
    hubs = materialise(named.groupBy("b").agg(parts.alias("cuts")).where("cuts > 1"))  # at most one for every ``rows`` pairs
    sized = named.join(sizes, "root", "left").join(hubs, "b", "left")
    dealt = F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1)))
    cut = F.pmod(F.xxhash64("a"), F.col("cuts"))
    group = F.when(F.col("cuts").isNull(), F.xxhash64("root", dealt)).otherwise(F.xxhash64("root", F.lit("hub"), "b", cut))
    return sized.select("a", "b", group.alias("group"))


def _exact(pairs: DataFrame, docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs that are links, by intersection of their sorted arrays.

    Pairs are grouped by the component of the probable links they lie in, a
    large component in several groups and so is a set with many partners; a
    group gets each array it needs once.
    """
    roots = materialise(components(pairs))
    named = pairs.join(roots.withColumnRenamed("node", "b"), "b", "left").withColumn("root", F.coalesce("root", "b"))
    grouped = materialise(_groups(named))
    needed = materialise(grouped.select("group", F.explode(F.array("a", "b")).alias("set_id")).distinct())
    arrays = materialise(_arrays(docs, needed.select("set_id").distinct().join(classes.select("set_id", "first"), "set_id"), width))
    fetched = needed.join(arrays, "set_id").select(F.col("group").alias("of"), "set_id", "data")

    def run(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        sets = {name: np.frombuffer(data, np.uint64) for name, data in zip(held["set_id"], held["data"], strict=True)}
        keep = []
        for a, b in zip(asked["a"], asked["b"], strict=True):
            x, y = sets[a], sets[b]
            keep.append(is_link(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent))
        return asked.loc[np.array(keep, bool), ["a", "b"]]

    return grouped.groupBy("group").cogroup(fetched.groupBy("of")).applyInPandas(run, "a long, b long")


def _likely(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The documents whose id may be among ``wanted``: one bit for each of 2^24 slots of the ids' hash, 2 MB in all.

    Spares most texts the way to the join that decides. With very many wanted
    ids it lets all documents pass.
    """
    slot = F.pmod(F.xxhash64("id"), F.lit(1 << FILTER_BITS)).cast("long")
    piece, bit = F.bitmap_bucket_number(slot).alias("piece"), F.bitmap_bit_position(slot)
    bits = wanted.groupBy(piece).agg(F.bitmap_construct_agg(bit).alias("marks"))  # at most 512 rows of 4 kB
    placed = docs.withColumns({"piece": piece, "bit": bit})
    byte = F.conv(F.hex(F.substring("marks", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.floor(byte / F.pow(F.lit(2), F.col("bit") % 8)) % 2 == 1
    return placed.join(F.broadcast(bits), "piece").where(marked).select(*docs.columns)


def _arrays(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(set_id, data) of the sets in ``wanted`` (set_id, first), each from the text of one document."""
    wanted = materialise(wanted.select("set_id", F.col("first").alias("id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            names = batch.column("set_id").to_pylist()
            data = [shingles(t, width).tobytes() for t in batch.column("text").to_pylist()]
            # of rows that repeat an id, those with the set asked for
            kept = [(n, d) for n, d in zip(names, data, strict=True) if d and set_name(d) == n]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in kept], pa.int64()), pa.array([d for _, d in kept], pa.binary())], names=["set_id", "data"]
            )

    return _likely(docs, wanted).join(wanted, "id").select("set_id", "text").mapInArrow(run, "set_id long, data binary")


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT, every_link: bool = True) -> Links:
    """All documents' shingle sets, the links between different sets, and their components.

    Two sets are linked when 100 * overlap >= ``percent`` * union. ``links`` has
    all of them, a number that grows with the square of a group of similar sets.
    Without ``every_link`` it has enough of them to connect every component:
    pairs that an earlier link already connects are not compared. Null ids are left out. A null text
    counts as empty. Of rows that repeat an id with different texts, each
    counts as a document.
    """
    docs = id_and_text(docs, id_col, text_col).where("id IS NOT NULL")
    sets = materialise(_sets(docs, width))
    documents = sets.where("counts IS NULL").select("id", "n_shingles", "set_id")
    classes = materialise(
        sets.where("set_id IS NOT NULL").groupBy("set_id")
        .agg(F.min("n_shingles").alias("n"), F.min("id").alias("first"), F.min("bits").alias("bits"))
    )
    tiles = materialise(_shared_tiles(_tiles(docs, _sketch(sets), width, percent), percent))
    tried = materialise(_all_pairs(tiles, percent) if every_link else _central_pairs(tiles, percent))
    links = materialise(_exact(materialise(_passing(tried, classes, percent)), docs, classes, width, percent))
    if not every_link:
        roots = components(links).select(F.col("node").alias("set_id"), "root")
        more = materialise(_passing(_other_pairs(tiles, roots, tried, percent), classes, percent))
        links = materialise(links.unionByName(_exact(more, docs, classes, width, percent)))
    roots = materialise(components(links).select(F.col("node").alias("set_id"), "root"))
    return Links(documents, links, roots)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT, count_links: bool = True) -> DataFrame:
    """Per row with an id: the id column, n_shingles, component_id and, with ``count_links``, n_links.

    ``component_id`` is the smallest id in reach over links, the row's own
    included; documents of equal sets are linked. ``n_links`` counts all links
    between the row's set and others: the different sets similar to it, not
    their copies. Without it pairs that are known to be in one component are
    not compared, which spares the square of a group of similar texts. A text without words is linked with
    nothing. No rows give no rows.
    """
    found = similar_sets(docs, id_col, text_col, width, percent, every_link=count_links)
    firsts = found.documents.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("id").alias("first"))
    rooted = firsts.join(found.roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(lowest, "root").select("set_id", "component_id")
    if count_links:
        ends = found.links.select(F.explode(F.array("a", "b")).alias("set_id")).groupBy("set_id").agg(F.count(F.lit(1)).alias("n_links"))
        named = named.join(ends, "set_id", "left")
    # written, so that a set in a third of the documents can be split by Spark
    out = found.documents.join(materialise(named), "set_id", "left")
    counted = [F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")] if count_links else []
    return out.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id"), *counted)
