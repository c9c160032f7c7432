"""Near-duplicate documents by MinHash with tensored banding; every link is confirmed on full sets.

A document is the set of its distinct shingles of ``shingle`` consecutive words after lower-casing A-Z (its
whole word sequence where it has fewer words). Two documents are linked when the Jaccard similarity of their
sets is at least ``percent`` / 100.

Tensored banding: two collections of ``bands`` band keys of ``rows`` MinHashes each are computed per
document, and each of the ``bands`` squared tables is keyed by a pair, one key from either collection. So
2 * bands * rows hash functions serve bands^2 tables of 2 * rows functions each. A pair of similarity s shares
a table with probability (1 - (1 - s^rows)^bands)^2: 0.9996 at 0.8 with the defaults, over 0.99999 at 0.85.

Documents with equal sets are one class and enter the tables once. Within a table bucket no pairs are listed
wholesale: the members are first compared with one of them; buckets that then still hold several components
are settled between components only, in blocks that return one link per component met. So the components are
those of all confirmed links within buckets, while copies cost a few comparisons each and no pairs are listed.

Null and empty texts have empty sets, are linked with nothing and are kept. Rows with one doc_id and equal
text are one class, too; a null doc_id takes part, but never names a component unless all its ids are null.
Columns named like a result are replaced, others are kept. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlens.llm.components import connected_components
from depotlens.llm.kernels import Words, mix, seeds, split_words, text_chunks
from depotlens.llm.names import keeps_columns
from depotlens.session import materialize

RESULTS = ("n_shingles", "component_id", "kept")


class Shingles:
    """Distinct shingle hashes of text chunks."""

    def __init__(self, size: int):
        self.size, self.words = size, Words(lower=True)

    def sets(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes sorted within each text, hashes before each text)."""
        starts, ends, first = split_words(data, offsets)
        hashes = self.words.hashes(data, starts, ends)
        count = np.diff(first)
        n = np.where(count >= self.size, count - self.size + 1, (count > 0).astype(np.int64))
        doc = np.repeat(np.arange(len(n)), n)
        before = np.concatenate(([0], np.cumsum(n)))
        at = np.arange(len(doc)) - before[doc] + first[doc]
        wide = np.minimum(count[doc], self.size)
        keys = mix(self.words.runs.sums(hashes, at, at + wide) ^ wide.astype(np.uint64))
        order = np.lexsort((keys, doc))
        keys, doc = keys[order], doc[order]
        fresh = np.ones(len(keys), dtype=bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
        keys, doc = keys[fresh], doc[fresh]
        return keys, np.searchsorted(doc, np.arange(len(offsets)))


def text_key(column: str = "text"):
    """16 bytes that name a text; texts are joined by them instead of being shuffled."""
    return F.unhex(F.md5(F.coalesce(F.col(column), F.lit(""))))


def sign(docs: DataFrame, shingle: int, rows: int, bands: int) -> DataFrame:
    """Per document: set size, set fingerprint, and both collections of band keys; the text stays behind."""
    half = rows * bands
    schema = T._parse_datatype_string(
        "doc_id long, _text binary, n_shingles long, _print binary, _left array<long>, _right array<long>"
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, factors, salt = Shingles(shingle), seeds(2 * half, 11), seeds(2 * bands, 12)
        for batch in batches:
            for row, data, offsets in text_chunks(batch.column(2)):
                keys, first = shingles.sets(data, offsets)
                n, size = len(offsets) - 1, np.diff(first)
                some = np.flatnonzero(size)
                begin = first[some]
                bands_of = np.zeros((n, 2 * bands), dtype=np.uint64)
                prints = np.zeros((n, 2), dtype=np.uint64)
                if len(some):
                    for band in range(2 * bands):
                        key = np.full(len(some), salt[band])
                        for factor in factors[band * rows : (band + 1) * rows]:
                            # Multiplying permutes the 64-bit keys; the minimum looks at the high bits first.
                            key = mix(key ^ np.minimum.reduceat(keys * factor, begin))
                        bands_of[some, band] = key
                    total = np.add.reduceat(keys, begin)
                    prints[some, 0] = mix(total ^ size[some].astype(np.uint64))
                    prints[some, 1] = mix(np.bitwise_xor.reduceat(mix(keys ^ np.uint64(0x2545F4914F6CDD1D)), begin) + total)
                packed = prints.astype("<u8").tobytes()
                lists = lambda part: pa.FixedSizeListArray.from_arrays(
                    pa.array(np.ascontiguousarray(part).view(np.int64).ravel()), bands
                ).cast(pa.list_(pa.int64()))
                columns = [
                    *batch.slice(row, n).columns[:2],
                    pa.array(size),
                    pa.array([packed[16 * i : 16 * i + 16] for i in range(n)], pa.binary()),
                    lists(bands_of[:, :bands]),
                    lists(bands_of[:, bands:]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col("doc_id").cast("long"), text_key().alias("_text"), "text").mapInArrow(run, schema)


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, items): the full set of each text of (node, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(shingle)
        for batch in batches:
            for row, data, offsets in text_chunks(batch.column(1)):
                keys, first = shingles.sets(data, offsets)
                sets = pa.ListArray.from_arrays(first.astype(np.int32), pa.array(keys.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(offsets) - 1), sets], names=["node", "items"])

    return texts.select("node", "text").mapInArrow(run, "node long, items array<long>")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; (node, items) gives the sets."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    joined = pairs.join(left, "a").join(right, "b").withColumn("common", common)
    return joined.where(100 * F.col("common") >= percent * (F.size("x") + F.size("y") - F.col("common"))).select("a", "b")


@keeps_columns(("doc_id", "text"), RESULTS)
def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, rows: int = 3, bands: int = 12) -> DataFrame:
    """The documents with ``n_shingles``, ``component_id`` and ``kept``."""
    docs = docs.withColumn("text", F.col("text").cast("string"))
    signed = materialize(sign(docs, shingle, rows, bands), "signed")
    # Equal sets are one class: a node of the graph. One of its texts and its smallest doc_id stand for it.
    sets = signed.where("n_shingles > 0").groupBy("_print", F.col("n_shingles").alias("size"))
    one = F.min(F.struct("_text", "_left", "_right")).alias("one")
    classes = sets.agg(one, F.min("doc_id").alias("first")).select("_print", "size", "first", "one.*")
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    # Table keys: every pair of a left and a right band key. Only buckets with two members matter.
    left = classes.select("node", "_right", F.posexplode("_left").alias("i", "l"))
    both = left.select("node", "i", "l", F.posexplode("_right").alias("j", "r"))
    tables = both.select(F.xxhash64("i", "l", "j", "r").alias("key"), "node")
    shared = tables.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    # Spark sizes the exploded tables like the classes and would broadcast all of them up to some 100 MB of classes.
    members = tables.join(shared.hint("merge"), "key").join(classes.select("node", "size"), "node")
    members = materialize(members.withColumn("rank", F.xxhash64("node")), "members")

    # Full sets of the texts that share a bucket, each made once.
    met = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "_text")
    texts = docs.select(text_key().alias("_text"), "text").join(met, "_text").dropDuplicates(["node"])
    full = materialize(shingle_sets(texts, shingle), "sets")
    component = bucket_components(members, full, percent)
    named = classes.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(least, "component").select("_print", F.col("size").alias("n_shingles"), "component_id")
    found = signed.select("doc_id", "_text", "_print", "n_shingles").dropDuplicates(["doc_id", "_text"])
    found = found.join(named, ["_print", "n_shingles"], "left").select(
        F.col("doc_id").alias("_id"), F.col("_text").alias("_key"), "n_shingles", "component_id"
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_key"))
    out = docs.withColumn("_text", text_key()).join(found, same)
    smallest = F.coalesce("component_id", F.col("doc_id").cast("long"))
    kept = F.coalesce(F.col("doc_id").cast("long") == smallest, F.isnull(smallest))
    return out.select(*docs.columns, "n_shingles", smallest.alias("component_id"), kept.alias("kept"))


def bucket_components(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, component) over all confirmed links within buckets, without comparing what is connected already.

    ``members``: (key, node, size, members, rank). A sample of the buckets goes first, then all: in each, one
    member of every component is compared with one of the component that holds most of the bucket. Components
    that still meet in buckets with more than two members are settled by ``family_links``, which misses no link
    between them. So no link that connects anything is lost.
    """
    one = F.min(F.struct("rank", "node", "size")).alias("one")
    component = None
    for step in range(3):
        if component is None:
            # About one table in sixteen: a group of copies meets often enough to grow together cheaply.
            part = members.where(F.pmod("key", F.lit(16)) == 0).withColumn("comp", F.col("node"))
        else:
            part = members.join(component.withColumnRenamed("component", "comp"), "node", "left")
            part = part.withColumn("comp", F.coalesce("comp", "node"))
        shares = part.groupBy("key", "comp").agg(F.count("*").alias("n"), F.max("members").alias("members"), one)
        most = F.max_by(F.struct("one.*", "comp"), F.struct("n", "one.rank")).alias("most")
        lead = shares.groupBy("key").agg(F.count("*").alias("comps"), most)
        lead = lead.where("comps > 1").select("key", *(F.col(f"most.{c}").alias(f"l_{c}") for c in ("node", "size", "comp")))
        met = shares.where(F.col("members") > step).join(lead, "key").where("comp <> l_comp")
        met = materialize(met.select("comp", "one.node", "one.size", "l_node", "l_size", "l_comp"), "met")
        if component is not None and met.isEmpty():
            break
        if step < 2:
            near = met.where(_sizes_allow("size", "l_size", percent))
            pairs = near.select(F.least("node", "l_node").alias("a"), F.greatest("node", "l_node").alias("b")).distinct()
            links = confirm(pairs, sets, percent)
        else:
            family = connected_components(met.select(F.col("comp").alias("a"), F.col("l_comp").alias("b")))
            family = family.select(F.col("node").alias("comp"), F.col("component").alias("family"))
            nodes = part.select("node", "size", "comp").distinct().join(family, "comp")
            links = family_links(nodes, sets, percent)
        if component is not None:
            links = links.unionByName(component.select(F.col("component").alias("a"), F.col("node").alias("b")))
        component = connected_components(links)
    return component


def _sizes_allow(one: str, other: str, percent: int) -> Column:
    return 100 * F.least(one, other) >= percent * F.greatest(one, other)


def family_links(nodes: DataFrame, sets: DataFrame, percent: int, items: int = 1 << 18, most: int = 4096) -> DataFrame:
    """Links (a, b) across the components of each family, from (node, size, comp, family).

    A family is what meets in buckets, directly or over others. Nodes outside the family's largest component
    are compared with all of the family, block by block of about ``items`` shingles and about ``most`` nodes a side, and every node returns one
    linked partner per component it is linked to: no pairs are listed, and no task holds a family.
    """
    groups = nodes.groupBy("family", "comp").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    total = groups.groupBy("family").agg(F.sum("words").alias("all"), F.sum("n").alias("n_all"), F.max_by("comp", F.struct("n", "comp")).alias("most"))
    rest = groups.join(total, "family").where("comp <> most").groupBy("family", "all", "n_all", "most")
    rest = rest.agg(F.sum("words").alias("some"), F.sum("n").alias("n_some"))
    # Nodes are spread by hash: blocks are planned a tenth smaller.
    count = lambda words, n: F.ceil(F.greatest(F.col(words) / F.lit(items), F.col(n) / F.lit(0.9 * most))).cast("long")
    sizes = rest.select("family", "most", count("some", "n_some").alias("n_i"), count("all", "n_all").alias("n_j"))
    placed = nodes.join(sizes, "family").join(sets, "node")
    spread = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    body = ["family", "node", "comp", "items"]
    left = placed.where("comp <> most").select(*body, spread("n_i", 1).alias("i"), upto("n_j").alias("j"), F.lit(0).alias("side"))
    right = placed.select(*body, spread("n_j", 2).alias("j"), upto("n_i").alias("i"), F.lit(1).alias("side"))
    blocks = left.unionByName(right).groupBy("family", "i", "j")
    return blocks.applyInArrow(_compare_blocks(percent), "a long, b long")


def _compare_blocks(percent: int, width: int = 4096):
    def compare(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        node, comp = table.column("node").to_numpy(), table.column("comp").to_numpy()
        lists = table.column("items").combine_chunks()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        values = lists.flatten().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(side)), sizes)
        one, other = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        place = np.empty(len(side), dtype=np.int64)
        place[one], place[other] = np.arange(len(one)), np.arange(len(other))
        mine = side[owner] == 0
        both = np.intersect1d(values[mine], values[~mine])
        at = np.minimum(np.searchsorted(both, values), max(0, len(both) - 1))
        shared = both[at] == values if len(both) else np.zeros(len(values), dtype=bool)
        common = np.zeros((len(one), len(other)), dtype=np.float32)
        for low in range(0, len(both), width):
            inside = shared & (at >= low) & (at < low + width)
            x = np.zeros((len(one), width), dtype=np.float32)
            y = np.zeros((len(other), width), dtype=np.float32)
            pick = inside & mine
            x[place[owner[pick]], at[pick] - low] = 1
            pick = inside & ~mine
            y[place[owner[pick]], at[pick] - low] = 1
            common += x @ y.T
        common = common.astype(np.int64)
        union = sizes[one][:, None] + sizes[other][None, :] - common
        linked = (100 * common >= percent * union) & (comp[one][:, None] != comp[other][None, :])
        row, column = np.nonzero(linked)
        order = np.lexsort((node[other][column], comp[other][column], row))
        row, column = row[order], column[order]
        fresh = np.ones(len(row), dtype=bool)
        fresh[1:] = (row[1:] != row[:-1]) | (comp[other][column[1:]] != comp[other][column[:-1]])
        return pa.table({"a": node[one][row[fresh]], "b": node[other][column[fresh]]})

    return compare
