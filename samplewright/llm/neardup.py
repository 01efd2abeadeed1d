"""Near-duplicates by one-permutation MinHash, banded buckets and star-shaped edges.

1. Each text becomes a set of shingle hashes. One permutation cuts the hash range into
   bins; a bin's least hash is one MinHash. An empty bin takes the value of the first
   filled bin in its own random order (optimal densification). Rows of bins are hashed
   to buckets.
2. Equal sets are one node. In a bucket of up to `turns` nodes, each node in turn is a
   star's centre for those after it, so that no pair of it is missed. In a larger one
   only the node that comes first in an order of all nodes is: n - 1 candidates.
3. Candidates are confirmed on the full sets. Connected components follow.
4. A single star may miss a link between two of its rays. So the nodes of larger buckets
   that still hold several components go on: blobs of such buckets get one centre each, and
   what a node has apart from the centre takes the place of its set. Two nodes that are
   linked, but not both with the centre, share elements of that; so they share one of the
   few rarest (a prefix filter), by which they meet. This loses no pair, and the common part
   of a large group, in which all meet all, has gone from it.

A pair of similarity 0.8 shares none of the 40 buckets of 6 rows with a chance of 5e-6; pairs
that share one are all found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplewright.llm.arrow import as_bytes, pieces
from samplewright.llm.shared import join_hot, written
from samplewright.llm.words import Piece, mixed

_U = np.uint64
#: Nodes of a blob, about, that its elements are counted in for their order.
SAMPLE = 32


@dataclass(frozen=True)
class Near:
    """Words of a shingle, similarity in per cent, and how buckets are made.

    bands: buckets of a text; rows: bins of a bucket. turns: the largest bucket whose pairs
    are all compared.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 6
    turns: int = 16


def text_sets(piece: Piece, shingle: int) -> list[np.ndarray]:
    """For each text its shingle hashes, sorted and distinct; fewer words are one shingle, none are none."""
    runs, at = piece.shingles(shingle)
    edges = np.searchsorted(piece.doc[at], np.arange(piece.n + 1))
    sets = []
    for k in range(piece.n):
        own = runs[edges[k] : edges[k + 1]]
        if not own.size and piece.words[k]:
            total = np.zeros(1, _U)
            for h in piece.hashes[piece.first[k] : piece.first[k + 1]]:
                total = total * _U(0xC2B2AE3D27D4EB4F) + h
            own = mixed(total)
        own = np.sort(own)
        sets.append(own[np.concatenate(([True], own[1:] != own[:-1]))] if own.size else own)
    return sets


class Bands:
    """Bucket keys of sorted sets."""

    def __init__(self, near: Near) -> None:
        self.bins, self.rows, self.each = near.bands * near.rows, near.rows, near.bands
        # row j: the order in which bin j, if it is empty, looks at the others
        self.order = np.random.default_rng(7).random((self.bins, self.bins)).argsort(axis=1)
        self.salt = mixed(np.arange(1, near.bands + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))

    def _mins(self, own: np.ndarray) -> np.ndarray:
        """One value for each bin; `own` is sorted, so the first hash of a bin is its least."""
        bins = ((own >> _U(32)) * _U(self.bins) >> _U(32)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
        values, filled = np.empty(self.bins, _U), np.zeros(self.bins, bool)
        values[bins[first]] = own[first]
        filled[bins[first]] = True
        holes, look = np.flatnonzero(~filled), 0
        while holes.size:
            at = self.order[holes, look]
            found = filled[at]
            values[holes[found]] = values[at[found]]
            holes, look = holes[~found], look + 1
        return values

    def keys(self, own: np.ndarray) -> np.ndarray:
        key, values = self.salt, self._mins(own).reshape(self.each, self.rows)
        for row in range(self.rows):
            key = mixed(key * _U(0xD6E8FEB86659FD93) + values[:, row])
        return key


def _texts_of(piece: pa.RecordBatch) -> Piece:
    return Piece([x or b"" for x in as_bytes(piece.column("text"))], fold=True)


def _node(own: np.ndarray) -> bytes | None:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest() if own.size else None


def signatures(docs: DataFrame, near: Near, key: str, text: str) -> DataFrame:
    """key, text_hash, node (128 bits of the set; null for an empty set), n_shingles, buckets, of each document."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(near)
        for piece in pieces(batches, "text"):
            sets = text_sets(_texts_of(piece), near.shingle)
            buckets = [bands.keys(s).view(np.int64) if s.size else None for s in sets]
            columns = [pa.array([_node(s) for s in sets], pa.binary()), pa.array([s.size for s in sets], pa.int64()), pa.array(buckets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([piece.column("key"), piece.column("text_hash"), *columns], names=["key", "text_hash", "node", "n_shingles", "buckets"])

    slim = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    return slim.mapInArrow(signed, f"key {slim.schema['key'].dataType.simpleString()}, text_hash long, node binary, n_shingles long, buckets array<long>")


def sets_of(docs: DataFrame, wanted: DataFrame, near: Near, key: str, text: str) -> DataFrame:
    """node and its whole set, for the nodes of `wanted` (node, key, text_hash), made again from one text of each."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            sets = text_sets(_texts_of(piece), near.shingle)
            yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "set"])

    one = wanted.select(F.col("key").alias("_key"), F.col("text_hash").alias("_hash"))
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("_text_hash"))
    texts = texts.join(one, F.col("key").eqNullSafe(F.col("_key")) & (F.col("_text_hash") == F.col("_hash")), "left_semi")
    sets = texts.select("text").mapInArrow(made, "node binary, set array<long>")
    # a repeated row gives its set again
    return sets.groupBy("node").agg(F.first("set").alias("set"))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """`pairs` (a, b, ...) with `common` and `whole`: sizes of the sets' intersection and union."""
    left, right = (sets.select(F.col("node").alias(c), F.col("set").alias(f"_{c}")) for c in "ab")
    common = F.size(F.array_intersect("_a", "_b")).cast("long")
    joined = pairs.join(left, "a").join(right, "b").withColumn("common", common)
    return joined.withColumn("whole", F.size("_a") + F.size("_b") - F.col("common")).drop("_a", "_b")


def components(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """node and label (the least node reachable) of each node that has a link (a, b).

    Each round takes the least label of the neighbours and then the label's own label;
    the tables between rounds are written to the shared folder.
    """
    both = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_b")).select("node", F.least("node", "_b").alias("label")), "labels")
    for _ in range(most_rounds):
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("_old"), F.least("label", "_near").alias("_new"))
        jump = labels.select(F.col("node").alias("_new"), F.col("label").alias("_far"))
        step = written(lower.join(jump, "_new", "left").select("node", F.least("_new", F.coalesce("_far", "_new")).alias("label"), "_old"), "labels")
        labels = step.select("node", "label")
        if step.where("label <> _old").limit(1).count() == 0:
            return labels
    raise RuntimeError(f"components have not settled in {most_rounds} rounds")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """`rows` (node, ...) with `label`: that of the node's component, or the node itself."""
    if labels is None:
        return rows.withColumn("label", F.col("node"))
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """`labels` after further links (a, b): components of the components."""
    ends = _labelled(_labelled(links.withColumnRenamed("a", "node"), labels).select(F.col("label").alias("a"), F.col("b").alias("node")), labels)
    above = components(ends.select("a", F.col("label").alias("b"))).select(F.col("node").alias("label"), F.col("label").alias("_above"))
    nodes = labels.select("node").union(links.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
    return written(_labelled(nodes, labels).join(above, "label", "left").select("node", F.coalesce("_above", "label").alias("label")), "merged")


def crowded(rows: DataFrame, turns: int) -> DataFrame:
    """The rows (node, label, bucket) of buckets that hold nodes of several components, with `size` and `centre`.

    centre (node, label): of buckets of more than `turns` nodes, the first in one order of
    all nodes, so that buckets share centres and their pairs.
    """
    first = F.min(F.struct(F.xxhash64("node", F.lit(0)).alias("order"), "node", "label")).alias("_c")
    sized = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("_low"), F.max("label").alias("_high"), first)
    sized = sized.where("_low <> _high").select("bucket", "size", F.when(F.col("size") > turns, F.struct("_c.node", "_c.label")).alias("centre"))
    return written(rows.join(sized, "bucket"), "buckets")


def candidates(rows: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of different components, from the rows of `crowded`."""
    small = rows.where("centre is null").groupBy("bucket").agg(F.collect_list(F.struct("node", "label")).alias("all"))
    # `turns` entries at most
    rays = lambda x: F.transform(F.filter("all", lambda y: (y["node"] > x["node"]) & (y["label"] != x["label"])), lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b")))
    by_turns = small.select(F.explode(F.flatten(F.transform("all", rays))).alias("p")).select("p.*")
    stars = rows.where("centre is not null and label <> centre.label")
    return by_turns.union(stars.select(F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b"))).distinct()


def blobs_of(rows: DataFrame, labels: DataFrame) -> DataFrame | None:
    """node, label, blob and degree, for the nodes that may still lack a link; None if there are none.

    Those are nodes of large buckets of `rows` that hold several components. Components
    that meet in such buckets, directly or by others, are one blob, so that two nodes of
    one bucket are always in one blob. degree: a node's large buckets. A component counts
    once in a bucket, whatever its nodes.
    """
    # a node's list holds one bucket of each band at most
    held = rows.where("centre is not null").groupBy("node").agg(F.collect_list("bucket").alias("buckets"))
    large = written(_labelled(held, labels), "large")
    parts = written(large.select("label", F.explode("buckets").alias("bucket")).distinct(), "parts")
    shared = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n"), F.min("label").alias("b")).where("_n > 1").select("bucket", "b")
    meet = written(parts.join(shared, "bucket").where("label <> b").select(F.col("label").alias("a"), "b").distinct(), "meet")
    if meet.limit(1).count() == 0:
        return None
    blobs = components(meet).select(F.col("node").alias("label"), F.col("label").alias("blob"))
    return large.join(blobs, "label").select("node", "label", "blob", F.size("buckets").alias("degree"))


def differences(members: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """How each node of a blob differs from its blob's centre, the node of most large buckets.

    node, label, blob, centre, size (of the set), differ (elements of just one of the node
    and the centre), linked (with the centre), tokens: the first of those elements, as many
    as `short` (if its links end outside the centre's component) or all (if one may end there).
    Elements are in one order for each blob, rare ones first. The order needs no exactness,
    so that frequencies come from a sample of about SAMPLE nodes of each blob.
    """
    k, whole = 100 - near.percent, 100 + near.percent

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, differ, linked, short, tokens = [], [], [], [], []
            for own, centre, seen, times, n in zip(*(batch.column(c) for c in ("set", "_centre", "_seen", "_times", "_n")), strict=True):
                own, centre, seen, times = (np.asarray(x.values) for x in (own, centre, seen, times))
                apart = np.setxor1d(own, centre, assume_unique=True)
                at = np.minimum(np.searchsorted(seen, apart), max(seen.size - 1, 0))
                often = np.where(seen[at] == apart, times[at], 0) if seen.size else np.zeros(apart.size, np.int64)
                inside = np.isin(apart, centre, assume_unique=True)
                # of an element of the centre the nodes that lack it count
                order = np.lexsort((mixed(apart.view(_U)), inside, np.where(inside, n.as_py() - often, often)))
                d, most = apart.size, own.size * k // near.percent + 1
                size.append(own.size)
                differ.append(d)
                linked.append(whole * d <= k * (own.size + centre.size))
                short.append(d - max(0, (whole * d + k * (centre.size - own.size)) // (2 * whole)))
                tokens.append(apart[order[:most]])
            made = [pa.array(size, pa.int64()), pa.array(differ, pa.int64()), pa.array(linked, pa.bool_()), pa.array(short, pa.int64()), pa.array(tokens, pa.list_(pa.int64()))]
            names = ["node", "label", "blob", "centre"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *made], names=[*names, "size", "differ", "linked", "short", "tokens"])

    members = written(members.join(sets, "node"), "members")
    centres = members.groupBy("blob").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("degree", F.xxhash64("node").alias("_h"), "node")).alias("_c")).select("blob", "n", F.col("_c.node").alias("node"))
    centres = written(centres.join(sets, "node").select("blob", "n", F.col("node").alias("centre"), F.array_sort("set").alias("_centre")), "centres")
    sample = written(join_hot(members, centres.select("blob", "n", F.col("n").alias("_of")), ["blob"], "n").where(F.expr(f"pmod(xxhash64(node), greatest(1, _of div {SAMPLE})) = 0")).select("blob", "set"), "sample")
    often = sample.select("blob", F.explode("set").alias("token")).groupBy("blob", "token").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    often = often.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("token", "times"))).alias("_often")).select("blob", F.col("_often.token").alias("_seen"), F.col("_often.times").alias("_times"))
    taken = sample.groupBy("blob").agg(F.count(F.lit(1)).alias("_n"))
    none = F.array().cast("array<long>")
    centres = centres.join(often, "blob", "left").join(taken, "blob", "left")
    centres = centres.withColumns({"_seen": F.coalesce("_seen", none), "_times": F.coalesce("_times", none), "_n": F.coalesce("_n", F.lit(0))})
    pairs = join_hot(members, written(centres, "orders"), ["blob"], "n")
    kinds = "node binary, label binary, blob binary, centre binary, size long, differ long, linked boolean, short long, tokens array<long>"
    return written(pairs.select("node", "label", "blob", "centre", "set", "_centre", "_seen", "_times", "_n").mapInArrow(compared, kinds), "differences")


def across(nodes: DataFrame, near: Near) -> DataFrame:
    """Pairs (a, b), a < b, of different components that hold every link of a blob but those with its centre.

    nodes: the rows of `differences`. Let X and Y be two sets' differences from the centre.
    The sets differ from each other by |X| + |Y| - 2 |X and Y|; a link lets them differ by
    `k` of the sum of their sizes at most. So X and Y of a link share that many elements:
    one at least, unless both are linked with the centre, and so many that one of the first
    few of X is among the first few of Y.
    """
    k, whole = 100 - near.percent, 100 + near.percent
    home = nodes.where("linked").select("blob", "label").distinct().withColumn("home", F.lit(True))
    at_home = nodes.join(home, ["blob", "label"], "left").withColumn("home", F.coalesce("home", F.lit(False)))
    first = F.when(F.col("home"), F.slice("tokens", 1, F.col("short").cast("int"))).otherwise(F.col("tokens"))
    rows = at_home.select("node", "label", "blob", "home", "size", "differ", "short", F.posexplode(first).alias("at", "token"))
    rows = written(rows.select("node", "label", "blob", "token", "home", "size", F.expr("at < short").alias("early"), "differ", F.expr("differ - at").alias("left")), "tokens")
    use = rows.groupBy("blob", "token").agg(F.count_if("home").alias("_home"), F.count_if(~F.col("home")).alias("_away"), F.count_if(~F.col("home") & F.col("early")).alias("_early"))
    use = use.where("_home > 0 and _away > 0 or _early > 1").select("blob", "token")
    rows = written(rows.join(use, ["blob", "token"], "left_semi"), "tokens")
    one, other = (rows.select("blob", "token", *(F.col(c).alias(f"{side}_{c}") for c in ("node", "label", "home", "size", "early", "differ", "left"))) for side in "ab")
    on = F.expr(
        f"""a_node < b_node and a_label <> b_label and not (a_home and b_home) and (a_home or b_home or a_early and b_early)
        and 100 * a_size >= {near.percent} * b_size and 100 * b_size >= {near.percent} * a_size
        and {2 * whole} * least(a_left, b_left) >= {whole} * (a_differ + b_differ) - {k} * (a_size + b_size)"""
    )
    met = one.join(other.withColumnsRenamed({"blob": "_blob", "token": "_token"}), (F.col("blob") == F.col("_blob")) & (F.col("token") == F.col("_token")) & on)
    return met.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()


def _linked(judged: DataFrame, percent: int) -> DataFrame:
    return judged.where(F.col("common") * 100 >= F.col("whole") * percent).select("a", "b")


def _grouped(docs: DataFrame, near: Near, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The documents' signatures, and for each node its label and first document (key, text_hash)."""
    signed = written(signatures(docs, near, key, text), "signatures")
    best = F.min(F.struct(F.col("key").isNull().alias("_null"), F.col("key"), F.col("text_hash"))).alias("_k")
    nodes = signed.where("node is not null").groupBy("node").agg(best, F.first("buckets").alias("buckets"))
    nodes = written(nodes.select("node", "_k.key", "_k.text_hash", "buckets"), "nodes")

    rows = crowded(_labelled(nodes.select("node", F.explode("buckets").alias("bucket")), None), near.turns)
    pairs = written(candidates(rows), "candidates")
    wanted = nodes.select("node", "key", "text_hash").join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi")
    sets = written(sets_of(docs, wanted, near, key, text), "sets")
    labels = components(_linked(confirmed(pairs, sets), near.percent))
    blobs = blobs_of(rows, labels)
    if blobs is not None:
        apart = differences(blobs, sets, near)
        rays = apart.where("linked and node <> centre").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
        pairs = written(across(apart, near), "across")
        more = written(_linked(confirmed(pairs, sets), near.percent).union(rays), "more-links")
        if more.limit(1).count():
            labels = merged(labels, more)
    return signed, _labelled(nodes.select("node", "key", "text_hash"), labels)


def near_duplicates(docs: DataFrame, near: Near = Near(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: key, text_hash, n_shingles, component_id, kept.

    A-Z count as a-z; words are parted by ASCII white space. n_shingles: size of the set
    of shingles; a text of fewer words is one shingle; null texts and texts without words
    have none, link with nothing and are kept. Texts whose sets overlap by `percent` of
    their union are linked, whatever their number; component_id is the smallest key that
    links reach; kept: the key is that. Rows of equal sets are one node, so groups of
    copies cost one row each. Repeated rows are kept or dropped together. Null keys are
    reachable by none: a component of nothing else has a null component_id and is kept.
    Texts are taken whole; a task holds one text's words and shingles at a time, some
    twenty times the text's length. Other columns aren't read; an empty table gives no rows.
    """
    signed, nodes = _grouped(docs, near, key, text)
    least = nodes.groupBy("label").agg(F.min("key").alias("component_id"))
    ids = nodes.join(least, "label").select("node", "component_id")
    out = signed.select("key", "text_hash", "node", "n_shingles").join(ids, "node", "left")
    out = out.withColumn("component_id", F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id")))
    return out.select(F.col("key").alias(key), "text_hash", "n_shingles", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, near: Near = Near(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one document of each component: the smallest key's (null last), of several texts of that key the one of least hash.

    Texts without words, null and empty ones too, are components of their own: they stay.
    Of rows with equal key and text one stays, the others are repetitions. All columns
    stay as they are; the texts are shuffled once. An empty table stays empty.
    """
    signed, nodes = _grouped(docs, near, key, text)
    one = nodes.groupBy("label").agg(F.min(F.struct(F.col("key").isNull().alias("_null"), "key", "text_hash")).alias("_k")).select("_k.key", "_k.text_hash")
    kept = one.union(signed.where("node is null").select("key", "text_hash"))
    # a key as text, so that null is a value to join and group by
    name = lambda c: F.coalesce(c.cast("string"), F.lit("\0null"))
    kept = kept.select(name(F.col("key")).alias("_key"), F.col("text_hash").alias("_hash")).distinct()
    rows = docs.select(name(F.col(key)).alias("_key"), F.xxhash64(text).alias("_hash"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    # joined and grouped by the same columns: one exchange
    return rows.join(kept, ["_key", "_hash"], "left_semi").groupBy("_key", "_hash").agg(F.first("_row").alias("_row")).select("_row.*")
