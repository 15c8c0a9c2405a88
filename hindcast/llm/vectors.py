"""Near-duplicate vectors by products of quantised tiles, with error bounds.

Unit vectors are rounded to multiples of a step, 127 of which are their largest component. What
rounding costs is known exactly for each vector, so the product of two rounded vectors bounds their
cosine from above. Tiles of rounded vectors are multiplied as whole numbers; only pairs whose bound
reaches the threshold are computed again in double precision.

Equal vectors are one node of the graph, so copies add no pairs. A pair of tiles returns how many
vectors each vector is linked with and a forest with the same components as its links: both grow
with the vectors in the tiles, not with the links between them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.llm.common import column_or_null, kept
from hindcast.llm.components import components

#: Vectors in a tile, about. Tiles are dealt by a hash, so that none is much larger.
TILE = 2048
#: Rows of a tile multiplied at once.
STRIP = 512
#: Room for rounding in single precision, where bounds are compared.
SLACK = 1e-5


def near_duplicates(vectors: DataFrame, *, threshold: float = 0.9, tile: int = TILE) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Rows link whose ``embedding`` has a cosine of ``threshold`` or more, in double precision.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor
    do those of different lengths with each other or rows without an id (whose component is null).
    Rows are vectors of their own, also where ids repeat: they count each other as links, and a
    repeated smallest id is kept each time. An empty table gives an empty result.
    """
    rows = vectors.select(
        column_or_null(vectors, "vec_id", "long"), F.col("embedding").alias("v")
    )
    sound = F.col("vec_id").isNotNull() & F.coalesce(
        F.exists("v", lambda x: x != 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))),
        F.lit(False),
    )
    # Single precision is shuffled as such; tasks compute in double. -0.0 and 0.0 are one component.
    single = dict(rows.dtypes)["v"] == "array<float>"
    kind = "float" if single else "double"
    rows = rows.withColumn("v", F.when(sound, F.col("v").cast(f"array<{kind}>")))
    zero = F.lit(0.0).cast(kind)
    rows = kept(rows.withColumn("v", F.transform("v", lambda x: x + zero)), "vectors")
    usable = rows.where("v IS NOT NULL")
    classes = usable.groupBy("v").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    # Two classes may have the same smallest id where ids repeat.
    classes = kept(
        classes.withColumn("class", F.monotonically_increasing_id()), "vector-classes"
    )
    found = kept(_tile_pairs(classes, threshold, tile), "vector-links")
    degrees = found.where("linked IS NOT NULL").groupBy(F.col("a").alias("class")).agg(
        F.sum("linked").alias("linked")
    )
    groups = components(found.where("b IS NOT NULL").select("a", "b"))
    groups = classes.join(groups, classes["class"] == groups["node"], "left").select(
        classes["class"], classes["node"], "v", "copies",
        F.coalesce("component", "class").alias("component"),
    )
    least = groups.groupBy("component").agg(F.min("node").alias("component_id"))
    named = groups.join(least, "component").join(degrees, "class", "left")
    named = named.select(
        F.col("v").alias("u"),
        "component_id",
        (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("linked"),
    )
    return rows.join(named, rows["v"] == named["u"], "left").select(
        "vec_id",
        F.coalesce("linked", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.expr("vec_id = component_id"), F.lit(False)))


def _tile_pairs(classes: DataFrame, threshold: float, tile: int) -> DataFrame:
    """``a``, ``b``, ``linked``: forest edges (a, b), and numbers of vectors a is linked with."""
    tiles = max(-(-classes.count() // tile), 1)
    own = F.pmod(F.xxhash64("class"), F.lit(tiles)).cast("int")
    dealt = classes.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    )
    dealt = dealt.select(
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        "own", "class", "copies", "v",
    )

    def run(group: pa.Table) -> pa.Table:
        return _linked(group, threshold)

    return dealt.groupBy("i", "j").applyInArrow(run, "a long, b long, linked long")


class _Tile:
    """Vectors of one length as units, rounded, and what rounding costs them."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.copies = ids, copies
        # Scaled first: the square of a very large or small component is beyond a double.
        vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        self.units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        step = np.abs(self.units).max(axis=1, keepdims=True) / 127
        whole = np.rint(self.units / step)
        self.step = step[:, 0]
        self.error = np.linalg.norm(self.units - whole * step, axis=1)
        self.length = np.linalg.norm(whole, axis=1) * self.step
        # Products of whole numbers are exact in single precision below 2 ** 24.
        exact = self.units.shape[1] * 127 * 127 < 1 << 24
        self.whole = whole.astype(np.float32 if exact else np.float64)

    def near(self, other: _Tile, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of pairs whose cosine reaches the threshold."""
        scaled = other.step.astype(np.float32)
        for k in range(0, len(self.ids), STRIP):
            part = slice(k, k + STRIP)
            product = self.whole[part] @ other.whole.T
            product *= scaled
            cost = (
                self.length[part] * other.error.max()
                + self.error[part] * (other.length.max() + other.error.max())
            )
            least = ((threshold - cost - SLACK) / self.step[part]).astype(np.float32)
            a, b = np.nonzero(product >= least[:, None])
            a += k
            for m in range(0, len(a), 1 << 16):
                some, others = a[m : m + (1 << 16)], b[m : m + (1 << 16)]
                cosine = np.einsum("ij,ij->i", self.units[some], other.units[others])
                yes = cosine >= threshold
                yield some[yes], others[yes]


def _linked(group: pa.Table, threshold: float) -> pa.Table:
    ids = group.column("class").to_numpy()
    own = group.column("own").to_numpy()
    copies = group.column("copies").to_numpy()
    vectors = group.column("v").combine_chunks()
    lengths = np.diff(vectors.offsets.to_numpy())
    starts = vectors.offsets.to_numpy()[:-1]
    values = vectors.values.to_numpy().astype(np.float64)
    one, two = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    out_a, out_b, out_n = [], [], []
    for length in np.unique(lengths):
        def taken(number: int, length: int = length) -> _Tile | None:
            at = np.flatnonzero((own == number) & (lengths == length))
            at = at[np.argsort(ids[at])]
            if not len(at):
                return None
            return _Tile(ids[at], copies[at], values[starts[at][:, None] + np.arange(length)])

        left = taken(one)
        right = left if one == two else taken(two)
        if left is None or right is None:
            continue
        same = left is right
        nodes = left.ids if same else np.concatenate([left.ids, right.ids])
        shift = 0 if same else len(left.ids)
        tree = _Forest(len(nodes))
        degree = np.zeros(len(nodes), dtype=np.int64)
        for a, b in left.near(right, threshold):
            if same:
                a, b = a[a < b], b[a < b]
            degree += np.bincount(a, right.copies[b], len(nodes)).astype(np.int64)
            degree += np.bincount(b + shift, left.copies[a], len(nodes)).astype(np.int64)
            tree.add(a, b + shift)
        roots = tree.roots()
        hung = np.flatnonzero(roots != np.arange(len(nodes)))
        some = np.flatnonzero(degree)
        out_a += [nodes[hung], nodes[some]]
        out_b += [pa.array(nodes[roots[hung]]), pa.nulls(len(some), pa.int64())]
        out_n += [pa.nulls(len(hung), pa.int64()), pa.array(degree[some])]
    if not out_a:
        none = pa.array([], pa.int64())
        return pa.table({"a": none, "b": none, "linked": none})
    return pa.table({
        "a": np.concatenate(out_a), "b": pa.concat_arrays(out_b), "linked": pa.concat_arrays(out_n),
    })


class _Forest:
    """Components of nodes by number, links added in bulk."""

    def __init__(self, many: int) -> None:
        self.above = np.arange(many)

    def roots(self) -> np.ndarray:
        while True:
            higher = self.above[self.above]
            if (higher == self.above).all():
                return higher
            self.above = higher

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            top = self.roots()
            a, b = top[a], top[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.above, np.maximum(a, b), np.minimum(a, b))
