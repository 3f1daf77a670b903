"""Near duplicates of embeddings by cosine, in tiles ordered by principal components.

Vectors are normalised in double precision and turned onto the principal components of a bounded sample;
a rotation changes no cosine, so the sample decides only how soon a comparison ends. Vectors of a cosine of
at least t differ by at most sqrt(2 - 2t) in each component. So vectors are put into cells by label and the
first components, and only cells that touch are compared, tile by tile: products of the leading components
are summed first, the rest is bounded by the product of the norms of what is left, and a pair is dropped as
soon as it cannot reach t. What remains is computed in full.

Vectors that are null, empty, zero, or hold a null or a number that is not finite link with nothing, and
neither do those without a label or an id, or of different lengths. Equal vectors of a label are compared
once, as a class. Ids are taken to be unique; rows that repeat an id with the same vector count as vectors
of their own. Only the three named columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.components import components
from tidemark.llm.sampling import UNITS
from tidemark.llm.store import stored
from tidemark.llm.tiles import tiled

STEP = 16  # components summed between two looks at the bound
SLACK = 1e-9


def normalised(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def principal_components(classes: DataFrame, sample: int = 20_000) -> dict[int, np.ndarray]:
    """An orthonormal basis for each length of vectors, most variance first, from about ``sample`` vectors."""
    count = classes.count()
    unit = F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(UNITS))
    rows = classes.where(unit < int(UNITS * min(1.0, sample / max(1, count)))).select("embedding").toArrow()
    by_length: dict[int, list] = {}
    for v in rows["embedding"].to_pylist():
        by_length.setdefault(len(v), []).append(v)
    basis = {}
    for n, vectors in by_length.items():
        x = normalised(vectors)
        basis[n] = np.linalg.eigh(x.T @ x)[1][:, ::-1].copy()
    return basis


def links_of(x: np.ndarray, z: np.ndarray, left: np.ndarray, right: np.ndarray, least: float, rows: int = 64) -> np.ndarray:
    """Which of left x right have a cosine of at least ``least``; x are unit vectors, z the same, turned."""
    dims = z.shape[1]
    cuts = list(range(0, dims, STEP)) + [dims]
    rest = np.sqrt(np.maximum(0, np.cumsum(z[:, ::-1] ** 2, axis=1)[:, ::-1]))
    rest = np.column_stack([rest, np.zeros(len(z))])  # rest[:, k]: norm of the components from k on
    out = np.zeros((len(left), len(right)), bool)
    for at in range(0, len(left), rows):
        a = left[at:at + rows]
        first = cuts[1]
        part = z[a, :first] @ z[right, :first].T
        i, j = np.nonzero(part + np.outer(rest[a, first], rest[right, first]) >= least - SLACK)
        if len(i) * 8 > part.size:  # most may still reach it: one product of all
            out[at:at + rows] = x[a] @ x[right].T >= least
            continue
        sums = part[i, j]
        for lo, hi in zip(cuts[1:-1], cuts[2:], strict=True):
            sums += (z[a[i], lo:hi] * z[right[j], lo:hi]).sum(axis=1)
            alive = sums + rest[a[i], hi] * rest[right[j], hi] >= least - SLACK
            i, j, sums = i[alive], j[alive], sums[alive]
        hit = (x[a[i]] * x[right[j]]).sum(axis=1) >= least
        out[at + i[hit], j[hit]] = True
    return out


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches by the links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def embedding_duplicates(
    embeddings: DataFrame, least: float = 0.98, cell_components: int = 2, rows_per_tile: int = 1024, sample: int = 20_000
) -> DataFrame:
    """vec_id, n_links, component_id and ``kept`` for each row of (vec_id, embedding, label)."""
    spark = embeddings.sparkSession
    e = F.col("embedding").cast("array<double>")
    rows = embeddings.select("vec_id", e.alias("embedding"), "label")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
        & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False)))
    rows = stored(rows.withColumn("usable", usable).withColumn("vector", F.when(usable, F.xxhash64("embedding"))))
    classes = stored(rows.where("usable").groupBy("label", "embedding").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n")))
    basis = spark.sparkContext.broadcast(principal_components(classes, sample))
    radius = float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-9
    width = max(2 * radius, 1e-3)

    def cells(batches):
        for pdf in batches:
            made = []
            for _, part in pdf.groupby(pdf["embedding"].map(len), sort=False):
                x = normalised(part["embedding"])
                own = basis.value.get(x.shape[1])
                z = x @ (np.eye(x.shape[1]) if own is None else own)
                m = min(cell_components, x.shape[1])
                home = np.floor(z[:, :m] / width).astype(np.int64)
                near = z[:, :m] - home * width <= radius
                keys = ["".join(f"{c}," for c in h) for h in home]
                for shift in range(1 << m):
                    low = np.array([shift >> k & 1 for k in range(m)])
                    here = (near | (low == 0)).all(axis=1)  # also the cell below, where the edge is near
                    sub = part[here].copy()
                    sub["home"] = [k for k, ok in zip(keys, here, strict=True) if ok]
                    sub["cell"] = [f"{x.shape[1]}:" + "".join(f"{c}," for c in h) for h in home[here] - low]
                    made.append(sub)
            if made:
                yield pd.concat(made)

    label = rows.schema["label"].dataType.simpleString()
    kind = rows.schema["vec_id"].dataType.simpleString()
    placed = classes.mapInPandas(
        cells, f"label {label}, embedding array<double>, id {kind}, n long, home string, cell string")

    def compare(pdf: pd.DataFrame, left: np.ndarray, right: np.ndarray) -> pd.DataFrame:
        ids, n = pdf["id"].to_numpy(), pdf["n"].to_numpy()
        x = normalised(pdf["embedding"])
        own = basis.value.get(x.shape[1])
        linked = links_of(x, x if own is None else x @ own, left, right, least)
        i, j = np.nonzero(linked)
        i, j = left[i], right[j]
        # A pair that meets in several cells counts in the lowest of both homes.
        home = np.array([[int(c) for c in h.split(",")[:-1]] for h in pdf["home"]])
        cell = np.array([int(c) for c in pdf["cell"].iloc[0].split(":")[1].split(",")[:-1]])
        counts = (np.minimum(home[i], home[j]) == cell).all(axis=1) & (ids[i] != ids[j])
        i, j = i[counts], j[counts]
        total = np.bincount(i, n[j], len(pdf))
        if len(left) != len(pdf):  # two tiles
            total = total + np.bincount(j, n[i], len(pdf))
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), int)
        place[order] = np.arange(len(ids))
        root = ids[order][local_roots(len(ids), place[i], place[j])][place]
        some = total > 0
        return pd.DataFrame({"id": ids[some], "links": total[some].astype(np.int64), "root": root[some]})

    found = stored(tiled(placed, ["label", "cell"], compare, f"id {kind}, links long, root {kind}", rows_per_tile))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    of_class = classes.join(links, "id", "left").join(named, "id", "left").select(
        F.col("label").alias("_label"), F.col("embedding").alias("_embedding"), F.xxhash64("embedding").alias("_vector"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "id").alias("component"))
    same = (F.col("vector") == F.col("_vector")) & (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding"))
    return rows.join(of_class, same, "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component", "vec_id")).alias("kept"))
