"""Exact top-k search (operator 8) and embedding near-duplicates (operator 9).

Both work on blocks of vectors.  The number of blocks follows the number of
vectors, so a task holds one block of each side whatever the input; nothing
that grows with the input is broadcast or collected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillmill.llm.components import connected_components
from quillmill.llm.durable import durable

#: Vectors of one block: of queries, of candidates, and of cells.
QUERY_BLOCK = 1024
BLOCK = 8192
CELL_BLOCK = 65_536
#: Scores that a task holds at once when it joins a cell.
SCORES = 8_000_000
#: Pivots of a label at least and at most, and about how many vectors are measured to choose them.
FEWEST_PIVOTS, MOST_PIVOTS = 4, 64
PIVOT_SAMPLE = 2000


def finite_vector(vector: Column) -> Column:
    """Not null, not empty of meaning: no null, NaN or infinite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


# --- operator 8


def term_rows(vectors: DataFrame, *, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """Sparse rows: the positions and integer weights that are not zero."""
    whole = F.transform(F.col(vector_col).cast("array<double>"), lambda x: F.floor(x * scale))
    posts = F.filter(F.transform(whole, lambda w, i: F.struct(i.alias("term"), w.alias("weight"))), lambda p: p.weight != 0)
    kept = vectors.where(F.col(id_col).isNotNull() & finite_vector(F.col(vector_col).cast("array<double>")))
    return kept.select(F.col(id_col).alias("id"), F.transform(posts, lambda p: p.term).alias("terms"), F.transform(posts, lambda p: p.weight).alias("weights"))


def accumulate(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Term at a time: each term's weighted postings are scattered into one dense
    array of scores per query; a partition then selects the k best of each."""
    ids = rows["id"].to_numpy(np.int64)
    sizes = rows["terms"].map(len).to_numpy(np.int64)
    term = np.concatenate([*rows["terms"], []]).astype(np.int64)
    by_term = np.argsort(term, kind="stable")
    place = np.repeat(np.arange(len(ids)), sizes)[by_term]
    weight = np.concatenate([*rows["weights"], []]).astype(np.int64)[by_term]
    names, starts = np.unique(term[by_term], return_index=True)
    ends = np.append(starts[1:], len(term))
    postings = {t: (None if b - a == len(ids) else place[a:b], weight[a:b]) for t, a, b in zip(names.tolist(), starts.tolist(), ends.tolist(), strict=True)}  # None: every row, in order
    out: list[tuple] = []
    for q, number, ts, ws in zip(queries["id"], queries["number"], queries["terms"], queries["weights"], strict=True):
        scores = np.zeros(len(ids), np.int64)
        for t, w in zip(ts.tolist(), ws.tolist(), strict=True):
            if t in postings:
                places, weights = postings[t]
                if places is None:
                    scores += w * weights
                else:
                    scores[places] += w * weights
        others = np.flatnonzero(ids != q)
        if len(others) > k:
            own = scores[others]
            bound = np.partition(own, len(own) - k)[len(own) - k]
            others = others[own >= bound]  # ties with the last one too
        best = others[np.lexsort((ids[others], -scores[others]))[:k]]
        out += [(q, number, int(ids[i]), int(scores[i])) for i in best]
    return pd.DataFrame(out, columns=["query_id", "number", "vec_id", "score"])


def exact_top_k(vectors: DataFrame, is_query: Column, *, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank int, vec_id, score long: the k rows with the highest integer
    inner product for each row that is_query picks; ties go to the smaller id.

    Rows equal in id and vector count once; a query's own row is every row with
    its id.  Vectors of different lengths are compared over their common terms.
    Null ids, null vectors and vectors with null or non-finite components take
    no part.  Each block of queries meets each block of rows in one task.
    """
    known = [c for c in vectors.columns if c in (id_col, vector_col)]
    rows = term_rows(vectors.select(*known), id_col=id_col, vector_col=vector_col, scale=scale).dropDuplicates(["id", "terms", "weights"])
    asked = term_rows(vectors.where(is_query).select(*known), id_col=id_col, vector_col=vector_col, scale=scale).dropDuplicates(["id", "terms", "weights"])
    blocks = max(1, math.ceil(vectors.count() / BLOCK))
    query_blocks = max(1, math.ceil(vectors.where(is_query).count() / QUERY_BLOCK))
    number = F.xxhash64("id", "terms", "weights")
    left = asked.withColumn("number", number).withColumn("qb", F.pmod("number", F.lit(query_blocks))).withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = rows.withColumn("rb", F.pmod(number, F.lit(blocks))).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def meet(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        return accumulate(queries, candidates, k)

    pair = [F.col("qb").cast("long").alias("qb"), F.col("rb").cast("long").alias("rb")]
    best = left.select(*pair, "id", "number", "terms", "weights").groupBy("qb", "rb").cogroup(right.select(*pair, "id", "terms", "weights").groupBy("qb", "rb")).applyInPandas(meet, "query_id bigint, number bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id", "number").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


# --- operator 9


def _unit(blobs: pd.Series) -> np.ndarray:
    v = np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def choose_pivots(sample: np.ndarray, total: int, radius: float) -> np.ndarray:
    """As many pivots as cost least on the sample: fewer comparisons within
    smaller cells against more copies at their boundaries.  At least so many that
    a cell's own vectors make one block: where the triangle inequality prunes
    nothing, cells cost what blocks of the whole label would, and else less.
    Pivots are far apart: each is the vector farthest from those before it."""
    order, far = [0], _distance(sample, sample[:1])[:, 0]
    while len(order) < min(MOST_PIVOTS, len(sample)):
        order.append(int(far.argmax()))
        far = np.minimum(far, _distance(sample, sample[order[-1:]])[:, 0])
    ranked = sample[order]
    best, least = ranked[:1], math.inf
    n = min(len(sample), MOST_PIVOTS, max(FEWEST_PIVOTS, math.ceil(total / CELL_BLOCK)))
    while n <= min(MOST_PIVOTS, len(sample)):
        pivots = ranked[:n]
        cells = _cells(sample, pivots, radius)
        shares = cells.sum(0) * np.bincount(_distance(sample, pivots).argmin(1), minlength=n)
        pairs = shares.sum() * (total / len(sample)) ** 2
        copies = cells.sum() * (total / len(sample))
        if (cost := pairs + 4000 * copies) < least:
            best, least = pivots, cost
        n *= 2
    return best


def _distance(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * v @ pivots.T))


def _cells(v: np.ndarray, pivots: np.ndarray, radius: float) -> np.ndarray:
    """Which cells each vector has to be in: its own, and each whose members can be
    within the radius.  If u is at home with p and d(u, v) <= r then
    d(v, p) <= d(u, p) + r <= d(u, q) + r <= d(v, q) + 2 r for v's own pivot q."""
    d = _distance(v, pivots)
    return d <= d.min(1, keepdims=True) + 2 * radius + 1e-6


def place_in_cells(groups: DataFrame, radius: float) -> DataFrame:
    """groups: part, rep (a hash), blob, copies.  part, cell, home boolean, rep,
    copies, blob: each vector in its own cell (home) and, as a copy, in every cell
    that can hold a vector within the radius.

    Pivots come from a sample of each part, taken by a threshold on the hash; parts
    of any size are placed in slices of at most about a block.
    """
    sizes = groups.groupBy("part").agg(F.count("*").alias("n"))
    sized = groups.join(sizes, "part")
    share = F.pmod("rep", F.lit(1 << 30)) / float(1 << 30)
    drawn = sized.where(share * F.col("n") < PIVOT_SAMPLE)

    def pivots_of(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("rep")
        chosen = choose_pivots(_unit(part["blob"]), int(part["n"].iloc[0]), radius)
        return pd.DataFrame({"part": [part["part"].iloc[0]], "n": [part["n"].iloc[0]], "pivots": [chosen.tobytes()], "n_pivots": [len(chosen)]})

    slices = F.ceil(F.col("n") / CELL_BLOCK).cast("long")
    pivots = drawn.select("part", "n", "rep", "blob").groupBy("part").applyInPandas(pivots_of, "part bigint, n bigint, pivots binary, n_pivots bigint")
    right = pivots.select("part", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"), "pivots", "n_pivots")
    left = sized.select("part", F.pmod("rep", slices).alias("slice"), "rep", "copies", "blob")

    def place(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"part": [], "cell": [], "home": [], "rep": [], "copies": [], "blob": []})
        n = int(known["n_pivots"].iloc[0])
        own = np.frombuffer(known["pivots"].iloc[0], np.float64).reshape(n, -1)
        unit = _unit(rows["blob"])
        home = _distance(unit, own).argmin(1)
        at, cell = np.nonzero(_cells(unit, own, radius))
        return pd.DataFrame({"part": rows["part"].iloc[0], "cell": cell, "home": home[at] == cell, "rep": rows["rep"].to_numpy()[at], "copies": rows["copies"].to_numpy()[at], "blob": rows["blob"].to_numpy()[at]})

    return left.groupBy("part", "slice").cogroup(right.groupBy("part", "slice")).applyInPandas(place, "part bigint, cell bigint, home boolean, rep bigint, copies bigint, blob binary")


def near_duplicates(vectors: DataFrame, *, cosine: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id_col, n_links long, component_id, kept boolean; one row per input row.

    Vectors of one label link from the given cosine (double precision) on, which
    for unit vectors is a distance; pivots drawn from each label cut the space
    into cells, the triangle inequality tells which vectors a neighbouring cell
    needs too, and each cell, in blocks, is joined on its own.  Equal vectors
    are one representative with a count.  Cells give degrees and a spanning
    forest, never all their pairs.

    Null labels, and vectors that are null, zero or have null or non-finite
    components link with nothing, and so does a vector of another length.  Rows
    with the same id share a result.
    """
    id_type = vectors.schema[id_col].dataType.simpleString()
    doubles = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), doubles.alias("v"))
    usable = F.col("label").isNotNull() & F.col("id").isNotNull() & finite_vector(F.col("v")) & F.exists("v", lambda x: x != 0)
    packed = rows.where(usable).mapInArrow(_pack, f"id {id_type}, label {vectors.schema[label_col].dataType.simpleString()}, blob binary")
    keyed = durable(packed.withColumn("rep", F.xxhash64(F.col("label").cast("string"), "blob")))
    reps = keyed.groupBy("rep").agg(F.first("label").alias("label"), F.first("blob").alias("blob"), F.count("*").alias("copies"))
    groups = reps.select(F.xxhash64(F.col("label").cast("string"), F.length("blob")).alias("part"), "rep", "blob", "copies")
    radius = math.sqrt(2 - 2 * cosine)

    placed = durable(place_in_cells(groups, radius))
    full = placed.groupBy("part", "cell").agg(F.greatest(F.lit(1), F.ceil(F.count_if("home") / CELL_BLOCK)).alias("hs"), F.ceil(F.count("*") / CELL_BLOCK).alias("ms"))
    cells = placed.join(full, ["part", "cell"])
    homes = cells.where("home").select("part", "cell", F.pmod("rep", "hs").alias("h"), F.explode(F.sequence(F.lit(0), F.col("ms") - 1)).alias("m"), "rep", "blob")
    members = cells.select("part", "cell", F.explode(F.sequence(F.lit(0), F.col("hs") - 1)).alias("h"), F.pmod("rep", "ms").alias("m"), "rep", "copies", "blob")

    def join_block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = {"rep": [], "links": [], "other": []}
        if len(left) and len(right):
            a, b = _unit(left["blob"]), _unit(right["blob"])
            ra, rb, copies = left["rep"].to_numpy(), right["rep"].to_numpy(), right["copies"].to_numpy()
            parent = {}

            def root(x: int) -> int:
                while (y := parent.get(x, x)) != x:
                    parent[x] = parent.get(y, y)
                    x = y
                return x

            step = max(1, SCORES // len(b))
            for at in range(0, len(a), step):
                near = a[at : at + step] @ b.T >= cosine
                near &= ra[at : at + step, None] != rb[None, :]
                links = near @ copies
                for i in np.flatnonzero(links):
                    found["rep"].append(ra[at + i])
                    found["links"].append(links[i])
                    found["other"].append(None)
                    mine = root(int(ra[at + i]))
                    for other in rb[np.flatnonzero(near[i])].tolist():
                        if (theirs := root(other)) != mine:
                            parent[theirs] = mine
            for x in list(parent):
                if (top := root(x)) != x:
                    found["rep"].append(x)
                    found["links"].append(0)
                    found["other"].append(top)
        return pd.DataFrame({"rep": pd.Series(found["rep"], dtype="int64"), "links": pd.Series(found["links"], dtype="int64"), "other": pd.Series(found["other"], dtype="Int64")})

    by = ["part", "cell", "h", "m"]
    homes, members = (x.select(*(F.col(c).cast("long").alias(c) for c in by), *(F.col(c).alias(c) for c in x.columns if c not in by)) for x in (homes, members))
    told = durable(homes.groupBy(*by).cogroup(members.groupBy(*by)).applyInPandas(join_block, "rep bigint, links bigint, other bigint"))
    degrees = told.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = connected_components(told.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))

    with_copies = keyed.join(reps.select("rep", "copies"), "rep").join(degrees, "rep", "left").join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
    classed = with_copies.select("id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("root", "rep").alias("root"))
    smallest = classed.groupBy("root").agg(F.min("id").alias("component_id"))
    known = classed.join(smallest, "root").groupBy("id").agg(F.max("links").alias("links"), F.min("component_id").alias("component_id"))
    return rows.select("id").join(known, "id", "left").select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"), F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(True)).alias("kept"),
    )


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of their doubles, scaled where squares would leave the range."""
    for batch in batches:
        lists = batch.column(2)
        vectors = [np.asarray(x.values, np.float64) for x in lists]
        sizes = [float(np.abs(v).max()) for v in vectors]
        blobs = [(v if 1e-100 < n < 1e100 else v / n).tobytes() for v, n in zip(vectors, sizes, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())], ["id", "label", "blob"])
