"""Column headers to ontology types, by equal label and by vector similarity.

An annotation is ``(table_id, col_idx, header, ontology, method, type_pos,
cleaned_label, similarity)``; ``similarity`` is null for the syntactic method.
The key column may have another name, given as ``key``.
"""

from __future__ import annotations

import math
import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefold.functions import text, vectors as v
from tablefold.session import cut_lineage

# Executors need not have this package installed: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIMILARITY_THRESHOLD = 0.56  # fixed value
# Type vectors up to this many numbers (128 MB as doubles) are broadcast as one matrix.
BROADCAST_NUMBERS = 16_000_000
# Types and headers in one row when both are more than that.
BLOCK_TYPES = 8192
BLOCK_HEADERS = 8192
# Texts (or bytes of them) of a task whose vectors are summed by one reading of the words' vectors, and words whose vectors are taken out at once.
BLOCK_TEXTS = 65_536
BLOCK_BYTES = 64_000_000
BLOCK_WORDS = 32_768
# Products are taken in tiles that stay in a core's cache.
TILE_HEADERS = 256
TILE_TYPES = 1024
# Rows of a tile whose nearest types are taken in double at once.
TILE_NEAR = 64
# Types of a block of the index, and rounds in which its centres move.
INDEX_TYPES = 128
CLUSTER_ROUNDS = 4
# Types lie in blocks if half a block of them lies within this angle of most of so many types that are looked at.
NARROW_ANGLE = math.radians(50)
NARROW_ROWS = 32
# What rounding may do to an angle; near zero it grows to the root of a double's precision.
ANGLE_SLACK = 1e-6
# Similarities are compared after rounding, so that the order of a sum decides nothing.
DECIMALS = 12


def match_syntactic(columns: DataFrame, ontology: DataFrame, key: str = "file_id") -> DataFrame:
    """Columns whose clean header equals a type label; the first such column of a table wins."""
    labelled = columns.select(key, "col_idx", "header", text.clean_header(F.col("header")).alias("cleaned_label"))
    types = ontology.select("ontology", "cleaned_label", "type_pos")
    matched = labelled.join(types, "cleaned_label")
    first = matched.groupBy(key, "ontology", "cleaned_label", "type_pos").agg(
        F.min(F.struct("col_idx", "header")).alias("c")
    )
    return first.select(
        key, "c.col_idx", "c.header", "ontology", F.lit("syntactic").alias("method"),
        "type_pos", "cleaned_label", F.lit(None).cast("double").alias("similarity"),
    )


def embed_text(
    texts: DataFrame, word_vectors: DataFrame, dim: int, id_col: str = "text", vectors: DataFrame | None = None,
    max_numbers: int = BROADCAST_NUMBERS,
) -> DataFrame:
    """``(id_col, vec)``: mean of the unit vectors of the words of each distinct text.

    ``word_vectors`` holds ``word, vec``, or ``word, vec_id`` with ``vectors(vec_id, vec)``,
    so that words with one vector need not each carry it. Unknown and zero-length words
    are skipped; a text with none left is absent. Vectors counted to fit go to the tasks,
    where a text's words lie together, so that no vector is shuffled or stored; the
    words are looked up under numbers of the texts. More vectors go to the tasks by
    some of their dimensions at a time, and only their numbers are shuffled.
    """
    texts = texts.select(id_col).distinct()
    known, fits = _known(word_vectors, dim, vectors, max_numbers)
    if not fits:
        numbered, words = _numbered(known, word_vectors)
        return _means_by_dimensions(_keyed(texts, words, id_col, _tasks(texts)).drop("_number"), numbered, dim, max_numbers)
    if vectors is not None:
        ids = ["_number", id_col]  # a text's words lie together by its number
        words = _keyed(texts, word_vectors, id_col, _tasks(texts)).select(*ids, F.explode("_keys").alias("vec_id"))
        return _means(words, ids, known, dim).drop("_number")
    return _means(_words(texts.repartition(_tasks(texts), id_col), id_col), [id_col], known, dim)


def _known(word_vectors: DataFrame, dim: int, vectors: DataFrame | None, max_numbers: int) -> tuple[DataFrame, bool]:
    """``word`` or ``vec_id`` with ``vec, length`` of vectors that are not zero, and whether they may go to the tasks."""
    source, key = (word_vectors, "word") if vectors is None else (vectors, "vec_id")
    known = source.select(key, "vec", v.norm(F.col("vec")).alias("length")).filter(F.col("length") > 0)
    return known, known.count() * dim <= max_numbers


def _words(df: DataFrame, id_col: str) -> DataFrame:
    return df.withColumn("word", F.explode(text.words(F.col(id_col))))


def _keyed(texts: DataFrame, word_vectors: DataFrame, id_col: str, tasks: int) -> DataFrame:
    """``(_number, id_col, _keys)``: the sorted ``vec_id`` of the words of distinct texts, dealt over ``tasks`` by numbers of the texts."""
    numbered = cut_lineage(texts.withColumn("_number", F.monotonically_increasing_id()))
    found = _words(numbered, id_col).select("_number", "word").join(word_vectors.select("word", "vec_id"), "word")
    found = found.select("_number", "vec_id").repartition(tasks, "_number")
    gathered = found.groupBy("_number").agg(F.sort_array(F.collect_list("vec_id")).alias("_keys"))
    return numbered.repartition(tasks, "_number").join(gathered, "_number").select("_number", id_col, "_keys")


def _means(words: DataFrame, ids: list[str], known: DataFrame, dim: int) -> DataFrame:
    """``(ids, vec)``: mean of the unit vectors of the ``words`` (``ids`` and the key of ``known``, which goes to the tasks)."""
    joined = words.join(F.broadcast(known), known.columns[0]).withColumn("weight", 1 / F.col("length"))
    sums = [F.sum(F.col("weight") * F.get("vec", F.lit(i))).alias(f"s{i}") for i in range(dim)]
    summed = joined.groupBy(*ids).agg(F.count("*").alias("n"), *sums)
    return summed.select(*ids, F.array(*[F.col(f"s{i}") / F.col("n") for i in range(dim)]).alias("vec"))


def _numbered(known: DataFrame, word_vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``known`` stored with ``_row``, a number in the order of its partitions, and ``(word, vec_id)`` with that number as ``vec_id``."""
    key = known.columns[0]
    numbered = cut_lineage(known.withColumn("_row", F.monotonically_increasing_id()))
    rows = numbered.select(key, F.col("_row"))
    if key != "word":
        rows = word_vectors.select("word", key).join(rows, key)
    return numbered, rows.select("word", F.col("_row").alias("vec_id"))


def _means_by_dimensions(keyed: DataFrame, numbered: DataFrame, dim: int, max_numbers: int) -> DataFrame:
    """``keyed`` with ``vec``, the mean of the unit vectors that its ``_keys`` number, instead of those.

    The vectors go to the tasks in parts of up to ``max_numbers`` numbers, each with some
    of the dimensions of all vectors. A task holds one part at a time and goes
    over them once per ``BLOCK_TEXTS`` texts, so no vector is shuffled, and none is put together twice.
    """
    context = keyed.sparkSession.sparkContext
    sizes = {r["p"]: r["n"] for r in numbered.groupBy(F.shiftright("_row", 33).cast("int").alias("p")).agg(F.count("*").alias("n")).collect()}
    n_rows, at, starts = sum(sizes.values()), 0, np.zeros(max(sizes, default=-1) + 1, np.int64)
    for p in sorted(sizes):
        starts[p], at = at, at + sizes[p]
    place = lambda rows: starts[rows >> 33] + (rows & ((1 << 33) - 1))
    short = dict(numbered.dtypes)["vec"] == "array<float>"
    step = max(1, max_numbers // max(n_rows, 1))

    def part(first: int) -> np.ndarray:
        width = min(step, dim - first)
        number = lambda i: F.coalesce(F.get("vec", F.lit(i)), F.lit(0).cast("float"))
        numbers = [(number(first + i) if short else number(first + i) / F.col("length")).alias(f"x{i}") for i in range(width)]
        table = numbered.select("_row", *numbers).toArrow()
        out = np.empty((n_rows, width), np.float32 if short else np.float64)
        rows = place(table["_row"].to_numpy())
        for i in range(width):
            out[rows, i] = table[f"x{i}"].to_numpy()
        return out

    lengths = None
    if short and n_rows:
        table = numbered.select("_row", "length").toArrow()
        lengths = np.empty(n_rows)
        lengths[place(table["_row"].to_numpy())] = table["length"].to_numpy()
    weights = context.broadcast(None if lengths is None else 1 / lengths)
    parts = [(first, context.broadcast(part(first))) for first in range(0, dim if n_rows else 0, step)]
    names = [c for c in keyed.columns if c != "_keys"]

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, size = [], 0, 0

        def block() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            keys = table["_keys"].combine_chunks()
            counts = np.asarray(keys.value_lengths(), dtype=np.int64)
            rows = place(np.asarray(keys.flatten(), dtype=np.int64))
            begins = np.cumsum(counts) - counts
            cuts = [*np.unique(begins // BLOCK_WORDS, return_index=True)[1].tolist(), len(counts)]
            vec = np.empty((len(counts), dim))
            for first, shared in parts:
                matrix = _unkept(shared)
                for i, j in zip(cuts, cuts[1:]):
                    mine = rows[begins[i] : begins[j - 1] + counts[j - 1]]
                    some = matrix[mine] if weights.value is None else matrix[mine] * weights.value[mine, None]
                    vec[i:j, first : first + matrix.shape[1]] = np.add.reduceat(some, begins[i:j] - begins[i], axis=0)
                del matrix
            vec /= counts[:, None]
            for i in range(0, len(counts), BLOCK_HEADERS):
                some = vec[i : i + BLOCK_HEADERS]
                offsets = pa.array(np.arange(0, some.size + 1, dim, dtype=np.int32))
                columns = [table[c].slice(i, len(some)).combine_chunks() for c in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(offsets, pa.array(some.ravel()))], [*names, "vec"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n, size = n + batch.num_rows, size + batch.nbytes
            if n >= BLOCK_TEXTS or size >= BLOCK_BYTES:
                yield from block()
                held, n, size = [], 0, 0
        if n:
            yield from block()

    kinds = dict(keyed.dtypes)
    return keyed.mapInArrow(means, ", ".join([*[f"`{c}` {kinds[c]}" for c in names], "vec array<double>"]))


def _unkept(shared: Broadcast) -> np.ndarray:
    """The value of a broadcast, which the worker does not keep where it can be read again."""
    path = getattr(shared, "_path", None)
    return shared.load_from_path(path) if path else shared.value


def _tasks(df: DataFrame) -> int:
    """Tasks where the work and not the bytes decide: as many as the session has for shuffles, or cores."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _unit_rows(column: pa.ListArray | pa.ChunkedArray, n_rows: int) -> np.ndarray:
    """Vectors of a list column as the rows of a matrix, at length one; zero vectors stay zero."""
    flat = pa.chunked_array(column) if isinstance(column, pa.ListArray) else column
    numbers = np.asarray(flat.combine_chunks().flatten(), dtype=np.float64).reshape(n_rows, -1)
    lengths = np.linalg.norm(numbers, axis=1, keepdims=True)
    return np.divide(numbers, lengths, out=np.zeros_like(numbers), where=lengths > 0)


def _tile_best(left: np.ndarray, right: np.ndarray, positions: np.ndarray, score: np.ndarray, found: np.ndarray) -> None:
    """Raises ``score`` and ``found`` of each row to its best type; of equal ones the first in ``positions``."""
    # Products in single precision tell which types may be a row's best; only those are taken in double.
    short_left = left.astype(np.float32)
    slack = (left.shape[1] + 8) * 2.0**-23
    space = np.empty((TILE_HEADERS, TILE_TYPES), np.float32)
    for cols in range(0, len(right), TILE_TYPES):
        part, places = right[cols : cols + TILE_TYPES], positions[cols : cols + TILE_TYPES]
        short = part.astype(np.float32).T
        for rows in range(0, len(left), TILE_HEADERS):
            top, at = score[rows : rows + TILE_HEADERS], found[rows : rows + TILE_HEADERS]
            tile = np.matmul(short_left[rows : rows + TILE_HEADERS], short, out=space[: len(top), : len(part)])
            highest = tile.max(axis=1)
            for near in _slices(np.nonzero(highest + slack >= top)[0], TILE_NEAR):
                r, c = np.nonzero(tile[near] >= np.maximum(highest[near] - 2 * slack, top[near] - slack)[:, None])
                if not len(r):
                    continue
                exact = np.round(np.einsum("ij,ij->i", left[rows + near[r]], part[c]), DECIMALS)
                order = np.lexsort((places[c], -exact, r))
                first = order[np.unique(r[order], return_index=True)[1]]
                row, best, place = near[r[first]], exact[first], places[c[first]]
                # The threshold is strict; an equal type wins only over a later one.
                better = (best > top[row]) | ((best == top[row]) & (place < at[row]))
                top[row[better]], at[row[better]] = best[better], place[better]


def _slices(values: np.ndarray, length: int) -> Iterator[np.ndarray]:
    return (values[i : i + length] for i in range(0, len(values), length))


def _clusters(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit centres, and each unit row's centre, after a few rounds of moving centres to the middle of their rows."""
    centres = matrix[:: -(-len(matrix) // count)]
    for _ in range(CLUSTER_ROUNDS):
        owner = (matrix @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, matrix)
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.divide(sums, lengths, out=centres.copy(), where=lengths > 0)
    return centres, (matrix @ centres.T).argmax(axis=1)


def _angles(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(left @ right.T, -1.0, 1.0))


def _reach(angles: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Upper bounds of the similarity to any type of a block, by the triangle inequality on the sphere."""
    return np.cos(np.maximum(angles - radii - ANGLE_SLACK, 0.0))


def _narrow(matrix: np.ndarray) -> bool:
    """Whether unit rows lie close enough together for blocks of them to be left out; elsewhere blocks only cost."""
    looked = matrix[:: -(-len(matrix) // NARROW_ROWS)]
    rank = min(INDEX_TYPES // 2, len(matrix)) - 1
    nearest = -np.partition(-(looked @ matrix.T), rank, axis=1)[:, rank]
    return bool(np.median(nearest) >= math.cos(NARROW_ANGLE))


def index_types(positions: np.ndarray, matrix: np.ndarray) -> tuple:
    """Types of one ontology in blocks around centres: ``(centres, radii, [(positions, rows), ...])``.

    ``matrix`` holds unit rows or zero rows, ``positions`` ascend. A zero row is at no
    angle to anything, so its block has the radius of the whole sphere; types that
    lie far from each other come as one block of that radius.
    """
    zero = ~matrix.any(axis=1)
    if len(matrix) and (zero.all() or not _narrow(matrix[~zero])):
        return np.zeros((1, matrix.shape[1])), np.asarray([math.pi]), [(positions, matrix)]
    real = np.nonzero(~zero)[0]
    blocks, centres, radii = [], [], []
    if len(real):
        middle, owner = _clusters(matrix[real], -(-len(real) // INDEX_TYPES))
        for c in np.unique(owner):
            mine = real[owner == c]
            blocks.append((positions[mine], matrix[mine]))
            centres.append(middle[c])
            radii.append(_angles(matrix[mine], middle[c : c + 1]).max())
    if zero.any():
        blocks.append((positions[zero], matrix[zero]))
        centres.append(np.zeros(matrix.shape[1]))
        radii.append(math.pi)
    return np.asarray(centres).reshape(len(blocks), matrix.shape[1]), np.asarray(radii), blocks


def best_in_index(left: np.ndarray, index: tuple, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Rows with a type above the threshold, its position, the similarity, and how many products were taken.

    A row first meets the block of the nearest centre, then those whose bound reaches
    what it has found; the rest cannot hold a type as similar, so the result is exact.
    """
    centres, radii, blocks = index
    score = np.full(len(left), float(threshold))
    found = np.full(len(left), -1, dtype=np.int64)
    if not blocks or not len(left):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), 0
    angles = _angles(left, centres)
    bound = _reach(angles, radii)
    bound[~left.any(axis=1)] = 1.0
    first = (angles - radii).argmin(axis=1) if len(blocks) > 1 else np.zeros(len(left), np.int64)
    products = len(left) * len(blocks)
    for own in (True, False):
        for b, (positions, rows) in enumerate(blocks):
            met = np.nonzero(((first == b) == own) & (bound[:, b] >= score))[0]
            if len(met):
                top, at = score[met], found[met]
                _tile_best(left[met], rows, positions, top, at)
                score[met], found[met] = top, at
                products += len(met) * len(rows)
    kept = np.nonzero(found >= 0)[0]
    return kept, found[kept], score[kept], products


def _all_above(left: np.ndarray, right: np.ndarray, positions: np.ndarray, threshold: float) -> tuple[np.ndarray, ...]:
    parts = []
    for rows in range(0, len(left), TILE_HEADERS):
        for cols in range(0, len(right), TILE_TYPES):
            tile = np.round(left[rows : rows + TILE_HEADERS] @ right[cols : cols + TILE_TYPES].T, DECIMALS)
            r, f = np.nonzero(tile > threshold)
            parts.append((r + rows, positions[f + cols], tile[r, f]))
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _matches(left: np.ndarray, index: tuple, threshold: float, best: bool) -> tuple[np.ndarray, ...]:
    """The best type of each row, or all above the threshold."""
    if best:
        return best_in_index(left, index, threshold)[:3]
    centres, radii, blocks = index
    parts = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    bound = _reach(_angles(left, centres), radii)
    bound[~left.any(axis=1)] = 1.0
    for b, (positions, rows) in enumerate(blocks):
        met = np.nonzero(bound[:, b] > threshold)[0]
        r, pos, sim = _all_above(left[met], rows, positions, threshold)
        parts.append((met[r], pos, sim))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _found(headers: pa.Array | pa.ChunkedArray, name: str, rows: np.ndarray, found: np.ndarray, score: np.ndarray) -> pa.Table:
    columns = [headers.take(pa.array(rows)), pa.array([name] * len(rows), pa.string()), pa.array(found, pa.int64()), pa.array(score, pa.float64())]
    return pa.table(columns, names=["header", "ontology", "type_pos", "similarity"])


def _type_blocks(types: DataFrame, best: bool) -> DataFrame:
    """``n, types``: the types of a task by up to ``BLOCK_TYPES``, indexed by ontology, as bytes.

    Where only the ``best`` type counts, a block keeps the first of its types with one vector.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = {}, 0

        def block() -> pa.RecordBatch:
            whole, kept = {}, 0
            for name, parts in held.items():
                positions, rows = (np.concatenate(x) for x in zip(*parts))
                order = np.argsort(positions, kind="stable")
                if best:
                    order = order[np.sort(np.unique(rows[order], axis=0, return_index=True)[1])]
                whole[name] = index_types(positions[order], rows[order])
                kept += len(order)
            return pa.RecordBatch.from_arrays([pa.array([kept]), pa.array([pickle.dumps(whole)], pa.binary())], ["n", "types"])

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_TYPES):
                part = batch.slice(at, BLOCK_TYPES)
                if n and n + part.num_rows > BLOCK_TYPES:
                    yield block()
                    held, n = {}, 0
                names = np.asarray(part.column("ontology").to_pylist(), dtype=object)
                positions, rows = np.asarray(part.column("type_pos"), dtype=np.int64), _unit_rows(part.column("vec"), part.num_rows)
                for name in set(names):
                    held.setdefault(name, []).append((positions[names == name], rows[names == name]))
                n += part.num_rows
        if n:
            yield block()

    return types.mapInArrow(packed, "n long, types binary")


def _header_blocks(headers: DataFrame) -> DataFrame:
    """``header, vec``: the headers of a task by up to ``BLOCK_HEADERS``, their unit rows as bytes."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rows, n = [], [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([names], pa.list_(pa.string())), pa.array([np.concatenate(rows).tobytes()], pa.binary())], ["header", "vec"]
            )

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_HEADERS):
                part = batch.slice(at, BLOCK_HEADERS)
                if n and n + part.num_rows > BLOCK_HEADERS:
                    yield block()
                    names, rows, n = [], [], 0
                names += part.column("header").to_pylist()
                rows.append(_unit_rows(part.column("vec"), part.num_rows))
                n += part.num_rows
        if n:
            yield block()

    return headers.mapInArrow(packed, "header array<string>, vec binary")


def _scan_types(headers: DataFrame, types: DataFrame, dim: int, threshold: float, best: bool, max_numbers: int, store: bool = True) -> tuple[DataFrame, bool]:
    """``(header, ontology, type_pos, similarity)`` found in each part of the types, and whether there is only one.

    Without ``store`` headers stay in the tasks that make them, and are made again for each part.
    """
    types = types.select("ontology", "type_pos", "vec")
    headers = headers.select("header", "vec")
    schema = "header string, ontology string, type_pos long, similarity double"
    max_types = max_numbers // dim
    blocks = cut_lineage(_type_blocks(types, best))
    n_types = blocks.agg(F.sum("n")).first()[0] or 0
    context = headers.sparkSession.sparkContext
    if n_types <= max_types:
        held = {}
        for part in map(pickle.loads, blocks.select("types").toArrow()["types"].to_pylist()):
            for name, (_, _, found) in part.items():
                held.setdefault(name, []).extend(found)
        indexes = {}
        for name in sorted(held):
            positions, matrix = (np.concatenate(x) for x in zip(*held[name]))
            order = np.argsort(positions, kind="stable")
            indexes[name] = index_types(positions[order], matrix[order])
        shared = context.broadcast(indexes)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                left = _unit_rows(batch.column("vec"), batch.num_rows)
                for name, index in shared.value.items():
                    yield from _found(batch.column("header"), name, *_matches(left, index, threshold, best)).to_batches()

        # The product is the work here, not the bytes: keep it spread over all tasks.
        headers = headers.repartition(_tasks(headers), "header") if store else headers
        return headers.mapInArrow(scan, schema), True

    # Too many types to hold at once. Each task of a cartesian product reads a part of either side in blocks: no vector
    # is shuffled or written once per block it meets. Headers whose vectors come from words in place are not stored at all.
    parts = -(-n_types // max(max_types, 1))
    right = blocks.select("types")
    right = right.coalesce(parts) if parts < right.rdd.getNumPartitions() else right

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, rows, indexes in zip(*batch.columns):
                left = np.frombuffer(rows.as_buffer(), np.float64).reshape(len(names), -1)
                for name, index in pickle.loads(indexes.as_buffer()).items():
                    yield from _found(names.values, name, *_matches(left, index, threshold, best)).to_batches()

    left = _header_blocks(headers)
    left = cut_lineage(left) if store else left
    return left.hint("shuffle_replicate_nl").crossJoin(right).mapInArrow(meet, schema), False


def similar_types(
    headers: DataFrame, types: DataFrame, dim: int, threshold: float = SIMILARITY_THRESHOLD,
    max_numbers: int = BROADCAST_NUMBERS,
) -> DataFrame:
    """All (header, type) pairs whose cosine similarity lies above the threshold."""
    return _scan_types(headers, types, dim, threshold, False, max_numbers)[0]


def best_types(
    headers: DataFrame, types: DataFrame, dim: int, threshold: float = SIMILARITY_THRESHOLD,
    max_numbers: int = BROADCAST_NUMBERS, store: bool = True,
) -> DataFrame:
    """The most similar type per header and ontology above the threshold.

    ``headers(header, vec)`` are distinct; ``types(ontology, type_pos, vec)``.
    Equal similarities go to the first type in ontology order. Types lie in blocks
    around centres; by the triangle inequality a header meets only blocks that can
    hold a type above the threshold and as similar as the best so far, which is exact.
    Only winners leave the task. Beyond ``max_numbers`` numbers of types, the tasks of a
    cartesian product each hold about that many; time then grows with headers times types.
    The headers' vectors are stored for that, unless ``store`` is off as they are spread over
    tasks and cheap to make again.
    """
    found, whole = _scan_types(headers, types, dim, threshold, True, max_numbers, store)
    if whole and not store:  # distinct headers met all types at once
        return found
    best = F.max(F.struct("similarity", (-F.col("type_pos")).alias("p")))
    return (
        found.groupBy("header", "ontology")
        .agg(best.alias("b"))
        .select("header", "ontology", (-F.col("b.p")).alias("type_pos"), F.col("b.similarity").alias("similarity"))
    )


def match_semantic(
    columns: DataFrame,
    ontology: DataFrame,
    type_vectors: DataFrame,
    word_vectors: DataFrame,
    dim: int,
    threshold: float = SIMILARITY_THRESHOLD,
    key: str = "file_id",
    vectors: DataFrame | None = None,
    max_numbers: int = BROADCAST_NUMBERS,
) -> DataFrame:
    """Columns annotated with the most similar type of each ontology.

    Headers repeat a lot between tables, so each distinct clean header is
    embedded (``embed_text``) and matched once and the result joined back.
    Their vectors are made where they are matched and never stored.
    """
    usable = columns.filter(text.eligible_header(F.col("header"))).select(
        key, "col_idx", "header", text.clean_header(F.col("header")).alias("_clean")
    )
    cleaned = usable.select(F.trim(F.col("_clean"), F.lit("\n")).alias("text"))
    headers = embed_text(cleaned, word_vectors, dim, vectors=vectors).withColumnRenamed("text", "header")
    best = best_types(headers, type_vectors, dim, threshold, max_numbers, store=False)
    labelled = best.join(ontology.select("ontology", "type_pos", "cleaned_label"), ["ontology", "type_pos"])
    labelled = labelled.withColumnRenamed("header", "_match")
    usable = usable.withColumn("_match", F.trim(F.col("_clean"), F.lit("\n")))
    joined = usable.join(labelled, "_match")
    return joined.select(
        key, "col_idx", "header", "ontology", F.lit("semantic").alias("method"),
        "type_pos", "cleaned_label", F.round("similarity", 4).alias("similarity"),
    )


# What an annotation carries of its type, beside the label.
ENTRY = ["id", "description", "domain", "range"]


def with_entries(annotations: DataFrame, ontology: DataFrame) -> DataFrame:
    """``annotations`` with the type's ``id, description, domain, range``; null where the ontology lacks them."""
    known = [F.col(c) if c in ontology.columns else F.lit(None).cast("array<string>").alias(c) for c in ENTRY]
    return annotations.join(ontology.select("ontology", "type_pos", *known), ["ontology", "type_pos"], "left")


def embed_types(
    ontology: DataFrame, word_vectors: DataFrame, dim: int, vectors: DataFrame | None = None, firsts: bool = False,
    max_numbers: int = BROADCAST_NUMBERS,
) -> DataFrame:
    """``(ontology, type_pos, vec)`` of every type label; words and their vectors as in ``embed_text``.

    With ``firsts``, of an ontology's types whose words point to the same ``vectors``
    only the first comes, as no other can be the best. They are told by the
    numbers of those vectors, before there are any sums to move.
    """
    labels = ontology.select(F.col("cleaned_label").alias("text"))
    types = ontology.select("ontology", "type_pos", "cleaned_label")
    if vectors is None or not firsts:
        embedded = embed_text(labels, word_vectors, dim, vectors=vectors, max_numbers=max_numbers)
        return types.join(embedded.withColumnRenamed("text", "cleaned_label"), "cleaned_label").select("ontology", "type_pos", "vec")
    known, fits = _known(word_vectors, dim, vectors, max_numbers)
    numbered, words = (None, word_vectors) if fits else _numbered(known, word_vectors)
    keyed = _keyed(labels.distinct(), words, "text", _tasks(labels)).select(F.col("text").alias("cleaned_label"), "_keys")
    first = types.join(keyed, "cleaned_label").groupBy("ontology", "_keys").agg(F.min("type_pos").alias("type_pos"))
    ids = ["ontology", "type_pos"]
    first = first.select(*ids, "_keys").repartition(_tasks(first), *ids)
    if not fits:
        return _means_by_dimensions(first, numbered, dim, max_numbers)
    return _means(first.select(*ids, F.explode("_keys").alias("vec_id")), ids, known, dim)
