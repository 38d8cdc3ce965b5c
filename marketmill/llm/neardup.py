"""MinHash near-duplicates by a chosen-path set-similarity join.

A document's set is its distinct five-word shingles (a shorter text is one
shingle). Two documents are linked where the sets have a Jaccard similarity of
at least 75 percent; a component is what links connect.

1. One pass computes each set's key, HASHES minwise values and, for each of
   TREES independent trees, the nodes at depth two: a node chooses one or two
   of the minwise tokens (4/3 on average, the inverse of the similarity), and
   a document goes to the child that its value of that token names. Two sets
   at the threshold keep one common node on average; over all trees they miss
   each other with a chance of about one in ten million. Depth two is the
   greatest depth, however crowded the nodes are.
2. Equal sets are one class with its smallest id.
3. In every node with two or more classes, each is compared with the smallest
   one. Confirmed links make first components.
4. Nodes whose members are in one component have nothing more to tell. Others
   that are too large, by their members or the size of those members' sets,
   are dealt into cells of two blocks, in which all pairs of different
   components meet. In nodes and cells all members of
   different components are compared by their minwise values. Of those within
   five standard deviations of the threshold the BEST of each document are
   confirmed first, but for pairs of step 3. Then the full sets of the members
   that such pairs still keep open, confirmed ones set aside, are brought
   together, once for all nodes that share members while these fit in one task,
   and compared exhaustively, and no pair leaves the task but links between
   components. A group of n copies makes
   rows in proportion to n; m members of a large node that the first links
   leave outside its largest component make m / LEAF times as many.

Every confirmation compares the full sets. A hot class or node is joined by
keys that Spark can split, and counts combine before shuffles.

Defined cases: a document without words has an empty set, is linked with
nothing and is its own component. A null id is linked with nothing and is
kept. Rows that repeat an id are one node with the links of all of them, and
all have the id's component. No rows give no rows. Extra columns pass through.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.llm.shared import connected_components, lean, prepare, small, stored, without_ids
from marketmill.llm.text import Words, chunks, constants, gram_hashes, mix

SHINGLE = 5
PERCENT = 75
HASHES = 128
TREES = 16
#: Members of a node, and shingles of all of them, that are compared exhaustively in one task.
LEAF = 4096
LEAF_SHINGLES = 4_000_000
#: Levels that larger nodes branch before they are dealt into cells. Members that part there are not compared in that node again, so any level costs recall.
MAX_DEPTH = 0
#: Equal minwise values that a pair must have to be confirmed: five standard deviations below the threshold.
LEAST_EQUAL = math.floor(HASHES * PERCENT / 100 - 5 * math.sqrt(HASHES * PERCENT / 100 * (1 - PERCENT / 100)))
#: Candidates that a document brings into the first confirmations; what they leave apart is compared in whole.
BEST = 4
BROADCAST_IDS = 1_000_000


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The set of each text, as sorted distinct 64-bit hashes."""
    words = Words([t.lower() for t in texts])
    grams, ranges = words.grams(SHINGLE)
    out = []
    for k in range(len(texts)):
        n = words.bounds[k + 1] - words.bounds[k]
        if n >= SHINGLE:
            out.append(np.unique(grams[ranges[k]:ranges[k + 1]]))
        else:
            out.append(gram_hashes(words.hashes[words.bounds[k]:words.bounds[k + 1]], int(n), 29 + int(n)) if n else np.empty(0, np.uint64))
    return out


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """A row of HASHES minwise values for each non-empty set."""
    every = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), HASHES), np.uint64)
    for j, c in enumerate(constants(HASHES, 41)):
        out[:, j] = np.minimum.reduceat(every * c, starts)
    return mix(out)


def children(nodes: np.ndarray, values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The chosen tokens of each row's node and the child that its value names: (which rows, their children)."""
    rows = np.arange(len(nodes))
    choice = mix(nodes + np.uint64(0x632BE59BD9B4E019))
    first = (choice % np.uint64(HASHES)).astype(np.int64)
    second = (first + 1 + ((choice >> np.uint64(16)) % np.uint64(HASHES - 1)).astype(np.int64)) % HASHES
    both = np.flatnonzero((choice >> np.uint64(40)) % np.uint64(3) == 0)
    child = lambda at, token: mix(nodes[at] * np.uint64(3) + mix(values[at, token[at]].astype(np.uint64) * np.uint64(HASHES) + token[at].astype(np.uint64)))
    return [(rows, child(rows, first)), (both, child(both, second))]


def root_nodes(values: np.ndarray) -> list[np.ndarray]:
    """For each row the nodes at depth two of all trees."""
    owners, found = [], []
    for tree in range(TREES):
        root = np.full(len(values), mix(np.array([tree + 1], np.uint64))[0])
        for at, below in children(root, values):
            for again, node in children(below, values[at]):
                owners.append(at[again])
                found.append(node)
    owner, node = np.concatenate(owners), np.concatenate(found)
    order = np.argsort(owner, kind="stable")
    return np.split(node[order].view(np.int64), np.searchsorted(owner[order], np.arange(1, len(values))))


_SIGNATURE = "id long, n_shingles long, key1 long, key2 long, sketch binary, nodes array<long>"


def _plain(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: size and key of its set, one byte of each minwise value, and its nodes."""

    def run(batches):
        schema = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("key1", pa.int64()), ("key2", pa.int64()), ("sketch", pa.binary()), ("nodes", pa.list_(pa.int64()))])
        for batch in batches:
            for held in chunks(zip(batch.column(1).to_pylist(), batch.column(0).to_pylist())):
                sets = shingle_sets([t for t, _ in held])
                full = [k for k, s in enumerate(sets) if len(s)]
                sketches, nodes = [b""] * len(sets), [[]] * len(sets)
                if full:
                    values = minwise([sets[k] for k in full])
                    for k, v, n in zip(full, values.astype(np.uint8), root_nodes(values)):
                        sketches[k], nodes[k] = v.tobytes(), n
                keys = [[int(mix(s * c).sum(dtype=np.uint64).view(np.int64)) for s in sets] for c in constants(2, 43)]
                yield pa.RecordBatch.from_arrays([pa.array([i for _, i in held], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys[0], pa.int64()), pa.array(keys[1], pa.int64()), pa.array(sketches, pa.binary()), pa.array(nodes, pa.list_(pa.int64()))], schema=schema)

    return _plain(docs, id_col, text_col).mapInArrow(lean(run), _SIGNATURE)


def full_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, items: the sets of the given ids (stored). A list of ids small by count is broadcast, a longer one joined."""
    few = ids.count() <= BROADCAST_IDS

    def run(batches):
        for batch in small(batches):
            for held in chunks(zip(batch.column(1).to_pylist(), batch.column(0).to_pylist())):
                yield pa.RecordBatch.from_arrays([pa.array([i for _, i in held], pa.int64()), pa.array([s.tobytes() for s in shingle_sets([t for t, _ in held])], pa.binary())], ["id", "items"])

    texts = _plain(docs, id_col, text_col).where("id is not null")
    return stored(texts.join(F.broadcast(ids) if few else ids, "id", "left_semi").mapInArrow(lean(run), "id long, items binary"), "near-sets")


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets are as similar as links ask."""
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b whose full sets are similar."""

    def run(batches):
        for batch in small(batches):
            left, right = (batch.column(i).to_pylist() for i in (2, 3))
            ok = pa.array([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(left, right)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], ["a", "b"])

    left = sets.select(F.col("id").alias("a"), F.col("items").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("right"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right").mapInArrow(lean(run), "a long, b long")


def star_candidates(crowd: DataFrame, sketches: DataFrame) -> DataFrame:
    """Each member of a node with the node's smallest, where their minwise values allow a link."""

    def run(batches):
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, HASHES) for i in (2, 3))
            ok = pa.array((left == right).sum(axis=1) >= LEAST_EQUAL)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], ["a", "b"])

    pairs = crowd.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    left = sketches.select(F.col("id").alias("a"), F.col("sketch").alias("left"))
    right = sketches.select(F.col("id").alias("b"), F.col("sketch").alias("right"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right").mapInArrow(lean(run), "a long, b long")


def contested(rows: DataFrame) -> DataFrame:
    """Rows (node, id, component, ...) of the nodes with two or more components, with the parts that are small enough to compare."""
    parts = F.greatest(F.ceil(F.count("*") / LEAF), F.ceil(F.sum("size") / LEAF_SHINGLES)) if "size" in rows.columns else F.lit(1)
    stats = rows.groupBy("node").agg(parts.cast("long").alias("parts"), F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("node", "parts")
    return rows.drop("parts").join(stats, "node")


def branch(rows: DataFrame) -> DataFrame:
    """Rows node, id, component, sketch, size one level down."""

    def run(batches):
        for batch in batches:
            nodes = batch.column(0).to_numpy().view(np.uint64)
            values = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, HASHES)
            for at, child in children(nodes, values):
                if len(at):
                    take = pa.array(at)
                    yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), *(batch.column(i).take(take) for i in (1, 2, 3, 4))], ["node", "id", "component", "sketch", "size"])

    return rows.select("node", "id", "component", "sketch", "size").mapInArrow(lean(run), "node long, id long, component long, sketch binary, size long")


def dealt(large: DataFrame) -> DataFrame:
    """node, id, sketch: nodes too large for one task in cells, in one of which any two members of different components meet.

    A cell is a block of members outside the node's largest component with a
    block of all members. Members of the largest component need not meet each
    other, so they come once for each block of the others.
    """
    sums = large.groupBy("node", "component").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"))
    of_node = sums.groupBy("node").agg(F.max(F.struct("n", "component", "shingles")).alias("most"), F.sum("n").alias("n"), F.sum("shingles").alias("shingles"))
    # Blocks of half a leaf, so that a cell is about as large as a leaf.
    halves = lambda n, shingles: F.greatest(F.lit(1), F.ceil(2 * n / LEAF), F.ceil(2 * shingles / LEAF_SHINGLES)).cast("long")
    blocks = of_node.select("node", F.col("most.component").alias("main"), halves(F.col("n") - F.col("most.n"), F.col("shingles") - F.col("most.shingles")).alias("outer"), halves(F.col("n"), F.col("shingles")).alias("all"))
    i, j = F.pmod(F.xxhash64("id", F.lit(1)), "outer"), F.pmod(F.xxhash64("id", F.lit(2)), "all")
    row = F.transform(F.sequence(F.lit(0).cast("long"), F.col("all") - 1), lambda k: i * F.col("all") + k)
    column = F.transform(F.sequence(F.lit(0).cast("long"), F.col("outer") - 1), lambda k: k * F.col("all") + j)
    cells = F.when(F.col("component") != F.col("main"), F.array_union(row, column)).otherwise(column)
    rows = large.select("node", "id", "component", "sketch").join(blocks, "node").select("node", "id", "sketch", F.explode(cells).alias("cell"))
    return rows.select(F.xxhash64("node", "cell").alias("node"), "id", "sketch")


def leaves(rows: DataFrame) -> DataFrame:
    """node, id, sketch: contested nodes that are small as they are, the others dealt into cells, after MAX_DEPTH levels of branching."""
    done = []
    for depth in range(MAX_DEPTH + 1):
        rows = stored(contested(rows), "near-nodes")
        done.append(rows.where("parts = 1").select("node", "id", "sketch"))
        large = rows.where("parts > 1")
        if large.isEmpty():
            break
        if depth == MAX_DEPTH:
            done.append(dealt(large))
            break
        rows = branch(large)
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def _groups(batches):
    """Node, ids, components, sketches and full sets (if there) of one node after another, from batches sorted by node."""
    held, last = [], None

    def full(parts):
        sketch = np.frombuffer(b"".join(x for p in parts for x in p[2]), np.uint8).reshape(-1, HASHES)
        return last, np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), sketch, [x for p in parts for x in p[3]]

    for batch in batches:
        node, ids, component = (batch.column(i).to_numpy() for i in range(3))
        cuts = [0, *(np.flatnonzero(node[1:] != node[:-1]) + 1).tolist(), len(node)]
        for s, e in zip(cuts, cuts[1:]):
            if s == e:
                continue
            if held and node[s] != last:
                yield full(held)
                held = []
            last = node[s]
            held.append((ids[s:e], component[s:e], *(batch.column(i).slice(s, e - s).to_pylist() if i < batch.num_columns else [] for i in (3, 4))))
    if held:
        yield full(held)


def _ordered(rows: DataFrame, *more: str) -> DataFrame:
    """The rows with each node whole in one partition, one node after another.

    Spark leaves out a repartition by the key of the join below it, and may then
    read that join's shuffle in parts of a key. One by a hash of the key stays.
    """
    return rows.select("node", "id", "component", "sketch", *more).repartition(F.xxhash64("node")).sortWithinPartitions("node", "id")


def outside_largest(component: np.ndarray) -> list[int]:
    """Places of the members outside a node's largest component."""
    names, sizes = np.unique(component, return_counts=True)
    return np.flatnonzero(component != names[np.argmax(sizes)]).tolist()


def best_near(x: int, component: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Places of the BEST members of other components that may be linked with member x."""
    equal = (sketch == sketch[x]).sum(axis=1)
    equal[component == component[x]] = 0
    near = np.flatnonzero(equal >= LEAST_EQUAL)
    return near[np.argsort(-equal[near], kind="stable")[:BEST]]


def candidates(rows: DataFrame) -> DataFrame:
    """Pairs of different components of a node that may be linked, the BEST of each document outside the node's largest component."""

    def run(batches):
        for _, ids, component, sketch, _ in _groups(batches):
            a, b = [], []
            for x in outside_largest(component):
                near = best_near(x, component, sketch)
                a.append(np.minimum(ids[x], ids[near]))
                b.append(np.maximum(ids[x], ids[near]))
            if a and sum(map(len, a)):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return _ordered(rows).mapInArrow(lean(run), "a long, b long").distinct()


def open_members(component: np.ndarray, before: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Which members of a node a pair of different components keeps open that `candidates` did not take by the components before."""
    taken: dict[int, list[int]] = {}
    for x in outside_largest(before):
        for y in best_near(x, before, sketch).tolist():
            taken.setdefault(x, []).append(y)
            taken.setdefault(y, []).append(x)
    needed = np.zeros(len(component), bool)
    for x in outside_largest(component):
        near = ((sketch == sketch[x]).sum(axis=1) >= LEAST_EQUAL) & (component != component[x])
        near[taken.get(x, [])] = False
        if near.any():
            needed[x] = True
            needed |= near
    return needed


def still_open(rows: DataFrame) -> DataFrame:
    """node, id, component, sketch of the open members of rows node, id, component, before, sketch.

    Nodes that leave the same members open come as one, named by their ids.
    """

    def run(batches):
        for _, ids, component, sketch, before in _groups(batches):
            needed = open_members(component, np.array(before), sketch)
            if needed.any():
                n = int(needed.sum())
                name = int.from_bytes(hashlib.blake2b(ids[needed].tobytes(), digest_size=8).digest(), "little", signed=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, name)), pa.array(ids[needed]), pa.array(component[needed]), pa.array([s.tobytes() for s in sketch[needed]], pa.binary())], ["node", "id", "component", "sketch"])

    return _ordered(rows, "before").mapInArrow(lean(run), "node long, id long, component long, sketch binary").distinct()


def gathered(rest: DataFrame, sketches: DataFrame) -> DataFrame:
    """The open members with nodes that share members as one, so that a set is brought once; nodes of what is too large for one task stay."""
    heads = rest.groupBy("node").agg(F.min("id").alias("first"))
    groups = stored(connected_components(rest.join(heads, "node").select(F.col("first").alias("a"), F.col("id").alias("b"))).toDF("id", "group"), "near-groups")
    size = F.sum(F.col("size").cast("double"))
    fits = groups.join(sketches.select("id", "size"), "id").groupBy("group").agg(F.count("*").alias("n"), size.alias("size")).where((F.col("n") <= LEAF) & (F.col("size") <= LEAF_SHINGLES)).select("group")
    named = rest.join(groups.join(fits, "group").select("id", F.xxhash64("group", F.lit("group")).alias("group")), "id", "left")
    return named.select(F.coalesce("group", "node").alias("node"), "id", "component", "sketch").distinct()


def compare_members(ids: np.ndarray, component: np.ndarray, items: list[np.ndarray]):
    """Links between components among the members of one node, by their full sets, as few as connect them."""
    sizes = np.array([len(s) for s in items])
    every, owner = np.concatenate(items), np.repeat(np.arange(len(items)), sizes)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    names, label, counts = np.unique(component, return_inverse=True, return_counts=True)
    for x in np.flatnonzero(label != np.argmax(counts)).tolist():
        low, high = np.searchsorted(every, items[x], "left"), np.searchsorted(every, items[x], "right")
        n = high - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        common = np.bincount(owner[at], minlength=len(ids))
        for y in np.flatnonzero(100 * common >= PERCENT * (sizes[x] + sizes - common)).tolist():
            if label[y] != label[x]:
                yield int(min(ids[x], ids[y])), int(max(ids[x], ids[y]))
                label[label == label[y]] = label[x]


def confirm_members(rows: DataFrame) -> DataFrame:
    """Links a, b between components of the nodes of rows node, id, component, sketch, items."""

    def run(batches):
        for _, ids, component, _, items in _groups(batches):
            links = list(compare_members(ids, component, [np.frombuffer(x, np.uint64) for x in items]))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*links)], ["a", "b"])

    return _ordered(rows, "items").mapInArrow(lean(run), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component (smallest id that links reach), kept (whether that is its own)."""
    prepare(docs.sparkSession)
    every = stored(signatures(docs, id_col, text_col), "near-signatures")
    classes = stored(every.where("n_shingles > 0 and id is not null").groupBy("key1", "key2", "n_shingles").agg(F.min("id").alias("first")), "near-classes")
    single = every.join(classes.select(F.col("first").alias("id")).distinct(), "id", "left_semi").where("n_shingles > 0")
    sketches = single.select("id", "sketch", F.col("n_shingles").alias("size"))
    rows = single.select(F.explode("nodes").alias("node"), "id")
    counts = rows.groupBy("node").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1").select("node", "first")
    crowd = stored(rows.join(counts, "node"), "near-crowd")

    pairs = stored(star_candidates(crowd, sketches), "near-stars")
    sets = full_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), id_col, text_col)
    links = stored(confirm(pairs, sets), "near-links")
    components = stored(connected_components(links), "near-components")

    def with_components(table: DataFrame) -> DataFrame:
        joined = table.join(components.withColumnRenamed("node", "id"), "id", "left")
        return joined.withColumn("component", F.coalesce("component", "id"))

    open_nodes = contested(with_components(crowd.select("node", "id"))).select("node", "id", "component")
    compared = stored(leaves(open_nodes.join(sketches, "id")), "near-leaves")
    def needed(ids: DataFrame) -> DataFrame:
        more = stored(ids.distinct().join(sets.select("id"), "id", "left_anti"), "near-ids")
        return sets.union(full_sets(docs, more, id_col, text_col))

    first_seen = with_components(compared)
    # What the first confirmations decided is not asked again.
    fresh = stored(candidates(contested(first_seen)).join(pairs, ["a", "b"], "left_anti"), "near-pairs")
    sets = needed(fresh.select(F.explode(F.array("a", "b")).alias("id")))
    links = links.union(stored(confirm(fresh, sets), "near-links"))
    components = stored(connected_components(links), "near-components")

    rest = stored(still_open(contested(with_components(first_seen.withColumnRenamed("component", "before")))), "near-open")
    if not rest.isEmpty():
        sets = needed(rest.select("id"))
        links = links.union(stored(confirm_members(gathered(rest, sketches).join(sets, "id")), "near-links"))
        components = stored(connected_components(links), "near-components")

    named = classes.join(components.withColumnRenamed("node", "first"), "first", "left").select("key1", "key2", "n_shingles", F.coalesce("component", "first").alias("component"))
    out = every.join(named, ["key1", "key2", "n_shingles"], "left").select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the smallest id of their component, all columns."""
    return without_ids(docs, id_col, near_duplicates(docs, id_col, text_col).where("not kept").select("id"))


def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its set, its component, and whether it stays."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")
