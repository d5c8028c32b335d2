"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document's set is its distinct shingles of five words. Equal sets are one class. Each of ``TREES``
trees orders the classes by its own sequence of ``DEPTH`` MinHash values; the orders are range
partitioned, so that no region of equal values has to fit into one task. Neighbours whose longest
common prefix is at least ``LEAST_DEPTH`` values form a region.

In a first round, windows of the sorted order, half overlapping, give a spanning forest of the most
similar pairs whose signatures agree enough, which is confirmed on full sets. So large groups cost
links in proportion to their size. The second round leaves nothing out: every region that still
holds several components is compared whole by signatures. In one of up to ``WINDOW`` classes the
pairs that agree enough are confirmed; a denser one is dealt into blocks, each pair of blocks is
compared, and the classes with a partner that agrees enough meet again, block by block, with their
full sets. No pair is taken as linked without its sets.
Classes none of whose prefixes is shared do not get so far.

Defined cases: upper-case A-Z count as lower-case; fewer than five words are one shingle of all of
them; texts without words, null ones too, have the empty set, are linked to nothing and are their
own component; repeated rows are members each; a null identifier is never the smallest of a group
that has another, and stays if it is alone; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortum.llm.common import pieces, texts
from cohortum.llm.components import components
from cohortum.llm.wordcache import give_back, release
from cohortum.sources.tables import materialise

SHINGLE, TREES, DEPTH, LEAST_DEPTH, WINDOW = 5, 10, 12, 2, 256
BLOCK, SET_BYTES, TEXT_BYTES = 2048, 8 << 20, 2 << 20
PLAUSIBLE = 0.6  # about four deviations of the estimate under the similarity of 0.75
SHARE, OF = 75, 100
HASHES = TREES * DEPTH
# A-Z in lower case, and white space as spaces.
PLAIN = bytes(32 if 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))
SIGNED = "doc_id bigint, n_shingles bigint, node bigint, labels binary, brief binary"

_noise = np.random.default_rng(20)
MULTIPLIERS = _noise.integers(1, 2**63, size=HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADDENDS = _noise.integers(0, 2**63, size=HASHES, dtype=np.uint64)
PLACES = _noise.integers(1, 2**63, size=SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(column: pa.Array) -> Iterator[np.ndarray]:
    """Hashes of the words of each text. Only distinct words become objects; none is remembered."""
    import pyarrow

    column = column.fill_null("").cast(pyarrow.large_binary())
    _, offsets, content = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    content = content.slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes() if content else b""
    offsets, content = offsets - offsets[0], np.frombuffer(content.translate(PLAIN), np.uint8)
    filled = content != 32
    # Places of the first and last bytes of words, which end with their text at the latest.
    inner = offsets[(offsets > 0) & (offsets < len(content))]
    first, last = filled.copy(), filled.copy()
    first[1:] &= ~filled[:-1]
    last[:-1] &= ~filled[1:]
    first[inner], last[inner - 1] = filled[inner], filled[inner - 1]
    first, last = np.flatnonzero(first), np.flatnonzero(last)
    ends = np.concatenate([[0], np.cumsum(last + 1 - first)]).astype(np.int64)
    words = pyarrow.Array.from_buffers(
        pyarrow.large_binary(), len(first), [None, pyarrow.py_buffer(ends), pyarrow.py_buffer(content[filled])]
    ).dictionary_encode()
    hashes = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words.dictionary.to_pylist())), np.uint64)
    hashes = hashes[words.indices.to_numpy()]
    cuts = np.searchsorted(first, offsets).tolist()
    for low, high in zip(cuts, cuts[1:]):
        yield hashes[low:high]


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text, as 64-bit hashes."""
    for words in word_hashes(column):
        size = min(len(words), SHINGLE)
        if not size:
            yield np.zeros(0, np.uint64)
            continue
        ends = len(words) - size + 1
        mixed = np.full(ends, size, dtype=np.uint64)
        for place in range(size):
            mixed += words[place : place + ends] * PLACES[place]
        mixed ^= mixed >> np.uint64(31)
        yield np.unique(mixed * np.uint64(0x9E3779B97F4A7C15))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over the set."""
    least = np.full(HASHES, 2**32 - 1, dtype=np.uint64)
    for start in range(0, len(shingles), 1024):
        some = shingles[start : start + 1024, None] * MULTIPLIERS + ADDENDS
        least = np.minimum(least, some.min(axis=0) >> np.uint64(32))
    return least.astype(np.uint32)


def node_of(shingles: np.ndarray) -> int:
    return int.from_bytes(xxhash.xxh3_128_digest(shingles.tobytes())[:8], "big", signed=True)


def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, class and signature of each document; ``brief`` has a byte of each value."""
    release()  # what earlier steps of a pipeline remember here
    for batch in pieces(batches, TEXT_BYTES):
        sizes, nodes, labels, brief = [], [], [], []
        for shingles in shingle_sets(batch["text"]):
            sizes.append(len(shingles))
            values = signature(shingles) if len(shingles) else None
            nodes.append(node_of(shingles) if len(shingles) else None)
            labels.append(None if values is None else values.astype(">u4").tobytes())
            brief.append(None if values is None else values.astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                pa.array(labels, pa.binary()), pa.array(brief, pa.binary()),
            ],
            [x.split(" ")[0] for x in SIGNED.split(", ")],
        )


def agreement(brief: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Estimated similarity of each of ``brief`` to each of ``others``."""
    equal = np.zeros((len(brief), len(others)), dtype=np.uint8)  # up to HASHES
    for column, other in zip(np.ascontiguousarray(brief.T), np.ascontiguousarray(others.T)):
        equal += column[:, None] == other
    return (equal / HASHES - 1 / 256) / (1 - 1 / 256)


def forest_edges(similar: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of most similar plausible pairs."""
    size = len(similar)
    found = set()
    best, via = np.full(size, -1.0), np.zeros(size, dtype=int)
    outside = np.ones(size, dtype=bool)
    for _ in range(size):
        at = int(np.where(outside, best, -2).argmax())
        if best[at] >= PLAUSIBLE:
            found.add((min(at, via[at]), max(at, via[at])))
        outside[at] = False
        closer = outside & (similar[at] > best)
        best[closer], via[closer] = similar[at][closer], at
    return list(found)


def windows(labels: np.ndarray) -> Iterator[tuple[int, int]]:
    """Windows of a sorted order of label sequences, within regions of a common prefix."""
    if not len(labels):
        return
    same = (labels[1:, :LEAST_DEPTH] == labels[:-1, :LEAST_DEPTH]).all(axis=1)
    cuts = np.concatenate([[0], np.flatnonzero(~same) + 1, [len(labels)]])
    for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if end - start <= WINDOW:
            if end - start > 1:
                yield start, end
            continue
        for first in range(start, end - WINDOW // 2, WINDOW // 2):
            yield first, min(end, first + WINDOW)


def columns(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    import pyarrow

    tables = [b for b in batches if b.num_rows]
    return pyarrow.Table.from_batches(tables) if tables else None


def fixed(table: pa.Table, name: str, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), kind).reshape(-1, width)


def runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and end of each run of equal values."""
    ends = np.concatenate([[0], np.flatnonzero(np.diff(values)) + 1, [len(values)]]).tolist()
    return zip(ends[:-1], ends[1:])


def as_pairs(found: set[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in found], pa.int64()), pa.array([p[1] for p in found], pa.int64())], ["a", "b"]
    )


def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs to confirm first, from the sorted orders of a partition."""
    if (whole := columns(batches)) is None:
        return
    node, labels, brief = whole["node"].to_numpy(), fixed(whole, "own", ">u4", DEPTH), fixed(whole, "brief", "u1", HASHES)
    out: set[tuple[int, int]] = set()
    for low, high in runs(whole["tree"].to_numpy()):
        for start, end in windows(labels[low:high]):
            ids, own = node[low + start : low + end], brief[low + start : low + end]
            similar = agreement(own, own)
            np.fill_diagonal(similar, -1)
            for a, b in forest_edges(similar):
                out.add((min(int(ids[a]), int(ids[b])), max(int(ids[a]), int(ids[b]))))
    yield as_pairs(out)


def all_left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All plausible pairs of different components in whole regions of up to ``WINDOW`` classes."""
    if (whole := columns(batches)) is None:
        return
    node, root, brief = whole["node"].to_numpy(), whole["root"].to_numpy(), fixed(whole, "brief", "u1", HASHES)
    out: set[tuple[int, int]] = set()
    for start, end in runs(whole["prefix"].to_numpy()):
        ids, roots = node[start:end], root[start:end]
        similar = agreement(brief[start:end], brief[start:end])
        similar[roots[:, None] == roots] = -1
        for a, b in np.argwhere(np.triu(similar >= PLAUSIBLE)).tolist():
            out.add((min(int(ids[a]), int(ids[b])), max(int(ids[a]), int(ids[b]))))
    yield as_pairs(out)


def sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows to compare, of the two blocks or of one with itself.

    The first ones leave out the most frequent component where a block meets itself: of a pair of
    different components at least one is not in it.
    """
    part, i, j = table["part"].to_numpy(), table["i"][0].as_py(), table["j"][0].as_py()
    if i != j:
        return np.flatnonzero(part == i), np.flatnonzero(part == j)
    names, which, times = np.unique(table["root"].to_numpy(), return_inverse=True, return_counts=True)
    return np.flatnonzero(which != times.argmax()), np.arange(len(part))


def plausible(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of the first places, the second places, and which of their pairs are plausible."""
    one, other = sides(table)
    root, brief = table["root"].to_numpy(), fixed(table, "brief", "u1", HASHES)
    for start in range(0, len(one), 256):
        some = one[start : start + 256]
        if len(other):
            yield some, other, (agreement(brief[some], brief[other]) >= PLAUSIBLE) & (root[some][:, None] != root[other])


def partnered(table: pa.Table) -> pa.Table:
    """The classes of two blocks of a dense region that have a plausible partner in them."""
    found = np.zeros(table.num_rows, dtype=bool)
    for some, other, agree in plausible(table):
        found[some] |= agree.any(axis=1)
        found[other] |= agree.any(axis=0)
    return table.select(["prefix", "node"]).filter(pa.array(found))


def links_of_sets(table: pa.Table) -> pa.Table:
    """Links between components of two blocks of a dense region, on full sets.

    Of the pairs that are similar enough, those are left out that others here already connect.
    """
    import pyarrow

    node, root = table["node"].to_numpy(), table["root"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
    sizes = np.array([len(x) for x in sets])
    # Only shingles that two sets have can be common; the sets in terms of them, end to end.
    known, which, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    ends = np.concatenate([[0], np.cumsum(times[which] > 1)])[np.concatenate([[0], np.cumsum(sizes)])]
    which = which[times[which] > 1]
    group = np.unique(root, return_inverse=True)[1]
    mark, out = np.zeros(len(known), dtype=bool), []
    for some, other, agree in plausible(table):
        for at, row in zip(some.tolist(), agree):
            near = other[row]
            near = near[group[near] != group[at]]
            if not len(near):
                continue
            mark[which[ends[at] : ends[at + 1]]] = True
            lengths = ends[near + 1] - ends[near]
            starts = np.cumsum(lengths) - lengths
            places = np.arange(lengths.sum()) + np.repeat(ends[near] - starts, lengths)
            common = np.concatenate([[0], np.cumsum(mark[which[places]])])
            common = common[starts + lengths] - common[starts]
            mark[which[ends[at] : ends[at + 1]]] = False
            for to in near[OF * common >= SHARE * (sizes[at] + sizes[near] - common)].tolist():
                if group[to] != group[at]:
                    out.append((int(node[at]), int(node[to])))
                    group[group == group[to]] = group[at]
    return pyarrow.Table.from_batches([as_pairs(set(out))])


def in_blocks(rows: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """Rows of regions with blocks of about ``most`` in ``size``, once for each pair of blocks."""
    count = F.ceil(F.col("size") / most)
    part = F.pmod(F.xxhash64("prefix", "node"), F.col("blocks"))
    return (
        rows.join(sizes.select("prefix", count.alias("blocks")), "prefix").withColumn("part", part)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("part", "with"), "j": F.greatest("part", "with")})
        .drop("with", "blocks")
    )


def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, TEXT_BYTES):
        sets = list(shingle_sets(batch["text"]))
        yield pa.RecordBatch.from_arrays(
            [
                batch["node"], pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ],
            ["node", "true_node", "shingles"],
        )


def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets are similar enough."""
    for batch in batches:
        keep = []
        for one, other in zip(batch["one"], batch["other"]):
            x, y = np.frombuffer(one.as_py(), np.uint64), np.frombuffer(other.as_py(), np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(OF * common >= SHARE * (len(x) + len(y) - common))
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("one"))
    other = sets.select(F.col("node").alias("b"), F.col("shingles").alias("other"))
    return pairs.join(one, "a").join(other, "b").select("a", "b", "one", "other").mapInArrow(
        confirmed, "a bigint, b bigint"
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Set size, component and whether it stays, for every document."""
    rows = texts(docs)
    documents = materialise(rows.mapInArrow(signed, SIGNED))
    classes = materialise(
        documents.where("node IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("id"), F.first("labels").alias("labels"), F.first("brief").alias("brief")
        )
    )
    place = F.col("tree") * (4 * DEPTH) + 1
    trees = classes.select(
        "node", "labels", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    ).select("node", "tree", F.xxhash64("tree", F.substring("labels", place, 4 * LEAST_DEPTH)).alias("prefix"))
    # Classes that share a prefix with another; both sides are stored, for a frequent prefix.
    trees = materialise(trees)
    shared = materialise(trees.groupBy("prefix").agg(F.count("*").alias("n")).where("n > 1").select("prefix"))
    met = materialise(trees.join(shared, "prefix").select("node", "prefix"))
    involved = materialise(met.select("node").distinct())
    few = materialise(classes.join(involved, "node"))
    kinds = "node bigint, true_node bigint, shingles binary"
    true_sets = lambda rows: rows.select("node", "text").mapInArrow(with_sets, kinds)
    standing = few.select(F.col("id").alias("doc_id"), "node")
    # A text without identifier stands for its class only if all of the class are such.
    unnamed = true_sets(rows.where("doc_id IS NULL").withColumn("node", F.lit(None).cast("bigint")))
    sets = materialise(
        true_sets(rows.join(standing, "doc_id")).where("node = true_node").select("node", "shingles")
        .unionByName(
            unnamed.select(F.col("true_node").alias("node"), "shingles")
            .join(standing.where("doc_id IS NULL"), "node", "left_semi")
        )
        .dropDuplicates(["node"])
    )

    ordered = few.select(
        "node", "brief", "labels", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    ).select("tree", F.substring("labels", place, 4 * DEPTH).alias("own"), "node", "brief")
    first = materialise(
        ordered.repartitionByRange("tree", "own", "node").sortWithinPartitions("tree", "own", "node")
        .mapInArrow(candidates, "a bigint, b bigint").distinct()
    )
    links = materialise(confirm(first, sets))
    roots = components(links)
    # Regions that hold several components, in full.
    of = materialise(
        few.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "brief")
    )
    rooted = materialise(met.join(of.select("node", "root"), "node"))
    mixed = materialise(
        rooted.groupBy("prefix").agg(F.count("*").alias("size"), F.min("root").alias("x"), F.max("root").alias("y"))
        .where("x < y").select("prefix", "size")
    )
    thin, dense = mixed.where(F.col("size") <= WINDOW), mixed.where(F.col("size") > WINDOW)
    left = materialise(
        rooted.join(thin.select("prefix"), "prefix").join(of.select("node", "brief"), "node")
        .select("prefix", "node", "root", "brief")
        .repartition("prefix").sortWithinPartitions("prefix").mapInArrow(all_left, "a bigint, b bigint").distinct()
        .join(first, ["a", "b"], "left_anti")
    )
    more = materialise(confirm(left, sets))
    pair = ["prefix", "i", "j"]
    partners = materialise(
        in_blocks(rooted, dense, BLOCK).join(of.select("node", "brief"), "node")
        .groupBy(*pair).applyInArrow(lambda t: give_back(partnered(t)), "prefix bigint, node bigint").distinct()
    )
    held = materialise(partners.join(of, "node").join(sets, "node"))
    size = materialise(held.groupBy("prefix").agg(F.sum(F.length("shingles")).alias("size")))
    most = materialise(in_blocks(held, size, SET_BYTES).groupBy(*pair).applyInArrow(lambda t: give_back(links_of_sets(t)), "a bigint, b bigint"))
    known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = components(known.unionByName(more).unionByName(most))
    known = classes.select("node", "id").join(roots, "node", "left")
    known = materialise(known.select("node", "id", F.coalesce("root", "node").alias("root")))
    smallest = materialise(known.groupBy("root").agg(F.min("id").alias("component_id")))
    component = materialise(known.join(smallest, "root").select("node", "component_id"))
    return documents.select("doc_id", "n_shingles", "node").join(component, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows, unchanged, that stay; of several rows of an identifier all stay if one does.

    Rows without identifier stay.
    """
    gone = near_duplicates(docs).groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).where("NOT kept")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"))
    return rows.join(gone.select("doc_id"), "doc_id", "left_anti").select("row.*")
