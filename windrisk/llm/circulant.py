"""Near-duplicates by circulant MinHash, banding and exact verification.

Signature: a first permutation sigma scatters the shingles of a document over the 32-bit circle, a second one, pi, is turned
by k steps for coordinate k: h_k = min over shingles of pi(sigma(x) - k * STEP mod 2**32). So two permutations give all 128
coordinates. 32 bands of 4 coordinates miss a pair of similarity 0.75 with chance (1 - 0.75**4)**32 = 5e-6.

1. Documents with equal shingle sets fold into one class, keyed by a 128-bit hash of the set.
2. Classes meet in buckets (equal band). The smallest class of a bucket is its centre; a class proposes one edge, to the
   centre that it shares most bands with. Edges are verified on full shingle sets and joined to components.
3. Only buckets that still hold several components go on. Their classes form clusters (classes that share such buckets); a cluster
of at most CLUSTER classes is compared as a whole, a larger one bucket by bucket, and a bucket with more than BLOCK classes outside of its
largest component is cut by further bands, which keep linked pairs together with chance 1 - 8e-6, at last compared as it is. All comparing is done
in block pairs of bounded size, by a prefix filter over the shingles (32 bits of each): two similar sets meet in their rarest
quarter, so sets that share a common passage only are never paired; the intersections of those that meet are counted whole. In a crowd all are
compared with its most common members first. Members of the largest component are never compared with each other. A block pair returns the edges that join components, at most one for each join
besides those too close to call at 32 bits. They are verified on full sets as well. No similar pair is ever dropped.

So a group of a million near copies costs a million edges, not their square. No bucket, component or shingle set of
the corpus is collected; all joins on hot keys are between stored tables, which AQE can split.

Defined results: NULL and empty texts, and texts without words, have no shingles, stay alone and are kept. Of a
component the row with the smallest id stays; a row with a NULL id stays only if no row of its component has an id.
Repeated rows have equal results. An empty table gives an empty result.
"""

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrisk.llm.common import small_or_shuffled, stored, table
from windrisk.llm.components import components
from windrisk.llm.shingles import mix64, shingle_sets

BANDS, ROWS = 32, 4
COORDINATES = BANDS * ROWS
STEP = np.uint32(0x9E3779B1)
SHARE = (3, 4)  # similarity of at least 3 / 4
# Classes and shingles of a cluster that is compared as a whole, and of a block.
CLUSTER, BLOCK, CUTS = 1 << 16, 8192, 3
CLUSTER_SHINGLES, BLOCK_SHINGLES = 1 << 24, 1 << 20
FOLD_BITS = 32
TOGETHER, PAIRS = 4 << 20, 1 << 21  # bytes of small block pairs compared together, pairs looked at together
HUBS, CROWD = 4, 64  # rows that all others of a block pair are compared with first, if it has so many
MARK_BITS = 26


def signatures(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Signatures (documents x coordinates) of non-empty shingle sets, which stand one after another."""
    starts = np.cumsum(counts) - counts
    turned = (mix64(shingles) >> np.uint64(32)).astype(np.uint32)  # sigma, turned by one more step for each coordinate
    x, high = np.empty_like(turned), np.empty_like(turned)
    out = np.empty((COORDINATES, len(counts)), dtype=np.uint32)
    with np.errstate(over="ignore"):
        for k in range(COORDINATES):
            # pi, a permutation of the 32-bit integers
            np.bitwise_xor(turned, np.right_shift(turned, np.uint32(16), out=high), out=x)
            np.multiply(x, np.uint32(0x7FEB352D), out=x)
            np.bitwise_xor(x, np.right_shift(x, np.uint32(15), out=high), out=x)
            np.multiply(x, np.uint32(0x846CA68B), out=x)
            np.minimum.reduceat(x, starts, out=out[k])
            turned -= STEP
    return np.ascontiguousarray(out.T)


def _groups(lengths: list[int], most: int = 1 << 16) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, n in enumerate(lengths):
        size += n
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(lengths):
        yield start, len(lengths)


def _sets_of(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Begin, end, shingles and counts of runs of texts."""
    raw = texts.cast(pa.binary()).to_pylist()
    for a, b in _groups([len(t) // 6 if t else 0 for t in raw]):
        yield a, b, *shingle_sets(raw[a:b])


def _cut_at(shingles: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The bytes of each set."""
    ends = np.cumsum(counts) * shingles.itemsize
    raw = shingles.tobytes()
    return [raw[a:b] for a, b in zip((ends - counts * shingles.itemsize).tolist(), ends.tolist())]


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, text_hash, n_shingles, node (hash of the shingle set, NULL for an empty one), bands (its bucket keys)."""
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    schema = T.StructType([source.schema["id"], source.schema["text_hash"], T.StructField("n_shingles", T.LongType()),
                           T.StructField("node", T.BinaryType()), T.StructField("bands", T.BinaryType())])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, shingles, counts in _sets_of(batch.column("text")):
                full = counts > 0
                rows = iter(_band_keys(signatures(shingles, counts[full]))) if full.any() else iter(())
                nodes = [xxhash.xxh3_128_digest(s) if s else None for s in _cut_at(shingles, counts)]
                marks = [next(rows).tobytes() if node else None for node in nodes]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), batch.column("text_hash").slice(a, b - a), pa.array(counts, pa.int64()),
                     pa.array(nodes, pa.binary()), pa.array(marks, pa.binary())], names=schema.names)

    return source.mapInArrow(sketch, schema)


def _band_keys(signature: np.ndarray) -> np.ndarray:
    """Bucket keys (rows x bands) of a signature matrix."""
    with np.errstate(over="ignore"):
        wide = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64)
        keys = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
        keys = np.repeat(keys, len(signature), axis=0)
        for r in range(ROWS):
            keys = mix64(keys ^ wide[:, :, r])
    return keys.view(np.int64)


def _keys(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.int64).reshape(len(column), BANDS)


def _shared_buckets(classes: DataFrame) -> DataFrame:
    """(bucket, node) of the buckets that hold several classes, and of few others.

    Buckets are counted by their keys alone. The keys of crowded ones set bits in a bitmap of at most 2**MARK_BITS; only classes
    of marked buckets are dealt out. A full bitmap lets more through, and loses none."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_keys(batch.column("bands")).ravel(), pa.int64())], names=["bucket"])

    crowds = stored(classes.select("bands").mapInArrow(keys, "bucket long").groupBy("bucket").count().where("count > 1").select("bucket"), "crowds")
    bits = min(MARK_BITS, max(15, (16 * crowds.count()).bit_length()))
    place = F.shiftrightunsigned("bucket", 64 - bits)
    marks = np.zeros(1 << bits - 3, dtype=np.uint8)
    for row in crowds.groupBy(F.shiftright(place, 15).alias("page")).agg(
            F.bitmap_construct_agg(place.bitwiseAND(32767)).alias("marks")).toLocalIterator():
        marks[row.page * 4096:(row.page + 1) * 4096] = np.frombuffer(row.marks, dtype=np.uint8)
    shared = classes.sparkSession.sparkContext.broadcast(marks)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                buckets = _keys(batch.column("bands")).ravel()
                at = buckets.view(np.uint64) >> np.uint64(64 - bits)
                held = np.flatnonzero(shared.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1)
                yield pa.RecordBatch.from_arrays([pa.array(buckets[held]), batch.column("node").take(pa.array(held // BANDS))], names=["bucket", "node"])

    return stored(classes.select("node", "bands").mapInArrow(deal, "bucket long, node binary"), "dealt-buckets")


def _shingle_sets(nodes: DataFrame, docs: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles) of the given nodes, from one text of each class."""
    needed = stored(nodes.join(classes.select("node", "rep_id"), "node"), "needed")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ids = small_or_shuffled(stored(needed.select("rep_id").distinct(), "needed-ids"), 16)
    texts = texts.join(ids, F.col("id").eqNullSafe(F.col("rep_id")), "left_semi")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, shingles, counts in _sets_of(batch.column("text")):
                sets = [s for s in _cut_at(shingles, counts) if s]
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()),
                                                  pa.array(sets, pa.binary())], names=["node", "shingles"])

    # A node may come from several rows with one id; only needed nodes go on, each once.
    sets = stored(texts.select("text").mapInArrow(shingled, "node binary, shingles binary")
                  .join(needed.select("node"), "node", "left_semi").dropDuplicates(["node"]), "shingle-sets")
    if not needed.join(sets.select("node"), "node", "left_anti").isEmpty():
        raise RuntimeError("classes without a shingle set")
    return sets


def _verified(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """The edges (a, b) whose full shingle sets are similar enough."""
    left = sets.withColumnsRenamed({"node": "a", "shingles": "x"})
    right = sets.withColumnsRenamed({"node": "b", "shingles": "y"})
    top, bottom = SHARE

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, y = None, None
        for batch in batches:
            keep = []
            for first, second in zip(batch.column("x"), batch.column("y")):
                x, raw = np.frombuffer(first.as_py(), dtype=np.uint64), second.as_py()
                if raw != last:
                    last, y = raw, np.frombuffer(raw, dtype=np.uint64)
                if bottom * min(len(x), len(y)) < top * max(len(x), len(y)):
                    keep.append(False)
                    continue
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int(np.count_nonzero(y[at] == x))
                keep.append(bottom * both >= top * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return edges.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(verify, "a binary, b binary")


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle sets folded to FOLD_BITS bits a shingle, four bytes each."""
    for batch in batches:
        sizes, folded = [], []
        for raw in batch.column("shingles"):
            shingles = np.frombuffer(raw.as_py(), dtype=np.uint64)
            short = (shingles >> np.uint64(64 - FOLD_BITS)).astype("<u4")  # sorted, as the shingles are
            sizes.append(len(shingles))
            folded.append(short[np.diff(short, prepend=~short[:1]) != 0].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sizes, pa.int64()), pa.array(folded, pa.binary())],
                                         names=["s_node", "size", "folded"])


class _Sets:
    """Folded sets of some block pairs, the rarest shingles of a block pair first in each set."""

    def __init__(self, pair: np.ndarray, folded: list[bytes]):
        self.lengths = np.fromiter((len(f) // 4 for f in folded), dtype=np.int64, count=len(folded))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.owner = np.repeat(np.arange(len(folded)), self.lengths)
        keys = pair.astype(np.uint64)[self.owner] << np.uint64(32) | np.frombuffer(b"".join(folded), dtype="<u4").astype(np.uint64)
        known, at, counts = np.unique(keys, return_inverse=True, return_counts=True)
        rarest = np.argsort(counts, kind="stable")
        rank = np.empty_like(rarest)
        rank[rarest] = np.arange(len(rarest))
        self.n_ranks = len(known)
        self.shared = int(np.count_nonzero(counts < 2))  # ranks from here on stand in several sets
        placed = self.owner * self.n_ranks + rank[at]
        placed.sort()
        self.ranks = placed - self.owner * self.n_ranks
        self.counts = counts[rarest][self.ranks]
        self.position = np.arange(len(placed)) - self.starts[self.owner]

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the given sets, one after another, and where each begins."""
        lengths = self.lengths[rows]
        begins = np.cumsum(lengths) - lengths
        return self.ranks[np.repeat(self.starts[rows] - begins, lengths) + np.arange(lengths.sum())], begins


def _candidates(sets: _Sets, sizes: np.ndarray, kinds: np.ndarray, is_main: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (left, right) that may be similar enough, sorted by left; a row of a largest component is never left.

    Of a set with n shingles more than n / 4 can't be missing in a similar one, so the rarest n // 4 + 1 of two similar sets meet. At the
    place where they first do, enough must be left in both. `apart`: rows of one value there are not compared, unless it is -1."""
    top, bottom = SHARE
    lost = sizes - sets.lengths
    head = np.flatnonzero((sets.ranks >= sets.shared) & (sets.position <= (sizes - -(-sizes * top // bottom))[sets.owner]))
    head = head[np.lexsort((sizes[sets.owner[head]], sets.ranks[head]))]
    owner, rank = sets.owner[head], sets.ranks[head]
    # What two sets can share at most when they first meet here, and the largest set that this is enough for.
    left_over = (sets.lengths[sets.owner] - sets.position)[head] + lost[owner]
    most = np.minimum((top + bottom) * left_over // top - sizes[owner], bottom * sizes[owner] // top)
    least = -(-top * sizes[owner] // bottom)
    step = int(sizes.max(initial=0)) * 2 + 2
    place = rank * step + sizes[owner]
    rest, main = np.flatnonzero(~is_main[owner]), np.flatnonzero(is_main[owner])
    found = []
    for others in (rest, main):
        begins = np.searchsorted(place[others], rank[rest] * step + least[rest])
        ends = np.searchsorted(place[others], rank[rest] * step + np.maximum(most[rest], -1), side="right")
        if others is rest:  # each pair once, from its larger set
            ends = np.minimum(ends, np.arange(len(rest)))
        sums = np.cumsum(later := np.maximum(ends - begins, 0))
        a = 0
        while a < len(rest):
            b = max(a + 1, int(np.searchsorted(sums, (sums[a - 1] if a else 0) + PAIRS, side="right")))
            n = later[a:b]
            first = np.repeat(np.arange(a, b), n)
            second = others[np.repeat(begins[a:b] - np.cumsum(n) + n, n) + np.arange(len(first))]
            first, a = rest[first], b
            x, y = owner[first], owner[second]
            keep = (kinds[x] != kinds[y]) & ((apart[x] != apart[y]) | (apart[x] < 0)) & (sizes[x] <= most[second])
            found.append(np.unique(x[keep] * len(sizes) + y[keep]))
    pairs = np.unique(np.concatenate(found)) if found else np.empty(0, dtype=np.int64)
    return pairs // len(sizes), pairs % len(sizes)


class _Links:
    """Edges found between the components of some rows, and which of these are joined by them for sure."""

    def __init__(self, sets: _Sets, sizes: np.ndarray, kinds: np.ndarray):
        self.sets, self.sizes, self.kinds = sets, sizes, kinds
        self.label = np.arange(kinds.max(initial=-1) + 1)
        self.mark = np.zeros(sets.n_ranks, dtype=bool)
        self.edges: list[tuple[int, int]] = []

    def of(self, rows: np.ndarray) -> np.ndarray:
        return self.label[self.kinds[rows]]

    def compare(self, i: int, waiting: np.ndarray) -> None:
        """Row i with the others that are not in its component."""
        top, bottom = SHARE
        sets, sizes, label = self.sets, self.sizes, self.label
        own = sets.ranks[sets.starts[i]:sets.starts[i] + sets.lengths[i]]
        self.mark[own] = True
        while len(waiting := waiting[self.of(waiting) != label[self.kinds[i]]]):
            now, waiting = waiting[:64], waiting[64:]
            ranks, begins = sets.of(now)
            both = np.add.reduceat(self.mark[ranks], begins, dtype=np.int64)
            others = sizes[now]
            # Common shingles that fold together count once in `both`; at most so many are lost.
            most = both + np.minimum(sizes[i] - sets.lengths[i], others - sets.lengths[now])
            linked = np.flatnonzero(bottom * most >= top * (sizes[i] + others - most))
            # Shingles that only agree when folded might lift a pair over the limit; such a pair is returned, but joins nothing here.
            slack = 1 + (8 * sizes[i] * others[linked] >> FOLD_BITS)
            less = np.maximum(both[linked] - slack, 0)
            sure = bottom * less >= top * (sizes[i] + others[linked] - less)
            for j, safe in sorted(zip(now[linked].tolist(), sure.tolist()), key=lambda js: (not js[1], js[0])):
                mine, its = label[self.kinds[i]], label[self.kinds[j]]
                if mine != its:
                    self.edges.append((i, j))
                    if safe:
                        label[label == max(mine, its)] = min(mine, its)
        self.mark[own] = False


def _largest(pair: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Whether a row is in the largest component of its block pair."""
    counted, at, counts = np.unique(pair * (kinds.max() + 1) + kinds, return_inverse=True, return_counts=True)
    pairs = counted // (kinds.max() + 1)
    order = np.lexsort((counts, pairs))
    return np.isin(at, order[np.append(np.diff(pairs[order]) > 0, True)])


def _compare(members: pd.DataFrame) -> pd.DataFrame:
    """Edges between different components of block pairs (`group`, `low`, `high`; one if these columns are missing).

    `part` tells the sides of a block pair, one side is compared with itself."""
    if "group" not in members:
        members = members.assign(group=0, low=members["part"].min(), high=members["part"].max())
    members = members.drop_duplicates(["group", "low", "high", "node", "part"])
    pair = members.groupby(["group", "low", "high"], sort=False).ngroup().to_numpy()
    sizes = members["size"].to_numpy()
    apart = np.where(members["low"] == members["high"], -1, members["part"].to_numpy())
    sets = _Sets(pair, members["folded"].tolist())
    links = _Links(sets, sizes, pd.factorize(members["component"])[0])
    everyone = np.arange(len(members))
    # Most of a crowd of near copies are similar to one that has few shingles of its own.
    common = np.add.reduceat(sets.counts, sets.starts, dtype=np.float64) / sets.lengths
    for crowd in np.flatnonzero(np.bincount(pair) >= CROWD):
        rows = np.flatnonzero(pair == crowd)
        rows = rows[np.argsort(-common[rows], kind="stable")]
        tried: set[int] = set()
        for hub in rows.tolist():
            if len(tried) == HUBS:
                break
            if int(links.label[links.kinds[hub]]) not in tried:
                fits = SHARE[1] * np.minimum(sizes[rows], sizes[hub]) >= SHARE[0] * np.maximum(sizes[rows], sizes[hub])
                links.compare(hub, rows[fits & ((apart[rows] != apart[hub]) | (apart[rows] < 0))])
                tried.add(int(links.label[links.kinds[hub]]))
    kinds = links.of(everyone)
    lefts, rights = _candidates(sets, sizes, kinds, _largest(pair, kinds), apart)
    for begin, end in itertools.pairwise([*np.flatnonzero(np.diff(lefts, prepend=-1)).tolist(), len(lefts)]):
        links.compare(int(lefts[begin]), rights[begin:end])
    nodes = members["node"].to_numpy()
    return pd.DataFrame({"a": [nodes[i] for i, _ in links.edges], "b": [nodes[j] for _, j in links.edges]})


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of block pairs whose rows come one after another; small block pairs are compared together."""
    def edges(rows: pa.Table) -> pa.RecordBatch:
        found = _compare(rows.to_pandas())
        return pa.RecordBatch.from_arrays([pa.array(found[c], pa.binary()) for c in ("a", "b")], names=["a", "b"])

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("folded").nbytes
        if size >= TOGETHER:
            rows = pa.Table.from_batches(held)
            keys = np.stack([rows.column(c).to_numpy() for c in ("group", "low", "high")])
            ends = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))
            if len(ends):
                yield edges(rows.slice(0, ends[-1] + 1))
                held = rows.slice(ends[-1] + 1).to_batches()
                size = sum(b.column("folded").nbytes for b in held)
    if held:
        rows = pa.Table.from_batches(held)
        if len(rows):
            yield edges(rows)


def _shapes(placed: DataFrame) -> DataFrame:
    """Per group of several components: its largest component, and members and shingles in it (`most`, `most_sh`) and outside of it (`rest`, `rest_sh`)."""
    counts = placed.groupBy("group", "component").agg(F.count("*").alias("n"), F.sum("size").alias("sh"))
    return stored(counts.groupBy("group").agg(F.sum("n").alias("all"), F.sum("sh").alias("all_sh"), F.max(F.struct("n", "component", "sh")).alias("largest"),
                                              F.count("*").alias("kinds"))
                  .where("kinds > 1").select(F.col("group").alias("s_group"), (F.col("all") - F.col("largest.n")).alias("rest"),
                                             (F.col("all_sh") - F.col("largest.sh")).alias("rest_sh"), F.col("largest.n").alias("most"),
                                             F.col("largest.sh").alias("most_sh"), F.col("largest.component").alias("main")), "tail-groups")


def _block_edges(placed: DataFrame, shapes: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges between the components of each group, found in pairs of blocks."""
    is_main = F.col("component") == F.col("main")
    # The rest is cut into blocks of its own, and so is the largest component, which never meets itself. A small group is one block.
    one = (F.col("rest") + F.col("most") <= BLOCK) & (F.col("rest_sh") + F.col("most_sh") <= BLOCK_SHINGLES)
    blocks = lambda n, sh: F.greatest(F.ceil(F.col(n) / F.lit(BLOCK)), F.ceil(F.col(sh) / F.lit(BLOCK_SHINGLES)))
    n_rest, n_main = blocks("rest", "rest_sh"), blocks("most", "most_sh")
    block_of = lambda n: F.pmod(F.xxhash64("node"), n)
    zero = F.lit(0).cast("long")
    own = F.when(one, zero).when(is_main, block_of(n_main) + n_rest).otherwise(block_of(n_rest)).cast("long")
    met = F.when(one, F.array(zero)).when(is_main, F.sequence(zero, n_rest - 1)).otherwise(F.sequence(zero, n_rest + n_main - 1))
    crowd = placed.join(shapes, F.col("group") == F.col("s_group")).withColumn("own", own)
    folded = sets.mapInArrow(_folded, "s_node binary, size long, folded binary")
    dealt = crowd.select("group", "node", "component", "own", F.explode(met).alias("other")).join(folded, F.col("node") == F.col("s_node"))
    dealt = dealt.select("group", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), F.col("own").alias("part"),
                         "node", "component", folded["size"], "folded")
    keys = ["group", "low", "high"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_block_pairs, "a binary, b binary")


def _cut(placed: DataFrame, classes: DataFrame) -> DataFrame:
    """The members of each group dealt out to groups that agree in one more band."""
    def cut_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                keys = _keys(batch.column("bands")).view(np.uint64)
                old = batch.column("group").to_numpy().view(np.uint64)
                with np.errstate(over="ignore"):
                    keys = mix64(keys ^ (old[:, None] * np.uint64(0xD6E8FEB86659FD93))).view(np.int64)
                at = pa.array(np.repeat(np.arange(len(batch)), BANDS))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *(batch.column(c).take(at) for c in ("node", "component", "size"))],
                                                 names=["group", "node", "component", "size"])

    marks = classes.select(F.col("node").alias("c_node"), "bands")
    return placed.join(marks, F.col("node") == F.col("c_node")).select("group", "node", "component", "size", "bands").mapInArrow(
        cut_again, "group long, node binary, component binary, size long")


def _tail_edges(members: DataFrame, classes: DataFrame, sets: DataFrame, found: DataFrame) -> DataFrame | None:
    """Edges between components that share buckets, or None if no bucket has several components."""
    sized = sets.select(F.col("node").alias("f_node"), F.floor(F.length("shingles") / 8).alias("size"))
    labels = sized.join(found, F.col("f_node") == F.col("node"), "left").select("f_node", "size", "component")
    placed = stored(members.join(labels, F.col("node") == F.col("f_node")).select(
        F.col("bucket").alias("group"), "node", F.coalesce("component", "node").alias("component"), "size", "centre"), "placed")
    buckets = _shapes(placed)
    if buckets.isEmpty():
        return None
    tail = stored(placed.join(buckets.select("s_group"), F.col("group") == F.col("s_group"), "left_semi"), "tail")
    clusters = components(tail.where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")))
    clusters = clusters.select(F.col("node").alias("k_node"), F.col("component").alias("cluster"))
    whole = stored(tail.select("node", "component", "size").distinct().join(clusters, F.col("node") == F.col("k_node"), "left").select(
        F.xxhash64(F.coalesce("cluster", "node")).alias("group"), "node", "component", "size"), "clusters")
    shapes = _shapes(whole)
    small = (F.col("rest") + F.col("most") <= CLUSTER) & (F.col("rest_sh") + F.col("most_sh") <= CLUSTER_SHINGLES)
    edges = _block_edges(whole, shapes.where(small), sets)
    large = shapes.where(~small)
    if not large.isEmpty():
        wide = whole.join(large, F.col("group") == F.col("s_group"), "left_semi").select(F.col("node").alias("w_node"))
        parts = stored(tail.join(wide, F.col("node") == F.col("w_node"), "left_semi").select("group", "node", "component", "size"), "wide")
        for cut in range(CUTS + 1):
            shapes = _shapes(parts)
            if cut == CUTS:
                edges = edges.unionByName(_block_edges(parts, shapes, sets))
                break
            edges = edges.unionByName(_block_edges(parts, shapes.where(F.col("rest") <= BLOCK), sets))
            crowded = shapes.where(F.col("rest") > BLOCK)
            if crowded.isEmpty():
                break
            parts = stored(_cut(parts.join(crowded, F.col("group") == F.col("s_group"), "left_semi"), classes), "cut")
    return stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "tail-edges")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, text_hash (xxhash64), n_shingles, component_id, kept."""
    rows = stored(sketches(docs, id_col, text_col), "sketches")
    classes = stored(rows.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("rep_id"), F.first("bands").alias("bands")), "classes")
    buckets = _shared_buckets(classes)
    crowds = stored(buckets.groupBy(F.col("bucket").alias("c_bucket")).agg(F.min("node").alias("centre"), F.count("*").alias("n"))
                    .where("n > 1").drop("n"), "centres")
    members = stored(buckets.join(crowds, F.col("bucket") == F.col("c_bucket")).select("bucket", "node", "centre"), "members")
    best = F.max(F.struct(F.col("n"), F.col("b")))
    edges = stored(members.where("node <> centre").groupBy(F.col("node").alias("a"), F.col("centre").alias("b"))
                   .agg(F.count("*").alias("n")).groupBy("a").agg(best.alias("best")).select("a", F.col("best.b").alias("b")), "star-edges")
    # Every class that shares a bucket: it proposes an edge or is a centre, maybe one that all its mates pass over for another.
    sets = _shingle_sets(members.select("node").distinct(), docs, classes, id_col, text_col)
    links = stored(_verified(edges, sets), "links")
    found = components(links)
    more = _tail_edges(members, classes, sets, found)
    if more is not None:
        more = stored(_verified(more, sets), "links")
        if not more.isEmpty():
            found = components(links.unionByName(more))
    labels = found.select(F.col("node").alias("f_node"), "component")
    placed = stored(classes.select("node", "rep_id").join(labels, F.col("node") == F.col("f_node"), "left")
                    .select("node", "rep_id", F.coalesce("component", "node").alias("component")), "placed-classes")
    least = stored(placed.groupBy(F.col("component").alias("l_component")).agg(F.min("rep_id").alias("component_id")), "least")
    named = stored(placed.join(least, F.col("component") == F.col("l_component")).select(F.col("node").alias("p_node"), "component_id"), "named")
    joined = rows.select("id", "text_hash", "n_shingles", "node").join(named, F.col("node") == F.col("p_node"), "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select("id", "text_hash", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("id").eqNullSafe(F.col("component_id")))


def op4_circulant_minhash(spark, sf_dir):
    return near_groups(table(spark, sf_dir, "documents")).drop("text_hash").withColumnRenamed("id", "doc_id")
