"""Conversation prefix trie by fixed-length block hashing.

A conversation's first d turns have a prefix key: the sums of eight 32-bit lanes of SHA-256(position, turn digest), hashed
again. Sums add up in any order, so keys of very long conversations come from sums of ranges and no task walks through one.

Blocks first: conversations are grouped by their key at every block end (each BLOCK turns, and where they end). A group sends
one representative, its smallest id, with the group's size. Where one block follows a prefix, all its turns are nodes with that
group's numbers; only where several blocks follow the same prefix are the turns of their representatives grouped again.

Sums over subtrees need no walk down: the nodes whose smallest member is c are the end of c's own path, so each subtree sum
is a sum over members of one number for each conversation, taken by blocks in the same way.

Defined results: rows without conv_id belong to no conversation; remainders of negative ids are negative, as in SQL. NULL role or text is empty. Turns are ordered by
turn, NULL first; equal turns by role, then by SHA-256 of the text. Repeated rows are turns of their own. Empty texts have no
words. An empty table gives no node, not even a root. Very long texts and conversations are bounded by one row and by RANGE.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrisk.llm.common import n_words, stored, table

BLOCK = 4
RANGE = 4096  # rows of one conversation, or ids of one list, that a task orders at once
LANES = 8
FAMILY, MOST_SHARED = 20, 4  # Fixed values of the contract.
ROOT = "root"


def _digest(*parts: Column) -> Column:
    """Binary SHA-256 of texts whose lengths are told too, so that no two lists of parts run together."""
    return F.unhex(F.sha2(F.concat(*[F.concat(F.octet_length(p).cast("string"), F.lit(":"), p) for p in parts]), 256))


def turns_of(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv, turn, role, tie, digest, words) without the texts."""
    rows = conversations.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("conv IS NOT NULL")
    return rows.select("conv", "turn", "role", F.unhex(F.sha2("text", 256)).alias("tie"), _digest(F.col("role"), F.col("text")).alias("digest"),
                       n_words(F.col("text")).alias("words"))


def numbered(turns: DataFrame, most: int = RANGE) -> DataFrame:
    """`turns` with `pos` from 1 in the order of a conversation.

    Conversations of more than `most` rows are dealt into ranges of the order by range partitioning, numbered inside
    each range and shifted by the counts of the ranges before. A third of all rows in one conversation is no hot task.
    """
    order = [F.col("turn").asc_nulls_first(), "role", "tie"]
    long = stored(turns.groupBy("conv").count().where(F.col("count") > most).select("conv"), "trie-long")
    short = turns
    if not long.isEmpty():
        short = turns.join(long, "conv", "left_anti")
    plain = short.withColumn("pos", F.row_number().over(Window.partitionBy("conv").orderBy(*order)))
    if long.isEmpty():
        return plain
    # Equal rows are interchangeable; a hash of where they stood lets even those be cut.
    spread = turns.join(long, "conv", "left_semi").withColumn("cut", F.monotonically_increasing_id())
    ranged = stored(spread.repartitionByRange(F.col("conv"), *order, "cut").withColumn("part", F.spark_partition_id()), "trie-ranged")
    counts = ranged.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("conv", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    local = ranged.withColumn("local", F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order, "cut")))
    placed = local.join(shift, ["conv", "part"]).withColumn("pos", (F.col("local") + F.col("shift")).cast("int"))
    return plain.unionByName(placed.select(*turns.columns, "pos"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, d, digest, words) of the rebuilt conversations, and one row with d = 0 for every conversation.

    Conversation c takes the first h turns of conversation c - c % FAMILY, then its own turns after its first h; h = crc32 of
    its decimal id, modulo MOST_SHARED.
    """
    lengths = turns.groupBy("conv").agg(F.max("pos").alias("len"))
    base = F.col("conv") - F.col("conv") % FAMILY
    share = (F.crc32(F.col("conv").cast("string").cast("binary")) % MOST_SHARED).cast("int")
    plans = lengths.select("conv", "len", base.alias("base"), share.alias("h"))
    heads = lengths.where(F.col("conv") % FAMILY == 0).select(F.col("conv").alias("base"), F.col("len").alias("base_len"))
    plans = stored(plans.join(heads, "base", "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("base_len", F.lit(0))).alias("taken")), "trie-plans")
    first = turns.where((F.col("conv") % FAMILY == 0) & (F.col("pos") < MOST_SHARED)).select(F.col("conv").alias("base"), "pos", "digest", "words")
    shared = (plans.join(first, "base").where(F.col("pos") <= F.col("h"))
              .select("conv", F.col("pos").alias("d"), "digest", "words"))
    own = (turns.join(plans, "conv").where(F.col("pos") > F.col("h"))
           .select("conv", (F.col("pos") - F.col("h") + F.col("taken")).cast("int").alias("d"), "digest", "words"))
    starts = plans.select("conv", F.lit(0).alias("d"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("words"))
    return shared.unionByName(own).unionByName(starts)


def running_sums(rows: DataFrame, key: str, pos: str, columns: list[str], fan: int = RANGE) -> DataFrame:
    """`rows` with `columns` summed up to their position (0, 1, ...) within `key`; (key, pos) is unique.

    Sums run inside ranges of `fan` positions; the totals of the ranges are summed up in the same way, so that no task
    orders more than `fan` rows of a key, however long it is.
    """
    step = f"{pos}_range"
    ranged = rows.withColumn(step, F.floor(F.col(pos) / F.lit(fan)).cast("int"))
    inside = Window.partitionBy(key, step).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumns({c: F.sum(c).over(inside) for c in columns})
    if ranged.where(F.col(step) > 0).isEmpty():
        return local.drop(step)
    totals = stored(ranged.groupBy(key, step).agg(*[F.sum(c).alias(c) for c in columns]), "trie-totals")
    upto = running_sums(totals, key, step, columns, fan)
    before = upto.select(key, (F.col(step) + 1).alias(step), *[F.col(c).alias(f"before_{c}") for c in columns])
    joined = local.join(before, [key, step], "left")
    return joined.withColumns({c: F.col(c) + F.coalesce(f"before_{c}", F.lit(0)) for c in columns}).select(*rows.columns)


def prefixes(turns: DataFrame, fan: int = RANGE) -> DataFrame:
    """(conv, d, key, before_key, words, words_before): every prefix of every rebuilt conversation; the root has key ROOT."""
    lane = [f"lane{i}" for i in range(LANES)]
    spelled = F.sha2(F.concat(F.col("d").cast("string").cast("binary"), F.encode(F.lit(":"), "UTF-8"), "digest"), 256)
    rows = turns.withColumn("mixed", spelled)
    parts = {name: F.coalesce(F.conv(F.substring("mixed", 8 * i + 1, 8), 16, 10).cast("long"), F.lit(0)) for i, name in enumerate(lane)}
    rows = rows.select("conv", "d", "words", *[c.alias(f"own_{n}") for n, c in parts.items()]).withColumns({n: F.col(f"own_{n}") for n in lane})
    summed = running_sums(rows.withColumn("upto", F.col("words")), "conv", "d", [*lane, "upto"], fan)

    def key(depth: Column, columns: list[Column]) -> Column:
        return F.when(depth <= 0, F.lit(ROOT)).otherwise(F.sha2(F.concat_ws(",", depth.cast("string"), *[c.cast("string") for c in columns]), 256))

    return summed.select("conv", "d", key(F.col("d"), [F.col(n) for n in lane]).alias("key"),
                         key(F.col("d") - 1, [F.col(n) - F.col(f"own_{n}") for n in lane]).alias("before_key"),
                         "words", (F.col("upto") - F.col("words")).alias("words_before"))


def _list_digest(members: DataFrame, span: int = RANGE) -> DataFrame:
    """(key, conv) -> (key, ends_sha256): SHA-256 of the ids, ascending and joined by commas.

    Ids are joined in ranges of `span` ids first. A node with one range is hashed at once; for others the ranges are
    streamed in order through the hash, since SHA-256 has no other way.
    """
    import hashlib

    import pyarrow as pa

    ranged = members.groupBy("key", F.floor(F.col("conv") / F.lit(span)).cast("long").alias("range")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    ranged = stored(ranged, "trie-ends")
    several = ranged.groupBy("key").agg(F.count("*").alias("n"), F.first("ids").alias("ids"))
    one = several.where("n = 1").select("key", F.sha2("ids", 256).alias("ends_sha256"))
    wide = ranged.join(several.where("n > 1").select("key"), "key", "left_semi")

    def stream(batches):
        key, state, done = None, None, []
        for batch in batches:
            for name, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if name != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = name, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done])], names=["key", "ends_sha256"])
                done = []
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    streamed = wide.repartition("key").sortWithinPartitions("key", "range").select("key", "ids").mapInArrow(stream, "key string, ends_sha256 string")
    return one.unionByName(streamed)


def trie(conversations: DataFrame, block: int = BLOCK, most: int = RANGE, **columns) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = stored(numbered(stored(turns_of(conversations, **columns), "trie-turns"), most), "trie-numbered")
    paths = stored(prefixes(stored(rebuilt(turns), "trie-rebuilt"), most), "trie-paths")
    last = paths.groupBy("conv").agg(F.max("d").alias("last"), F.sum("words").alias("total"))
    last = stored(last, "trie-last")
    number = F.floor((F.col("d") - 1) / F.lit(block)).cast("int")
    steps = paths.where("d > 0").withColumn("block", number)

    # Every conversation at its block ends, grouped by the key there.
    marks = steps.where(F.col("d") % block == 0).select("conv", "block", "key")
    ends = last.where(F.col("last") % block != 0).select("conv", F.col("last").alias("d"))
    marks = stored(marks.unionByName(steps.join(ends, ["conv", "d"]).select("conv", "block", "key")), "trie-marks")
    groups = marks.groupBy("block", F.col("key").alias("end_key")).agg(F.count("*").alias("n"), F.min("conv").alias("conv"))
    # One representative for each group; its first turn in the block tells the prefix that the block follows.
    taken = stored(steps.join(groups, ["conv", "block"]), "trie-taken")
    entry = taken.where((F.col("d") - 1) % block == 0).select("end_key", F.col("before_key").alias("from_key"))
    siblings = entry.groupBy("from_key").agg(F.count("*").alias("n_blocks"))
    lone = entry.join(siblings.where("n_blocks = 1"), "from_key", "left_semi").select("end_key")
    # Alone behind its prefix: the turns of a block are nodes as they are.
    straight = taken.join(lone, "end_key", "left_semi").select("key", "before_key", "d", "words", "words_before", "conv", "n")
    refined = (taken.join(lone, "end_key", "left_anti").groupBy("key", "before_key", "d", "words", "words_before")
               .agg(F.min("conv").alias("conv"), F.sum("n").alias("n")))
    top = last.agg(F.lit(ROOT).alias("key"), F.lit("").alias("before_key"), F.lit(0).alias("d"), F.lit(0).cast("long").alias("words"),
                   F.lit(0).cast("long").alias("words_before"), F.min("conv").alias("conv"), F.count("*").alias("n")).where("n > 0")
    nodes = stored(straight.unionByName(refined).unionByName(top), "trie-nodes")

    children = nodes.where("d > 0").groupBy(F.col("before_key").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "trie-counted")
    # What a conversation adds to every node that it is a member of.
    owners = nodes.groupBy("conv").agg(F.min_by("words_before", "d").alias("shared"), F.max(F.col("n_children") == 0).cast("int").alias("leaf"))
    added = stored(last.join(owners, "conv", "left").select(
        "conv", "total", F.coalesce(F.col("total") - F.col("shared"), F.lit(0)).alias("own"), F.coalesce("leaf", F.lit(0)).alias("leaf")), "trie-added")
    sums = [F.sum(c).alias(c) for c in ("total", "own", "leaf")]
    by_block = marks.join(added, "conv").groupBy(F.col("key").alias("end_key")).agg(*sums)
    in_blocks = taken.select("end_key", "key").join(by_block, "end_key").groupBy("key").agg(*sums)
    at_root = added.agg(F.lit(ROOT).alias("key"), *sums)
    sizes = in_blocks.unionByName(at_root)

    represented = added.select("conv", F.col("total").alias("rep_total"), F.col("own").alias("rep_own"))
    parents = nodes.select(F.col("key").alias("before_key"), F.col("conv").alias("parent_conv_id"))
    digests = _list_digest(paths.join(last.select("conv", F.col("last").alias("d")), ["conv", "d"]).select("key", "conv"), most)
    saved = (F.col("total") - F.col("n") * F.col("words_before")
             - (F.col("own") - F.col("rep_own") + F.col("rep_total") - F.col("words_before")))
    return (nodes.join(sizes, "key").join(represented, "conv").join(parents, "before_key", "left").join(digests, "key", "left")
            .select(F.col("conv").alias("conv_id"), F.col("d").cast("long").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"),
                    "n_children", F.col("leaf").cast("long").alias("n_leaves"), saved.cast("long").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))


def op11_prefix_trie(spark, sf_dir):
    return trie(table(spark, sf_dir, "conversations"))


# Every turn adds 64 characters to a path, so that a node lies below another one if its path starts with the other's.
OP11_SQL = """
WITH RECURSIVE clean AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos,
         sha256(strlen(role) || ':' || role || text) AS dig,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM clean),
crc(i, v) AS (
  SELECT i::BIGINT, list_reduce([i::BIGINT] || range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
  FROM range(256) t(i)),
digits(c, rest, state) AS (
  SELECT DISTINCT c, c::VARCHAR, 4294967295::BIGINT FROM numbered
  UNION ALL
  SELECT d.c, d.rest[2:], xor(d.state >> 8, crc.v)
  FROM digits d JOIN crc ON crc.i = xor(d.state, ascii(d.rest[1])) & 255 WHERE d.rest <> ''),
plan AS (SELECT c, xor(state, 4294967295) % 4 AS h, c - c % 20 AS base FROM digits WHERE rest = ''),
sized AS (
  SELECT p.c, p.h, p.base, least(p.h, coalesce((SELECT max(pos) FROM numbered n WHERE n.c = p.base), 0)) AS taken FROM plan p),
seq AS (
  SELECT s.c, n.pos AS d, n.dig, n.words FROM sized s JOIN numbered n ON n.c = s.base AND n.pos <= s.h
  UNION ALL
  SELECT s.c, n.pos - s.h + s.taken, n.dig, n.words FROM sized s JOIN numbered n ON n.c = s.c AND n.pos > s.h),
prefix AS (
  SELECT c, d, words, string_agg(dig, '') OVER (PARTITION BY c ORDER BY d) AS path FROM seq
  UNION ALL
  SELECT c, 0, 0, '' FROM sized),
lengths AS (SELECT c, max(d) AS last FROM prefix GROUP BY c),
node AS (SELECT path, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n, any_value(words) AS words FROM prefix GROUP BY path),
tree AS (
  SELECT v.path, count(u.path) FILTER (WHERE u.depth = v.depth + 1) AS n_children,
         count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM node x WHERE x.depth = u.depth + 1 AND x.path[1:64 * u.depth] = u.path)) AS n_leaves,
         sum((u.n - 1) * u.words) AS saved_tokens
  FROM node v JOIN node u ON starts_with(u.path, v.path) GROUP BY v.path),
ended AS (
  SELECT p.path, string_agg(p.c::VARCHAR, ',' ORDER BY p.c) AS ids FROM prefix p JOIN lengths l ON l.c = p.c AND l.last = p.d GROUP BY p.path)
SELECT v.conv_id, v.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, v.n AS n_convs, t.n_children, t.n_leaves,
       t.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM node v JOIN tree t USING (path) LEFT JOIN node up ON up.depth = v.depth - 1 AND up.path = v.path[1:64 * (v.depth - 1)]
LEFT JOIN ended e USING (path)
"""
