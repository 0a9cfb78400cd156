"""Prefix trie of conversations as a z-fast trie: compacted nodes, found by fat binary search over their handles.

A conversation is a sequence of turns (role, text). Its prefix of d turns is named by d and two 64-bit hashes, running
exclusive-ors of the hashes of its turns and their places. The trie is compacted: a node is a prefix at which sequences
end or part, and it keeps the names along its edge from its parent's depth to its own (`above` to `depth`). Its
handle is the prefix whose length is the number divisible by the highest power of two on that edge (the two-fattest one).

Distinct sequences are inserted in `BATCHES` batches. Each first finds where it leaves the trie: a binary search that
always tries the two-fattest length left and looks the prefix up among the handles, so it takes as many joins as a length
has bits, for all sequences of the batch at once; the names along one edge then tell the exact depth. Edges are split where
sequences leave them; what lies beyond is grouped by name, and becomes nodes where the new sequences end or part. At the end
edges are expanded to one row per depth.

Turns are ordered by number (null first), ties by role and text, so repeated rows are repeated turns. Null roles and
texts are empty. Rows without a conv_id are no conversation. A conversation all of whose turns are replaced by nothing
counts at the root. An empty table gives an empty result. Other columns are not read. The names of one
conversation, 24 bytes a turn, are one row; its texts are not. Negative ids have a negative remainder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import WORD, Scratch, arrow, parts

GROUP = 20
HEADS = 4
#: Shares of the distinct sequences, in eighths; the trie doubles from batch to batch.
BATCHES = (1, 2, 5)
IDS_AT_ONCE = 1 << 16
NAME = "struct<p:bigint,q:bigint,s:bigint>"
NO_ENDS = hashlib.sha256(b"").hexdigest()


def at(names: Column, depth: Column) -> Column:
    """Name of the prefix of `depth` turns; the empty prefix is all zero."""
    zero = F.lit(0).cast("long")
    return F.when(depth > 0, F.get(names, (depth - 1).cast("int"))).otherwise(
        F.struct(zero.alias("p"), zero.alias("q"), zero.alias("s")))


def fattest(a: Column, b: Column) -> Column:
    """The number above a, at most b, that the highest power of two divides (a < b)."""
    shift = F.length(F.bin(a.cast("long").bitwiseXOR(b.cast("long")))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", b, shift), shift)


def rebuilt(turns: DataFrame) -> DataFrame:
    """`conv_id` and `names`, one per prefix of the conversation with the head of its group's first conversation.

    A name has the words of all turns so far beside the hashes.
    """
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    placed = rows.withColumn("place", F.row_number().over(
        Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")))
    own = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "place", F.xxhash64("role", "text").alias("p"), F.xxhash64(F.lit(1), "text", "role").alias("q"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("w")))).alias("own"))
    head = F.col("conv_id") % GROUP
    heads = own.where(head == 0).select(F.col("conv_id").alias("first"), F.slice("own", 1, HEADS - 1).alias("head"))
    size = F.crc32(F.col("conv_id").cast("string")) % HEADS
    whole = own.withColumn("h", size.cast("int")).withColumn("first", F.col("conv_id") - head).join(heads, "first", "left").select(
        "conv_id", F.concat(
            F.expr("slice(coalesce(head, slice(own, 1, 0)), 1, h)"),
            F.expr("slice(own, h + 1, greatest(size(own) - h, 0))")).alias("turns"))
    each = whole.select("conv_id", F.posexplode_outer("turns").alias("pos", "t")).select(
        "conv_id", (F.col("pos") + 1).alias("d"), F.col("t.w").alias("w"),
        F.xxhash64("pos", "t.p", "t.q").alias("p"), F.xxhash64(F.lit(2), "t.q", "pos", "t.p").alias("q"))
    along = Window.partitionBy("conv_id").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    named = each.withColumns({"p": F.bit_xor("p").over(along), "q": F.bit_xor("q").over(along), "s": F.sum("w").over(along)})
    return named.groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.when(F.col("d").isNotNull(), F.struct("d", "p", "q", "s")))).alias("names")).select(
        "conv_id", F.transform("names", lambda n: F.struct(n["p"], n["q"], n["s"])).alias("names"))


def distinct(conversations: DataFrame) -> DataFrame:
    """Every sequence once: its least `conv_id`, `n` conversations, `m` turns, `names`."""
    last = at(F.col("names"), F.size("names"))
    tips = conversations.select("conv_id", F.size("names").alias("m"), last["p"].alias("p"), last["q"].alias("q"))
    groups = tips.groupBy("m", "p", "q").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"))
    return groups.select("conv_id", "n", "m").join(conversations, "conv_id")


def exits(nodes: DataFrame, batch: DataFrame, rounds: int) -> DataFrame:
    """Every sequence of the batch with the depth `leaves` at which it leaves the trie, and the node on whose edge that is."""
    handle = fattest(F.col("above"), F.col("depth"))
    handles = nodes.where("depth > 0").withColumn("f", handle).select(
        "f", F.col("above").alias("node_above"), F.col("depth").alias("node_depth"), F.expr("get(edge, f - above - 1).p").alias("hp"),
        F.expr("get(edge, f - above - 1).q").alias("hq"), "p", "q")
    asked = batch.withColumns({"a": F.lit(0), "b": F.col("m")})
    for _ in range(rounds):
        going = F.col("a") < F.col("b")
        # A sequence that has ended its search looks for what is not there, under a key of its own.
        probe = asked.withColumn("f", F.when(going, fattest(F.col("a"), F.col("b"))).otherwise(-1)).withColumns({
            "hp": F.when(going, at(F.col("names"), F.col("f"))["p"]).otherwise(F.xxhash64("conv_id")),
            "hq": F.when(going, at(F.col("names"), F.col("f"))["q"]).otherwise(0)})
        found = probe.join(handles, ["f", "hp", "hq"], "left")
        own = at(F.col("names"), F.col("node_depth"))
        within = (F.col("node_depth") <= F.col("m")) & (own["p"] == F.col("p")) & (own["q"] == F.col("q"))
        hit = F.col("node_depth").isNotNull()
        # On a node's edge but not at its end: it leaves there, and the search is over at the parent.
        asked = found.select(
            *batch.columns,
            F.when(hit & within, F.col("node_depth")).when(hit, F.col("node_above")).otherwise(F.col("a")).alias("a"),
            F.when(~going, F.col("b")).when(hit & within, F.col("b")).when(hit, F.col("node_above")).otherwise(F.col("f") - 1).alias("b"))
    more = F.col("a") < F.col("m")
    door = asked.withColumns({
        "d": F.when(more, F.col("a") + 1).otherwise(-1),
        "dp": F.when(more, at(F.col("names"), F.col("a") + 1)["p"]).otherwise(F.xxhash64("conv_id")),
        "dq": F.when(more, at(F.col("names"), F.col("a") + 1)["q"]).otherwise(0)})
    doors = nodes.where("depth > 0").select(
        (F.col("above") + 1).alias("d"), F.expr("get(edge, 0).p").alias("dp"), F.expr("get(edge, 0).q").alias("dq"),
        F.col("depth").alias("node_depth"), F.col("p").alias("node_p"), F.col("q").alias("node_q"), "edge")
    common = F.expr("""size(filter(zip_with(edge, slice(names, a + 1, least(size(edge), m - a)),
                            (x, y) -> coalesce(x.p = y.p and x.q = y.q, false)), same -> same))""")
    return door.join(doors, ["d", "dp", "dq"], "left").select(
        *batch.columns, (F.col("a") + F.when(F.col("edge").isNull(), 0).otherwise(common)).alias("leaves"),
        "node_depth", "node_p", "node_q")


def split(nodes: DataFrame, left: DataFrame) -> DataFrame:
    """The nodes, their edges cut where sequences leave them."""
    cuts = left.where("leaves < node_depth").groupBy("node_depth", "node_p", "node_q").agg(
        F.array_sort(F.collect_set("leaves")).alias("cuts")).withColumnsRenamed({"node_depth": "depth", "node_p": "p", "node_q": "q"})
    ends = F.expr("concat(coalesce(cuts, array()), array(depth))")
    return nodes.join(cuts, ["depth", "p", "q"], "left").withColumn("ends", ends).select(F.inline(F.expr("""
        transform(ends, (d, i) -> named_struct(
            'above', if(i = 0, above, get(ends, i - 1)), 'depth', d,
            'p', if(d = 0, p, get(edge, d - above - 1).p), 'q', if(d = 0, q, get(edge, d - above - 1).q),
            'parent', if(i = 0, parent, get(edge, get(ends, i - 1) - above - 1)),
            'edge', if(d = 0, edge, slice(edge, if(i = 0, 1, get(ends, i - 1) - above + 1), if(i = 0, d - above, d - get(ends, i - 1))))))""")))


def grown(left: DataFrame) -> DataFrame:
    """New nodes beyond the trie: where new sequences end or part after leaving it."""
    tails = left.where("m > leaves").select("conv_id", "leaves", F.expr("slice(names, leaves + 1, m - leaves)").alias("tail"),
                                            at(F.col("names"), F.col("leaves")).alias("from"))
    rows = tails.select("conv_id", "leaves", F.posexplode("tail").alias("i", "name"), F.expr("tail").alias("tail")).select(
        "conv_id", (F.col("leaves") + F.col("i") + 1).alias("depth"), F.col("name.p").alias("p"), F.col("name.q").alias("q"),
        F.expr("get(tail, i + 1)").alias("next"))
    following = F.struct("next.p", "next.q")
    nodes = rows.groupBy("depth", "p", "q").agg(
        F.min(F.when(F.col("next").isNotNull(), following)).alias("lo"), F.max(F.when(F.col("next").isNotNull(), following)).alias("hi"),
        F.max(F.col("next").isNull()).alias("end"), F.min("conv_id").alias("by")).where("end or lo <> hi").select("depth", "p", "q", "by")
    marks = rows.join(nodes, ["depth", "p", "q"]).groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.struct("depth", (F.col("by") == F.col("conv_id")).alias("own")))).alias("marks"))
    # Every node is made once, by the least sequence through it.
    return tails.join(marks, "conv_id").select(F.inline(F.expr("""
        filter(transform(marks, (k, i) -> named_struct(
            'above', if(i = 0, leaves, get(marks, i - 1).depth), 'depth', k.depth,
            'p', get(tail, k.depth - leaves - 1).p, 'q', get(tail, k.depth - leaves - 1).q,
            'parent', if(i = 0, `from`, get(tail, get(marks, i - 1).depth - leaves - 1)),
            'edge', slice(tail, if(i = 0, 1, get(marks, i - 1).depth - leaves + 1), k.depth - if(i = 0, leaves, get(marks, i - 1).depth)),
            'own', k.own)), k -> k.own)"""))).drop("own")


def built(sequences: DataFrame, scratch: Scratch) -> DataFrame:
    """All nodes of the compacted trie: `above`, `depth`, `p`, `q`, `parent` (name), `edge` (names above + 1 to depth)."""
    spark = sequences.sparkSession
    longest = sequences.agg(F.max("m")).first()[0] or 0
    nodes = spark.range(1).select(
        F.lit(0).alias("above"), F.lit(0).alias("depth"), F.lit(0).cast("long").alias("p"), F.lit(0).cast("long").alias("q"),
        F.lit(None).cast(NAME).alias("parent"), F.array().cast(f"array<{NAME}>").alias("edge"))
    turn = F.pmod(F.xxhash64("conv_id", F.lit("batch")), F.lit(sum(BATCHES)))
    begin = 0
    for step, share in enumerate(BATCHES):
        batch = sequences.where((turn >= begin) & (turn < begin + share))
        begin += share
        left = scratch.keep(exits(nodes, batch, longest.bit_length() + 1 if step else 0), f"exits-{step}")
        nodes = scratch.keep(split(nodes, left).unionByName(grown(left)), f"nodes-{step}")
    return nodes


def end_hashes(conversations: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at a prefix, in ascending order.

    Ranges of ids are joined where they are, and the hash is taken along the ranges, so a prefix at which very many
    conversations end needs no list of them in memory.
    """
    last = at(F.col("names"), F.size("names"))
    tips = conversations.select(F.size("names").alias("depth"), last["p"].alias("p"), last["q"].alias("q"), "conv_id")
    order = ["depth", "p", "q", "conv_id"]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, ids = None, None, []

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()), pa.array([key[2]], pa.int64()),
                 pa.array([first], pa.int64()), pa.array([",".join(map(str, ids)).encode()])],
                names=["depth", "p", "q", "first_id", "ids"])

        for batch in batches:
            for *own, c in zip(*(batch.column(k).to_pylist() for k in order), strict=True):
                if own != key or len(ids) >= IDS_AT_ONCE:
                    if ids:
                        yield piece()
                    key, first, ids = own, c, []
                ids.append(c)
        if ids:
            yield piece()

    ranges = arrow(tips.repartitionByRange(parts(tips), *order).sortWithinPartitions(*order), joined,
                   "depth int, p long, q long, first_id long, ids binary")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()), pa.array([key[2]], pa.int64()),
                 pa.array([state.hexdigest()])], names=["depth", "p", "q", "ends_sha256"])

        for batch in batches:
            for *own, ids in zip(*(batch.column(k).to_pylist() for k in ("depth", "p", "q", "ids")), strict=True):
                if own == key:
                    state.update(b",")
                else:
                    if key is not None:
                        yield done()
                    key, state = own, hashlib.sha256()
                state.update(ids)
        if key is not None:
            yield done()

    return arrow(ranges.repartition(parts(tips), "depth", "p", "q").sortWithinPartitions("depth", "p", "q", "first_id"), hashed,
                 "depth int, p long, q long, ends_sha256 string")


def measured(sequences: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Per compacted node: `top` (least conversation), `n_convs`, `n_leaves`, `saved_tokens`.

    Sums over a subtree are sums over the sequences through it: with multiplicity, a sequence has the words from the node's
    depth on; without, it has those of the prefixes whose least sequence it is, which are its deepest ones.
    """
    each = sequences.select("conv_id", "n", "m", "names", F.posexplode("names").alias("i", "name")).select(
        "conv_id", "n", "m", (F.col("i") + 1).alias("depth"), F.col("name.p").alias("p"), F.col("name.q").alias("q"),
        at(F.col("names"), F.col("i"))["s"].alias("before"), at(F.col("names"), F.col("m"))["s"].alias("all"))
    on_path = each.join(nodes.select("depth", "p", "q"), ["depth", "p", "q"])
    zero = F.lit(0).cast("long")
    root = sequences.select(
        F.lit(0).alias("depth"), zero.alias("p"), zero.alias("q"), "conv_id", "n", "m", zero.alias("before"),
        at(F.col("names"), F.col("m"))["s"].alias("all"))
    paths = scratch.keep(on_path.unionByName(root), "paths")
    tops = scratch.keep(paths.groupBy("depth", "p", "q").agg(F.min("conv_id").alias("top"), F.sum("n").alias("n_convs")), "tops")
    parents = nodes.where("depth > 0").select(F.col("above").alias("depth"), F.col("parent.p").alias("p"), F.col("parent.q").alias("q"))
    inner = parents.groupBy("depth", "p", "q").agg(F.count(F.lit(1)).alias("n_children"))
    tops = tops.join(inner, ["depth", "p", "q"], "left").withColumn("n_children", F.coalesce("n_children", zero))
    tops = scratch.keep(tops, "children")
    marked = paths.join(tops, ["depth", "p", "q"])
    # Words of the prefixes that a smaller sequence shares, and whether the sequence ends in a leaf.
    shared = marked.groupBy("conv_id").agg(
        F.max(F.when(F.col("top") != F.col("conv_id"), F.col("depth"))).alias("shared"),
        F.max((F.col("depth") == F.col("m")) & (F.col("n_children") == 0)).alias("leaf"))
    own = sequences.select("conv_id", "names").join(shared, "conv_id").select(
        "conv_id", "leaf", at(F.col("names"), F.coalesce("shared", F.lit(0)))["s"].alias("shared_words"))
    sums = paths.join(own, "conv_id").groupBy("depth", "p", "q").agg(
        F.sum(F.col("leaf").cast("long")).alias("n_leaves"),
        F.sum(F.col("n") * (F.col("all") - F.col("before")) - (F.col("all") - F.greatest("before", "shared_words"))).alias("saved_tokens"))
    return tops.join(sums, ["depth", "p", "q"])


def expanded(nodes: DataFrame, measures: DataFrame, hashes: DataFrame) -> DataFrame:
    """One row per prefix: the depths along every edge."""
    tops = measures.select(F.col("depth").alias("above"), F.col("p").alias("pp"), F.col("q").alias("pq"), F.col("top").alias("parent_top"))
    full = nodes.withColumns({"pp": F.col("parent.p"), "pq": F.col("parent.q"), "ps": F.col("parent.s")}).drop("parent").join(
        measures, ["depth", "p", "q"]).join(hashes, ["depth", "p", "q"], "left")
    inside = full.where("depth > 0").join(tops, ["above", "pp", "pq"]).select(
        "*", F.posexplode("edge").alias("i", "name")).withColumn("d", F.col("above") + F.col("i") + 1)
    end = F.col("d") == F.col("depth")
    words_to = lambda i: F.when(i >= 0, F.get("edge", i)["s"]).otherwise(F.col("ps"))
    longer = words_to(F.size("edge") - 2) - words_to(F.col("i") - 1)
    rows = inside.select(
        F.col("top").alias("conv_id"), F.col("d").cast("long").alias("depth"),
        F.when(F.col("i") == 0, F.col("parent_top")).otherwise(F.col("top")).alias("parent_conv_id"), "n_convs",
        F.when(end, F.col("n_children")).otherwise(F.lit(1).cast("long")).alias("n_children"), "n_leaves",
        (F.col("saved_tokens") + F.when(end, 0).otherwise((F.col("n_convs") - 1) * longer)).alias("saved_tokens"),
        F.coalesce(F.when(end, F.col("ends_sha256")), F.lit(NO_ENDS)).alias("ends_sha256"))
    root = full.where("depth = 0").select(
        F.col("top").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    return root.unionByName(rows)


def trie(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations."""
    conversations = scratch.keep(rebuilt(turns), "conversations")
    sequences = scratch.keep(distinct(conversations), "sequences")
    nodes = built(sequences, scratch)
    return expanded(nodes, measured(sequences, nodes, scratch), end_hashes(conversations))


#: The same by grouping all prefixes of all conversations; CRC-32 of an id is folded bit by bit.
SQL = """
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
        FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (
        SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                   lambda a, x: list_reduce(list_prepend(xor(a, x), range(8)),
                       lambda b, i: CASE WHEN b % 2 = 1 THEN xor(b // 2, 3988292384) ELSE b // 2 END)), 4294967295) % 4 AS h
        FROM (SELECT DISTINCT conv_id AS c FROM turns)),
    pieces AS (
        SELECT c, 0 AS piece, place, role, text FROM convs JOIN turns ON conv_id = c - c % 20 AND place <= h
        UNION ALL SELECT c, 1, place, role, text FROM convs JOIN turns ON conv_id = c AND place > h),
    placed AS (
        SELECT c, row_number() OVER (PARTITION BY c ORDER BY piece, place) AS d, md5(length(role) || ':' || role || text) AS turn,
               len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS w
        FROM pieces),
    prefixes AS (
        SELECT c, d, w, md5(string_agg(turn, '') OVER (PARTITION BY c ORDER BY d)) AS k FROM placed
        UNION ALL SELECT c, 0, 0, '' FROM convs),
    nodes AS (SELECT d, k, count(*) AS n, min(c) AS top, any_value(w) AS w FROM prefixes GROUP BY d, k),
    ends AS (
        SELECT d, k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS hash
        FROM prefixes SEMI JOIN (SELECT c, max(d) AS d FROM prefixes GROUP BY c) USING (c, d) GROUP BY d, k),
    parents AS (
        SELECT v.d, v.k, p.d AS pd, p.k AS pk FROM nodes v JOIN prefixes p ON p.c = v.top AND p.d = v.d - 1),
    children AS (SELECT pd AS d, pk AS k, count(*) AS n_children FROM parents GROUP BY ALL),
    full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (d, k)),
    subtrees AS (
        SELECT a.d, a.k, sum((u.n - 1) * u.w) AS saved, count(*) FILTER (u.n_children = 0) AS n_leaves
        FROM full_nodes u JOIN prefixes a ON a.c = u.top AND a.d <= u.d GROUP BY ALL)
    SELECT v.top AS conv_id, CAST(v.d AS BIGINT) AS depth, up.top AS parent_conv_id, CAST(v.n AS BIGINT) AS n_convs,
           CAST(v.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
           coalesce(hash, sha256('')) AS ends_sha256
    FROM full_nodes v JOIN subtrees USING (d, k) LEFT JOIN ends USING (d, k)
    LEFT JOIN parents ON parents.d = v.d AND parents.k = v.k LEFT JOIN nodes up ON up.d = pd AND up.k = pk"""
