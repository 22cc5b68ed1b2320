"""Conversation prefix trie by burst tries (operator 12).

A turn becomes an entry of 20 bytes: 16 of the SHA-256 of role and text, and the
text's length in code points.  A node of the trie is a distinct sequence of first
entries; its key is its depth with three sums of position-dependent hashes of its
entries, 144 bits, so that keys of all prefixes come from prefix sums and need no
walk from the root.

1. A conversation is cut into pages of ``PAGE`` turns, each under the key of all turns
   before it, so even one that holds a third of all turns is spread.  Its last page
   is shorter than ``PAGE``, empty if need be.  Equal pages under one head are one
   row with a count and the least conversation.
2. Trie heads: at first the root and the nodes that end a full page.  The rows under
   a head with the same next turn are a container.  A container of more than
   ``CONTAINER`` rows bursts: the next turn becomes a head, its rows lose that turn.
   Rounds go on until no container is too large, ``PAGE`` at most.
3. Containers are dealt over shards, sorted, and swept with a stack: first for
   their sums, then, when the sums under all heads are known, for their nodes.
4. Sums run up the heads by doubling: in round r each head adds to the head 2^r
   steps above it, so deep tries need few rounds.
5. A node's digest over the conversations that end there is computed from ids in
   range order; only groups that cross a partition are put together from pieces.

Edge cases: turns are ordered by turn (null first), equal ones by their entry; a null
role or text is empty; rows without conversation id are no conversation; repeated
rows are turns of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlens.llm.common import lookup, shipped, written
from trendlens.operators.rank import rank_within

#: Turns of a page, rows of a container, bytes of an entry.
PAGE, CONTAINER, ENTRY = 16, 4096, 20
#: Fixed values of the rebuilt conversations: first turns come from the first of so
#: many ids, less than so many of them.
SPAN, MOST = 100, 6
_LANES, _MODULUS = ("a", "b", "c"), 1 << 48
#: Pages that one window sums; ids that one piece of a digest's input holds.
_STRETCH, _IDS = 1024, 4096


def entry(role: Column, text: Column) -> Column:
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.concat(F.substring(F.sha2(named, 256), 1, 32),
                            F.lpad(F.hex(F.length(text)), 8, "0")))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, entry): turns numbered from 0, without a task per
    conversation."""
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        entry(F.col("role"), F.col("text")).alias("entry"))
    ranked = rank_within(turns, ["conv_id"], [F.asc_nulls_first("turn"), F.col("entry")], "pos")
    return ranked.select("conv_id", (F.col("pos") - 1).alias("pos"), "entry")


def rebuilt_turns(turns: DataFrame, span: int = SPAN, most: int = MOST) -> DataFrame:
    """(conv_id, pos, entry): the first h turns of conversation c - c % span, then
    c's own turns after its first h, h being crc32(c) % most.  A conversation left
    without turns has one row with a null ``pos``."""
    turns = written(turns, "trie-turns")
    first = F.col("conv_id") - F.col("conv_id") % span
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("long")
    heads = turns.where((F.col("conv_id") % span == 0) & (F.col("pos") < most - 1)).select(
        F.col("conv_id").alias("first"), "pos", "entry")
    counts = written(heads.groupBy("first").agg(F.count("*").alias("held")), "trie-firsts")
    own = turns.where(F.col("pos") >= h).select(
        "conv_id", first.alias("first"), h.alias("h"), "pos", "entry")
    taken = F.least("h", F.coalesce("held", F.lit(0)))
    own = lookup(own, counts, ["first"]).select(
        "conv_id", (taken + F.col("pos") - F.col("h")).alias("pos"), "entry")
    convs = turns.select("conv_id").distinct().select(
        "conv_id", first.alias("__f"), h.alias("h"))
    # A head has at most most - 1 rows and 2 * span conversations.
    borrowed = convs.join(heads, F.col("__f") == F.col("first"), "left").select(
        "conv_id", F.when(F.col("pos") < F.col("h"), F.col("pos")).alias("pos"), "entry")
    return own.unionByName(borrowed)


def lanes(pos: Column, one: Column) -> list[Column]:
    """The hashes of an entry at a position that a key sums up."""
    return [F.pmod(F.xxhash64(F.lit(k), pos.cast("long"), one), F.lit(_MODULUS))
            for k in range(len(_LANES))]


def _key(depth: Column, values: list[Column]) -> Column:
    return F.struct(depth.cast("long").alias("depth"),
                    *[v.alias(n) for v, n in zip(values, _LANES, strict=True)])


def _later(key: str, steps: Column, values: list[Column]) -> Column:
    return _key(F.col(f"{key}.depth") + steps, [
        F.pmod(F.col(f"{key}.{n}") + v, F.lit(_MODULUS))
        for n, v in zip(_LANES, values, strict=True)])


def pages(turns: DataFrame, page: int = PAGE) -> DataFrame:
    """(conv_id, key, entries, full, ends): the pages of all conversations; ``key`` is
    that of the turns before, ``ends`` that of all turns up to the page's last."""
    turns = written(turns.select("conv_id", "pos", "entry",
                                 F.floor(F.col("pos") / page).alias("page")), "trie-rebuilt")
    present = turns.where(F.col("pos").isNotNull())
    sums = [F.pmod(F.sum(v), F.lit(_MODULUS)).alias(n)
            for v, n in zip(lanes(F.col("pos"), F.col("entry")), _LANES, strict=True)]
    # At most ``page`` turns are gathered.
    gathered = F.sort_array(F.collect_list(F.struct("pos", F.hex("entry").alias("x"))))
    filled = present.groupBy("conv_id", "page").agg(
        F.unhex(F.array_join(F.transform(gathered, lambda t: t["x"]), "")).alias("entries"),
        F.count("*").alias("n"), *sums)
    lengths = turns.groupBy("conv_id").agg(F.count("pos").alias("n"))
    last = lengths.where(F.col("n") % page == 0).select(
        "conv_id", F.floor(F.col("n") / page).alias("page"), F.unhex(F.lit("")).alias("entries"),
        F.lit(0).cast("long").alias("n"), *[F.lit(0).cast("long").alias(n) for n in _LANES])
    all_pages = written(filled.unionByName(last), "trie-pages")

    # Prefix sums over a conversation's pages, by stretches of pages.
    many = all_pages.where(F.col("page") > 0).select("conv_id").distinct()
    several = all_pages.join(many, "conv_id", "left_semi").withColumn(
        "stretch", F.floor(F.col("page") / _STRETCH))
    totals = several.groupBy("conv_id", "stretch").agg(*[
        F.pmod(F.sum(n), F.lit(_MODULUS)).cast("decimal(38,0)").alias(n) for n in _LANES])
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(
        Window.unboundedPreceding, -1)
    inside = Window.partitionBy("conv_id", "stretch").orderBy("page").rowsBetween(
        Window.unboundedPreceding, -1)
    before = totals.select(
        F.col("conv_id").alias("__conv"), F.col("stretch").alias("__stretch"),
        *[F.coalesce(F.sum(n).over(earlier) % _MODULUS, F.lit(0)).cast("long").alias(f"__{n}")
          for n in _LANES])
    several = several.select("*", *[F.coalesce(F.sum(n).over(inside), F.lit(0)).alias(f"in_{n}")
                                    for n in _LANES])
    several = several.join(before, (F.col("conv_id") == F.col("__conv"))
                           & (F.col("stretch") == F.col("__stretch")))
    several = several.select("conv_id", "page", "entries", "n", *_LANES, *[
        F.pmod(F.col(f"in_{n}") + F.col(f"__{n}"), F.lit(_MODULUS)).alias(f"up_{n}")
        for n in _LANES])
    single = all_pages.join(many, "conv_id", "left_anti").select(
        "conv_id", "page", "entries", "n", *_LANES,
        *[F.lit(0).cast("long").alias(f"up_{n}") for n in _LANES])
    out = several.unionByName(single).withColumn(
        "key", _key(F.col("page") * page, [F.col(f"up_{n}") for n in _LANES]))
    return out.select("conv_id", "key", "entries", (F.col("n") == page).alias("full"),
                      _later("key", F.col("n"), [F.col(n) for n in _LANES]).alias("ends"))


@dataclass
class Burst:
    """What bursting leaves: rows of containers (key, entries, full, ends, n, conv,
    head_conv) and heads (key, parent, n, conv, parent_conv, size) that it made."""

    rows: DataFrame
    heads: DataFrame | None = field(default=None)


def burst(paged: DataFrame, container: int = CONTAINER) -> Burst:
    """Rows under their trie heads, no container of more than ``container`` rows."""
    rows = written(paged.groupBy("key", "entries", "full", "ends").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("conv")), "trie-rows")
    least = written(rows.groupBy("key").agg(F.min("conv").alias("head_conv")), "trie-least")
    active = lookup(rows, least, ["key"])
    stay = heads = None
    step = F.substring("entries", 1, ENTRY)
    while True:
        active = written(active.withColumn("next", step), "trie-active")
        large = written(active.where(F.length("entries") > 0).groupBy("key", "next").agg(
            F.count("*").alias("rows"), F.sum("n").alias("n"), F.min("conv").alias("conv"),
            F.min("head_conv").alias("parent_conv")).where(F.col("rows") > container),
            "trie-large")
        if large.isEmpty():
            light = active.drop("next")
            return Burst(light if stay is None else stay.unionByName(light), heads)
        marked = lookup(active, large.select("key", "next", F.col("conv").alias("made")),
                        ["key", "next"])
        marked = written(marked, "trie-marked")
        light = marked.where(F.col("made").isNull()).drop("made", "next")
        stay = light if stay is None else stay.unionByName(light)
        below = _later("key", F.lit(1), lanes(F.col("key.depth"), F.col("next")))
        size = F.conv(F.hex(F.substring("next", 17, 4)), 16, 10).cast("long")
        new = large.select(below.alias("key"), F.col("key").alias("parent"), "n", "conv",
                           "parent_conv", size.alias("size"))
        heads = new if heads is None else heads.unionByName(new)
        active = marked.where(F.col("made").isNotNull()).select(
            below.alias("key"), F.expr(f"substring(entries, {ENTRY + 1})").alias("entries"),
            "full", "ends", "n", "conv", F.col("made").alias("head_conv"))
        # What follows a full page is under the head that ends it.
        active = active.where((F.length("entries") > 0) | ~F.col("full"))


def swept(rows: list[tuple]) -> list[list]:
    """The nodes of one container, parents first.  A row is (entries, full, n, conv,
    children, leaves, saved, digest), the last four being what is known of the
    node that it ends at; a node [parent, depth, conv, n, children, leaves, saved,
    digest], depth from 1 and parent -1 at the top."""
    nodes: list[list] = []
    sizes, ended = [], []
    stack, before = [], b""
    for entries, full, n, conv, children, leaves, saved, digest in rows:
        same = 0
        while (same < len(stack) and entries[same * ENTRY:(same + 1) * ENTRY]
               == before[same * ENTRY:(same + 1) * ENTRY]):
            same += 1
        del stack[same:]
        for depth in range(same, len(entries) // ENTRY):
            nodes.append([stack[-1] if stack else -1, depth + 1, conv, 0, 0, 0, 0, None])
            sizes.append(int.from_bytes(entries[depth * ENTRY + 16:(depth + 1) * ENTRY], "big"))
            ended.append(False)
            stack.append(len(nodes) - 1)
        for k in stack:
            nodes[k][2] = min(nodes[k][2], conv)
            nodes[k][3] += n
        end = nodes[stack[-1]]
        end[4] += children or 0
        end[5] += leaves or 0
        end[6] += saved or 0
        end[7] = digest
        ended[stack[-1]] = full
        before = entries
    for k in range(len(nodes) - 1, -1, -1):
        node = nodes[k]
        if node[4] == 0 and not ended[k]:
            node[5] = 1
        node[6] += (node[3] - 1) * sizes[k]
        if node[0] >= 0:
            above = nodes[node[0]]
            above[4] += 1
            above[5] += node[5]
            above[6] += node[6]
    return nodes


_ROW = ["key", "entries", "full", "n", "conv", "head_conv", "children", "leaves", "saved", "digest"]


def _containers(rows: DataFrame) -> DataFrame:
    """Rows dealt over shards by head and next turn, sorted within them."""
    shard = [F.col("key"), F.substring("entries", 1, ENTRY)]
    return rows.where(F.length("entries") > 0).select(*_ROW).repartition(
        *shard).sortWithinPartitions("key", "entries")


def _each_container(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(key, head_conv, rows) of each container of a sorted shard."""
    at, head, held = None, None, []
    for batch in batches:
        cols = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
        for row in zip(*cols, strict=True):
            here = (tuple(row[0].values()), row[1][:ENTRY])
            if here != at:
                if held:
                    yield at[0], head, held
                at, head, held = here, row[5], []
            held.append((*row[1:5], *row[6:]))
    if held:
        yield at[0], head, held


def _in_batches(rows: Iterator[tuple], types: list[pa.DataType],
                names: list[str]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == 20_000:
            yield _batch(held, types, names)
            held = []
    if held:
        yield _batch(held, types, names)


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    cols = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=names)


def container_sums(rows: DataFrame) -> DataFrame:
    """(key, children, leaves, saved): of each head with containers, what these hold."""
    blank = rows.select("key", "entries", "full", "n", "conv", "head_conv",
                        *[F.lit(None).cast("long").alias(c) for c in _ROW[6:9]],
                        F.lit(None).cast("string").alias("digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["depth", *_LANES, "leaves", "saved"]
        tops = ((key, swept(held)[0]) for key, _, held in _each_container(batches))
        yield from _in_batches(((*key, top[5], top[6]) for key, top in tops),
                               [pa.int64()] * 6, names)

    sums = _containers(blank).mapInArrow(
        run, "depth long, a long, b long, c long, leaves long, saved long")
    return sums.groupBy(F.struct("depth", *_LANES).alias("key")).agg(
        F.count("*").alias("children"), F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"))


def container_nodes(rows: DataFrame) -> DataFrame:
    """The nodes of all containers, with the columns of the result."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for key, head, held in _each_container(batches):
            nodes = swept(held)
            for parent, depth, conv, n, children, leaves, saved, digest in nodes:
                yield (conv, key[0] + depth, head if parent < 0 else nodes[parent][2], n,
                       children, leaves, saved, digest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _in_batches(made(batches), [pa.int64()] * 7 + [pa.string()], COLUMNS)

    schema = ", ".join([f"{c} long" for c in COLUMNS[:-1]] + [f"{COLUMNS[-1]} string"])
    return _containers(rows).mapInArrow(run, schema)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


def head_sums(heads: DataFrame) -> DataFrame:
    """(key, leaves, saved) summed over each head and all heads below it, from
    heads (key, above, leaves, saved).  After round r a head holds the heads less
    than 2^r steps below, and ``above`` is 2^r steps up."""
    heads = written(heads, "trie-heads")
    while not heads.where(F.col("above").isNotNull()).isEmpty():
        more = heads.where(F.col("above").isNotNull()).groupBy(F.col("above").alias("__k")).agg(
            F.sum("leaves").alias("__l"), F.sum("saved").alias("__s"))
        up = heads.select(F.col("key").alias("__u"), F.col("above").alias("__a"))
        heads = heads.join(more, heads["key"] == more["__k"], "left").join(
            up, heads["above"] == up["__u"], "left").select(
            "key", F.col("__a").alias("above"),
            (F.col("leaves") + F.coalesce("__l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("__s", F.lit(0))).alias("saved"))
        heads = written(heads, "trie-heads")
    return heads.drop("above")


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, digest): SHA-256 of the ids of the conversations that end at a node,
    ascending and joined by commas, from rows (key, conv_id).

    A digest has to read its ids in order.  They are sorted by ranges, and a range
    hashes the groups that lie inside it; a group that its border cuts comes out
    as pieces of ``_IDS`` ids, so few rows are left to be joined by key."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ends.select("key.*", "conv_id").repartitionByRange(
        n, "depth", *_LANES, "conv_id").sortWithinPartitions("depth", *_LANES, "conv_id")
    names = ["depth", *_LANES, "at", "piece", "digest"]
    types = [pa.int64()] * 5 + [pa.string()] * 2

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(key, first id, ids as text, whether the group's last piece here)."""
        at, held = None, []
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(5)]
            for *key, conv in zip(*cols, strict=True):
                if key != at or len(held) == _IDS:
                    if held:
                        yield at, held[0], ",".join(map(str, held)), key != at
                    at, held = key, []
                held.append(conv)
        if held:
            yield at, held[0], ",".join(map(str, held)), False

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        # The first and the last group of a range may go on outside it; so may
        # a long one, of which not all pieces are held.
        first, at, pieces, long = None, None, [], False
        for key, start, text, done in groups(batches):
            first = first or key
            if key != at:
                at, pieces, long = key, [], key == first
            pieces.append((*key, start, text, None))
            if long or len(pieces) > 64:
                yield from pieces
                pieces, long = [], True
            elif done:
                ids = ",".join(p[5] for p in pieces)
                yield (*key, None, None, hashlib.sha256(ids.encode()).hexdigest())
                pieces = []
        yield from pieces

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _in_batches(inside(batches), types, names)

    schema = "depth long, a long, b long, c long, at long, piece string, digest string"
    parts = written(ranged.mapInArrow(run, schema), "trie-ends")
    cut = parts.where(F.col("piece").isNotNull()).repartition(
        "depth", *_LANES).sortWithinPartitions("depth", *_LANES, "at")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at, digest = None, None
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in (0, 1, 2, 3, 5)]
            for *key, piece in zip(*cols, strict=True):
                if key != at:
                    if at:
                        yield (*at, None, None, digest.hexdigest())
                    at, digest = key, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(piece.encode())
        if at:
            yield (*at, None, None, digest.hexdigest())

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _in_batches(joined(batches), types, names)

    whole = parts.where(F.col("digest").isNotNull()).unionByName(cut.mapInArrow(run_joined, schema))
    return whole.select(F.struct("depth", *_LANES).alias("key"), "digest")


def prefix_trie(turns: DataFrame, page: int = PAGE, container: int = CONTAINER) -> DataFrame:
    """The nodes of the prefix trie of sequences (conv_id, pos, entry), a row with a
    null ``pos`` standing for a sequence that may have no turns."""
    spark = turns.sparkSession
    shipped(spark)
    paged = written(pages(turns, page), "trie-paged")
    firsts = paged.where(F.col("key.depth") == 0).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("conv")).first()
    if not firsts["n"]:
        return spark.createDataFrame([], ", ".join(
            [f"{c} long" for c in COLUMNS[:-1]] + [f"{COLUMNS[-1]} string"]))
    split = burst(paged, container)
    rows = split.rows.where(F.length("entries") > 0)
    digests = written(end_digests(paged.where(~F.col("full")).select(
        F.col("ends").alias("key"), "conv_id")), "trie-digests")
    sums = container_sums(rows)

    zero = F.lit(0).cast("long")
    root = spark.range(1).select(
        _key(zero, [zero] * len(_LANES)).alias("key"), F.lit(firsts["n"]).cast("long").alias("n"),
        F.lit(firsts["conv"]).cast("long").alias("conv"), zero.alias("size"))
    links = rows.where("full").select(F.col("ends").alias("key"), F.col("key").alias("above"))
    heads = links.unionByName(root, allowMissingColumns=True)
    if split.heads is not None:
        heads = heads.unionByName(split.heads.withColumnRenamed("parent", "above"),
                                  allowMissingColumns=True)
        made = split.heads.groupBy(F.col("parent").alias("key")).agg(
            F.count("*").alias("children"), F.lit(0).cast("long").alias("leaves"),
            F.lit(0).cast("long").alias("saved"))
        sums = sums.unionByName(made).groupBy("key").agg(
            *[F.sum(c).alias(c) for c in ("children", "leaves", "saved")])
    else:
        heads = heads.withColumn("parent_conv", F.lit(None).cast("long"))
    sums = sums.withColumnRenamed("key", "__k")
    heads = heads.join(sums, heads["key"] == sums["__k"], "left").select(
        "key", "above", "n", "conv", "parent_conv", F.coalesce("children", zero).alias("children"),
        F.when(F.coalesce("children", zero) == 0, 1).otherwise(F.col("leaves")).alias("leaves"),
        (F.coalesce("saved", zero) + F.coalesce((F.col("n") - 1) * F.col("size"), zero))
        .alias("saved"))
    heads = written(heads, "trie-head-rows")

    # The root's sums are those of all heads; without it no head has very many
    # others one step below.
    whole = heads.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    below = head_sums(heads.where(F.col("key.depth") > 0).select(
        "key", F.when(F.col("above.depth") > 0, F.col("above")).alias("above"),
        "leaves", "saved"))
    below = below.unionByName(whole.select(_key(zero, [zero] * len(_LANES)).alias("key"),
                                           "leaves", "saved"))
    below = written(below.toDF("__k", "sum_leaves", "sum_saved"), "trie-sums")
    heads = heads.drop("leaves", "saved").join(below, heads["key"] == below["__k"]).select(
        "key", "n", "conv", "parent_conv", "children", F.col("sum_leaves").alias("leaves"),
        F.col("sum_saved").alias("saved"))
    digests = digests.withColumnRenamed("key", "__d")
    heads = written(heads.join(digests, heads["key"] == digests["__d"], "left").drop("__d"),
                    "trie-heads-summed")

    known = heads.select(F.col("key").alias("__k"), "children", "leaves", "saved")
    rows = rows.join(known, rows["ends"] == known["__k"], "left").join(
        digests, rows["ends"] == digests["__d"], "left")
    nodes = container_nodes(rows)
    own = heads.where(F.col("n").isNotNull()).select(
        F.col("conv").alias("conv_id"), F.col("key.depth").alias("depth"),
        F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.col("digest").alias("ends_sha256"))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.unionByName(own).withColumn("ends_sha256", F.coalesce("ends_sha256", empty))


def conversation_trie(conversations: DataFrame, span: int = SPAN, most: int = MOST,
                      page: int = PAGE, container: int = CONTAINER) -> DataFrame:
    """The trie of the rebuilt conversations of ``conversations`` (conv_id, turn,
    role, text)."""
    turns = rebuilt_turns(ordered_turns(conversations), span, most)
    return prefix_trie(turns, page, container)
