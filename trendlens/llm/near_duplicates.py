"""MinHash near-duplicates by tensored banding (operator 3).

Two collections of ``GROUPS`` small hash groups (``HASHES`` minhashes each) are
computed.  Table (i, j) is keyed by the i-th group of the first collection with
the j-th of the second, so GROUPS^2 tables cost only 2 * GROUPS * HASHES
minhashes, about the square root of what as many separate tables would.  Two
sets of similarity s share no table with probability below
2 * (1 - s^HASHES)^GROUPS: 4e-4 at 0.8 and 3e-5 at 0.85.

Equal word sequences are one node.  In every table a node is paired with its
bucket's least id (the hub), not with all others; pairs are confirmed on whole
shingle sets, a few hubs at a time.  Members of a bucket that stay apart from
their hub, unless most of their shingles occur in no other member, are then
compared in blocks with the components and the other nodes that they share a
hub with; so no link between candidates that would join two components is
left out, and the rows moved grow with the documents, not with their pairs.

Edge cases: a null text is an empty one; without words the set is empty and
linked with nothing; rows that repeat an id are one document, whose texts may
be several, and all are returned; rows without an id are returned unlinked,
component null and kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlens.llm.common import lookup, shipped, written
from trendlens.llm.components import components

GROUPS, HASHES = 12, 3
#: Links have 100 * intersection >= MIN_PERCENT * union.
MIN_PERCENT = 80
#: Nodes whose shingles are indexed at a time, and nodes compared with them.
ASKING_BLOCK, ASKED_CHUNK = 512, 4096
#: Components of more nodes are compared with as wholes.
LARGE_COMPONENT = 32
#: Rounds that test one hub a component before all that are left.
_THIN = 2
#: Pairs of one hub that one reading of its text serves.
PAIRS_A_CHUNK = 256
_PIECE = 50_000


def shingles(words: list[bytes], width: int) -> set:
    """Distinct runs of ``width`` words; the whole sequence where it is shorter."""
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(width)), strict=False))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _coefficients(groups: int, hashes: int) -> tuple[np.ndarray, np.ndarray]:
    n = 2 * groups * hashes
    base = _mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return base[:n, None] | np.uint64(1), base[n:, None]


def _hashes(words: list[bytes], width: int) -> np.ndarray:
    """64-bit hashes of a text's shingles, repeats included."""
    import xxhash

    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    x = np.full(n, min(width, len(words)), dtype=np.uint64)
    for k in range(min(width, len(words))):
        x = _mixed(x * np.uint64(0x9E3779B97F4A7C15) + one[k:k + n])
    return x


def _group_keys(words: list[bytes], width: int, mul, add, groups: int) -> np.ndarray:
    """The 2 * groups group values of one text: minhashes over its shingles,
    the hashes of a group folded into one 64-bit value."""
    x = _hashes(words, width)
    least = None
    for at in range(0, len(x), _PIECE):
        part = (mul * x[None, at:at + _PIECE] + add).min(axis=1)
        least = part if least is None else np.minimum(least, part)
    least = least.reshape(2 * groups, -1)
    out = least[:, 0]
    for k in range(1, least.shape[1]):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + least[:, k])
    return out.view(np.int64)


def signatures(docs: DataFrame, width: int, groups: int = GROUPS,
               hashes: int = HASHES) -> DataFrame:
    """(doc_id, n_shingles, digest, a, b): a and b are the two collections of
    group values; the digest names the word sequence."""
    shipped(docs.sparkSession)
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("n_shingles", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("a", T.ArrayType(T.LongType())), T.StructField("b", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mul, add = _coefficients(groups, hashes)
        with np.errstate(over="ignore"):
            for batch in batches:
                n, digest, a, b = [], [], [], []
                for text in batch.column(1).cast(pa.binary()):
                    words = (text.as_py() or b"").lower().split()
                    n.append(len(shingles(words, width)))
                    if not words:
                        digest.append(None), a.append(None), b.append(None)
                        continue
                    digest.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                    keys = _group_keys(words, width, mul, add, groups)
                    a.append(keys[:groups]), b.append(keys[groups:])
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                     pa.array(a, longs), pa.array(b, longs)], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def buckets(nodes: DataFrame) -> DataFrame:
    """(key, node, size, hub, hub_size) of every node that is not its bucket's
    hub.  A key's rows are streamed in order; one group of copies meets in as
    many keys as there are tables, so a key holds a small share of all rows."""
    keys = F.flatten(F.transform("a", lambda x, i: F.transform(
        F.col("b"), lambda y, j: F.xxhash64(i, j, x, y))))
    rows = nodes.select("node", "size", F.explode(keys).alias("key"))
    first = Window.partitionBy("key").orderBy("node").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return rows.select("key", "node", "size", F.first("node").over(first).alias("hub"),
                       F.first("size").over(first).alias("hub_size")).where(
        F.col("node") != F.col("hub"))


def _sizes_allow(a: str, b: str, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def confirmed(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets are similar enough.

    The texts of a pair meet at ``a``: b's rows are dealt over chunks of ``a``,
    each chunk starts with a's text, and the rows stream past it.  One set is
    held at a time, however many pairs there are.
    """
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS_A_CHUNK).cast("int").alias("__n"))
    dealt = pairs.join(degree, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("__n")).cast("int").alias("chunk"))
    heads = degree.select("a", F.col("a").alias("b"),
                          F.explode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("chunk"))
    roles = dealt.withColumn("member", F.lit(True)).unionByName(
        heads.withColumn("member", F.lit(False)))
    rows = roles.join(docs.select(F.col("doc_id").alias("b"), "text"), "b")
    rows = rows.select("a", "chunk", "member", "b", "text").repartition(
        "a", "chunk").sortWithinPartitions("a", "chunk", "member")
    schema = T.StructType([T.StructField("a", docs.schema["doc_id"].dataType),
                           T.StructField("b", docs.schema["doc_id"].dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heads_here = None, []
        for batch in batches:
            a_out, b_out = [], []
            left, chunk = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            member, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for k, text in enumerate(batch.column(4).cast(pa.binary())):
                own = shingles((text.as_py() or b"").lower().split(), width)
                if at != (left[k], chunk[k]):
                    at, heads_here = (left[k], chunk[k]), []
                if not member[k]:
                    heads_here.append(own)
                    continue
                for head in heads_here:
                    both = len(own & head)
                    if own and 100 * both >= percent * (len(own) + len(head) - both):
                        a_out.append(left[k]), b_out.append(right[k])
                        break
            yield pa.RecordBatch.from_arrays(
                [pa.array(a_out, batch.schema.field(0).type),
                 pa.array(b_out, batch.schema.field(0).type)], names=["a", "b"])

    return rows.mapInArrow(run, schema)


def _in_blocks(texts: DataFrame, asking: DataFrame, asked: DataFrame, width: int,
               percent: int) -> DataFrame:
    """The similar pairs (a, b) between the nodes of ``asking`` (g, node) and
    those of ``asked`` (g, node) with the same ``g``.

    A group's askers are dealt over blocks and the asked over chunks; a block's
    shingles form an index in memory and a chunk's texts stream past it.  So
    the rows moved grow with the nodes, not with the pairs."""
    def many(df: DataFrame, size: int, name: str) -> DataFrame:
        return df.groupBy("g").agg(F.ceil(F.count("*") / size).cast("int").alias(name))

    counts = many(asking, ASKING_BLOCK, "__nb").join(many(asked, ASKED_CHUNK, "__nc"), "g")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def dealt(n: str):
        return F.pmod(F.xxhash64("node"), F.col(n)).cast("int")

    askers = asking.join(counts, "g").select(
        "g", dealt("__nb").alias("block"), every("__nc").alias("chunk"),
        F.lit(False).alias("asked"), "node")
    others = asked.join(counts, "g").select(
        "g", every("__nb").alias("block"), dealt("__nc").alias("chunk"),
        F.lit(True).alias("asked"), "node")
    rows = askers.unionByName(others).join(
        texts.select(F.col("doc_id").alias("node"), "text"), "node")
    rows = rows.select("g", "block", "chunk", "asked", "node", "text").repartition(
        "g", "block", "chunk").sortWithinPartitions("g", "block", "chunk", "asked")
    kind = texts.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, index, nodes, sizes, held = None, {}, [], [], None
        for batch in batches:
            a_out, b_out = [], []
            keys = list(zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True))
            later, ids = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for k, text in enumerate(batch.column(5).cast(pa.binary())):
                own = shingles((text.as_py() or b"").lower().split(), width)
                if keys[k] != at:
                    at, index, nodes, sizes, held = keys[k], {}, [], [], None
                if not later[k]:
                    for shingle in own:
                        index.setdefault(shingle, []).append(len(nodes))
                    nodes.append(ids[k])
                    sizes.append(len(own))
                    continue
                if held is None:
                    index = {x: np.array(p) for x, p in index.items()}
                    held = np.array(sizes)
                both = np.zeros(len(nodes), np.int64)
                for shingle in own:
                    found = index.get(shingle)
                    if found is not None:
                        both[found] += 1
                near = 100 * both >= percent * np.maximum(held + len(own) - both, 1)
                for j in np.flatnonzero(near).tolist():
                    if nodes[j] != ids[k]:
                        a_out.append(min(nodes[j], ids[k])), b_out.append(max(nodes[j], ids[k]))
            own_type = batch.schema.field(4).type
            yield pa.RecordBatch.from_arrays(
                [pa.array(a_out, own_type), pa.array(b_out, own_type)], names=["a", "b"])

    return rows.mapInArrow(run, schema).distinct()


def _placed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``members`` with the components of node and hub."""
    for node, name in (("node", "comp"), ("hub", "hub_comp")):
        found = labels.select(F.col("node").alias("__n"), F.col("label").alias("__l"))
        members = members.join(found, F.col(node) == F.col("__n"), "left").withColumn(
            name, F.coalesce("__l", F.col(node))).drop("__n", "__l")
    return members


def _untested(pairs: DataFrame, tested: DataFrame | None) -> DataFrame:
    return pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")


def _linked(texts: DataFrame, members: DataFrame, width: int, percent: int):
    """Confirms pairs of nodes and hubs: (labels, links).

    A node meets many hubs, one a table, and most of a group meet in one
    component after few of them.  So the first ``_THIN`` rounds test one hub for
    each component that a node may still join; the last round tests all hubs
    that are still in another component."""
    fitting = members.where(_sizes_allow("size", "hub_size", percent)).select(
        "node", "hub").distinct()
    fitting = written(fitting, "minhash-hubs")
    labels = fitting.select("node", F.col("node").alias("label")).limit(0)
    links = tested = None
    for turn in range(_THIN + 1):
        apart = _placed(fitting, labels).where(F.col("comp") != F.col("hub_comp"))
        pairs = _untested(apart.select(F.col("hub").alias("a"), F.col("node").alias("b"),
                                       "hub_comp"), tested)
        if turn < _THIN:
            pairs = pairs.groupBy("b", "hub_comp").agg(F.min("a").alias("a"))
            if turn == 0:
                pairs = pairs.groupBy("b").agg(F.min("a").alias("a"))
        pairs = written(pairs.select("a", "b"), "minhash-pairs")
        new = written(confirmed(texts, pairs, width, percent), "minhash-links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = new if links is None else links.unionByName(new)
        labels = components(links)
    return labels, links


def _across(texts: DataFrame, placed: DataFrame, labels: DataFrame, width: int,
            percent: int) -> DataFrame:
    """Links (a, b) between members of a bucket of which one stayed apart from
    the hub.  Such a node is compared with the whole of each large component
    that a member with the same hub is in, and one by one with the members
    with the same hub that are in no large component."""
    apart = placed.where(F.col("comp") != F.col("hub_comp"))
    loose = apart.select(F.col("key").alias("k"), F.col("node").alias("x"),
                         F.col("size").alias("x_size"))
    alone = written(_beyond_reach(texts, loose, placed, labels, width, percent), "minhash-alone")
    apart = written(apart.join(alone, apart["node"] == alone["alone"], "left_anti").select(
        "hub", "node", "comp").distinct(), "minhash-apart")
    large = labels.groupBy(F.col("label").alias("g")).count().where(
        F.col("count") > LARGE_COMPONENT).select("g")
    met = placed.select("hub", "comp").union(placed.select("hub", "hub_comp")).distinct()
    met = met.join(large, met["comp"] == large["g"]).select(F.col("hub").alias("h"), "g")
    asking = apart.join(met, (F.col("hub") == F.col("h")) & (F.col("comp") != F.col("g")))
    asking = asking.select("g", "node").distinct()
    asked = labels.select(F.col("label").alias("g"), "node").join(large, "g", "left_semi")
    links = _in_blocks(texts, asking, asked, width, percent)

    near = placed.join(apart.select("hub").distinct(), "hub", "left_semi")
    near = near.join(large, near["comp"] == large["g"], "left_anti")
    near = near.join(alone, near["node"] == alone["alone"], "left_anti")
    near = near.select(F.col("hub").alias("g"), "node").distinct()
    asking = apart.select(F.col("hub").alias("g"), "node")
    return links.unionByName(_in_blocks(texts, asking, near, width, percent))


def _beyond_reach(texts: DataFrame, loose: DataFrame, placed: DataFrame, labels: DataFrame,
                  width: int, percent: int) -> DataFrame:
    """(alone): loose nodes without any link that no other bucket member can be
    similar enough to, for too many of their shingles occur in none of them.

    Shingles are counted over the loose nodes' bucket mates.  A hash that two
    shingles share can only make a node look less alone, so none is lost."""
    mates = placed.join(loose.select(F.col("k").alias("key")).distinct(), "key", "left_semi")
    mates = mates.select(F.col("node").alias("__n"), "comp").distinct()
    kind = texts.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("comp", kind), T.StructField("h", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for start in range(0, batch.num_rows, 200):
                    part = batch.slice(start, 200)
                    found = [np.unique(_hashes((t.as_py() or b"").lower().split(), width))
                             for t in part.column(1).cast(pa.binary())]
                    sizes = [len(x) for x in found]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(np.repeat(np.arange(len(found)), sizes))),
                         pa.array(np.concatenate(found).view(np.int64))], names=["comp", "h"])

    rows = texts.join(mates, texts["doc_id"] == mates["__n"]).select("comp", "text")
    own = rows.mapInArrow(run, schema).groupBy("h").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo = hi")
    own = own.groupBy(F.col("lo").alias("alone")).agg(F.count("*").alias("own"))
    single = loose.select("x", "x_size").distinct().join(
        labels.select(F.col("node").alias("x")), "x", "left_anti")
    return own.join(single, F.col("alone") == F.col("x")).where(
        100 * (F.col("x_size") - F.col("own")) < percent * F.col("x_size")).select("alone")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = MIN_PERCENT,
                    groups: int = GROUPS, hashes: int = HASHES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``
    (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    sigs = written(signatures(docs, width, groups, hashes), "minhash")
    named = sigs.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    copies = written(named.groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.count("*").alias("n")), "minhash-nodes")
    nodes = named.join(copies.select(F.col("digest").alias("d"), "node"),
                       (F.col("doc_id") == F.col("node")) & (F.col("digest") == F.col("d")))
    nodes = nodes.select("node", F.col("n_shingles").alias("size"), "a", "b")
    members = written(buckets(nodes), "minhash-buckets")

    involved = members.select("node").union(members.select("hub")).distinct()
    texts = written(docs.join(involved, docs["doc_id"] == involved["node"], "left_semi"),
                    "minhash-texts")
    labels, links = _linked(texts, members, width, percent)

    more = written(_across(texts, written(_placed(members, labels), "minhash-placed"), labels,
                           width, percent), "minhash-links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    of_copies = written(copies.where("n > 1").join(
        labels.withColumnRenamed("node", "__n"), F.col("node") == F.col("__n"), "left").select(
        "digest", F.coalesce("label", "node").alias("__copy")), "minhash-copies")
    out = lookup(sigs.select("doc_id", "n_shingles", "digest"), of_copies, ["digest"])
    out = out.join(labels, out["doc_id"] == labels["node"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("__copy", "label", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5) -> DataFrame:
    """One row of each group of near-duplicate rows of ``docs``, with its columns:
    that of the smallest doc_id (a null comes last), the first written one if the id
    repeats.

    Rows are linked and dropped by a number of their own, so a repeated id costs
    no text and rows without id take part; rows without words are in no group
    and all stay."""
    rows = written(docs.select(F.monotonically_increasing_id().alias("__n"),
                               F.struct("*").alias("__row")), "dedup-rows")
    plain = rows.select(F.col("__n").alias("doc_id"), F.col("__row.text").alias("text"))
    groups = near_duplicates(plain, width).select(F.col("doc_id").alias("n"), "component_id")
    groups = written(groups, "dedup-groups")
    several = groups.where(F.col("n") != F.col("component_id")).select("component_id").distinct()
    members = groups.join(several, "component_id", "left_semi").join(
        rows.select(F.col("__n").alias("n"), F.col("__row.doc_id").alias("id")), "n")
    members = written(members.select("component_id", F.struct(
        F.col("id").isNull().alias("none"), "id", "n").alias("at")), "dedup-members")
    first = members.groupBy("component_id").agg(F.min("at").alias("first"))
    gone = lookup(members, written(first, "dedup-firsts"), ["component_id"]).where(
        F.col("at.n") != F.col("first.n")).select(F.col("at.n").alias("__gone"))
    return rows.join(gone, F.col("__n") == F.col("__gone"), "left_anti").select("__row.*")
