"""Self-join of documents by Jaccard similarity of their n-gram sets, as a blocked product of the sparse incidence matrix.

The columns of the document by n-gram matrix are dealt out by hash, which makes the blocks; the product of a block with
itself gives, for two documents, how many n-grams of the block both hold, and these counts are summed over the blocks.

Sizes bound what has to be multiplied. Sets that reach the similarity share an n-gram among the first |x| - least overlap + 1
of each set in any order of all columns, so only these entries are multiplied, and a pair whose sum plus all that may follow
stays under the overlap that both sizes ask for is discarded. The order is by hash, common columns last, so that a column
of the product makes at most COMMON pairs for each of its entries. Members of large groups of near copies are connected by
comparison with one member first, and what is connected makes no pairs. A document with too few n-grams that are not common
is multiplied on its whole set, first against the others, then among its like with columns in exact order of frequency.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import free_shuffles, materialize, release, ship
from skyledger.llm.components import components
from skyledger.llm.words import end, folded, runs, step, with_words

#: Pairs of a column for each of its entries, from which it is common; with more entries it is looked at more closely.
COMMON = 50
#: Partners that a node meets at once when candidates are compared; of more, it meets twice as many each time until it is connected.
PARTNERS = 4
#: Members that holders of a common n-gram are dealt out by, at random, to connect them before all their pairs are listed.
DEALT = 8
#: First n-grams of a set that name its buckets among documents of common n-grams.
BUCKETS = 4
#: Words of 64 bits of a set's signature, whose bits tell whether an odd number of its n-grams fall on them.
SIGNATURE = 4
#: Bits of the map of documents whose texts are wanted, broadcast 64 in a row at any size of the corpus.
BITS = 1 << 26


def head(n: int, percent: int) -> int:
    """Entries of a set of ``n`` that must hold one of any set that links with it."""
    return n - -(-percent * n // 100) + 1


def _head(n: Column, percent: int) -> Column:
    return n - F.floor((percent * n + 99) / 100).cast("int") + 1


def written(n: int, percent: int) -> int:
    """Entries that are written: some more than ``head``, for the common ones among them."""
    p = head(n, percent)
    return min(n, p + p // 8 + 4)


def ngram_sets(h: np.ndarray, ends: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the n-word windows of each row's words; fewer words: one of all; none: empty."""
    windows = len(h) - n + 1
    g = end(folded(h, np.arange(windows), n)).view(np.int64) if windows > 0 else np.empty(0, np.int64)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if b - a >= n:
            s = np.sort(g[a : b - n + 1])
            yield s[np.append(True, s[1:] != s[:-1])]
        elif b > a:
            yield end(step(folded(h, np.array([a]), b - a), np.uint64(b - a))).view(np.int64)
        else:
            yield g[:0]


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(np.concatenate(parts) if parts else [], pa.int64()))


def signature(s: np.ndarray) -> np.ndarray:
    """Every n-gram turns one bit, so sets differ by no fewer n-grams than their signatures by bits."""
    odd = np.bincount((s.view(np.uint64) >> np.uint64(32)) % np.uint64(64 * SIGNATURE), minlength=64 * SIGNATURE).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def sketches(docs: DataFrame, n: int, percent: int | None) -> DataFrame:
    """doc_id, n_shingles, node (64-bit hash that names the set), entries (the first of the set), without ``percent`` all entries
    and the signature."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for a, ends, h in runs(batch):
                sets = list(ngram_sets(h, ends, n))
                kept = sets if percent is None else [s[: written(len(s), percent)] for s in sets]
                sizes = pa.array([len(s) for s in sets], pa.int32())
                nodes = pa.array(np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64))
                columns = [batch.column("doc_id").slice(a, len(sets)), sizes, nodes, _lists(kept)] + ([_lists([signature(s) for s in sets])] if percent is None else [])
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "node", "entries", "signature"][: len(columns)])

    schema = "doc_id long, n_shingles int, node long, entries array<long>" + (", signature array<long>" if percent is None else "")
    return with_words(docs, "doc_id").mapInArrow(rows, schema)


def _sizes(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _differences(a: str, b: str) -> Column:
    """At least so many n-grams are in one of two sets and not in the other."""
    return sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(SIGNATURE)), F.lit(0))


def _least_overlap(a: str, b: str, percent: int) -> Column:
    """What two sets of these sizes must share."""
    total = F.col(a) + F.col(b)
    return F.floor((percent * total + 99 + percent) / (100 + percent))


def product(left: DataFrame, right: DataFrame, percent: int, same: bool) -> DataFrame:
    """Pairs (a, b) of nodes of different labels whose shared entries, summed over all columns, still allow the similarity.

    Entries are gram, node, n (size of the set), label. With ``same``, both frames are one and each pair comes once.
    """
    x, y = (df.select("gram", F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("label").alias(f"l{c}")) for df, c in ((left, "a"), (right, "b")))
    pairs = x.join(y, "gram").filter(_sizes("na", "nb", percent) & (F.col("la") != F.col("lb")) & ((F.col("a") < F.col("b")) if same else F.lit(True)))
    summed = pairs.groupBy("a", "b").agg(F.count("*").alias("both"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    rest = F.greatest(F.col("na") - _head(F.col("na"), percent), F.col("nb") - _head(F.col("nb"), percent))
    summed = summed.filter(F.col("both") + rest >= _least_overlap("na", "nb", percent))
    return summed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets, over all columns, reach the similarity."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (xs, xe), (ys, ye) = ((c.values.to_numpy(zero_copy_only=False), c.offsets.to_numpy()) for c in (batch.column("_x"), batch.column("_y")))
            keep = []
            for i in range(batch.num_rows):
                x, y = xs[xe[i] : xe[i + 1]], ys[ye[i] : ye[i + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    half = pairs.join(sets.select(F.col("node").alias("b"), F.col("entries").alias("_y")), "b")
    both = half.join(sets.select(F.col("node").alias("a"), F.col("entries").alias("_x")), "a")
    return both.select("a", "b", "_x", "_y").mapInArrow(counted, "a long, b long").distinct()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b, and what else they have) of different components."""
    rest = pairs
    for c in "ab":
        rest = rest.join(labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")), c, "left")
    return rest.filter(F.coalesce("la", "a") != F.coalesce("lb", "b")).select(*pairs.columns)


def _labels(found: DataFrame) -> DataFrame:
    """Components of the links so far. Shuffle files of the phases before go first."""
    free_shuffles(found.sparkSession)
    return components(found)


def _partners(pairs: DataFrame) -> tuple[DataFrame, bool]:
    """b, k (pairs of this b); whether that is few of each."""
    of = materialize(pairs.groupBy("b").agg(F.count("*").alias("k")), "ngram-partners")
    count, nodes = of.agg(F.sum("k"), F.count("*")).first()
    return of, (count or 0) <= PARTNERS * nodes


def connected(pairs: DataFrame, sets: DataFrame, percent: int, found: DataFrame) -> DataFrame:
    """``found`` with links of ``pairs`` (a < b), enough of them to connect all that they link.

    Each node is compared with the smallest that it is paired with; then only pairs of different components are left, and of
    these each node meets few, then more of its partners until it is connected. So a group of near copies costs comparisons in
    proportion to its members.
    """
    first = materialize(pairs.groupBy("b").agg(F.min("a").alias("a")), "ngram-first-pairs")
    found = found.unionByName(materialize(linked(first, sets, percent), "ngram-first-links"))
    release(first)
    rest, most, done = pairs, PARTNERS, []
    while True:
        labels = _labels(found)
        rest = materialize(_apart(rest, labels), "ngram-other-pairs")
        of, last = _partners(rest)
        for table in (labels, *done):
            release(table)
        # Few partners a node are compared at once; of many, twice as many each time, drawn by hash, as long as they are not connected.
        drawn = rest.join(of, "b").withColumn("now", F.pmod(F.xxhash64("a", "b", F.lit(most)), F.col("k")) < most)
        now = rest if last else drawn.filter("now").select("a", "b")
        found = found.unionByName(materialize(linked(now, sets, percent), "ngram-other-links"))
        done = [rest, of]
        if last:
            release(rest)
            release(of)
            return found
        rest, most = drawn.filter("not now").select("a", "b"), 2 * most


def _some(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is in ``ids``. Most others are told by a bitmap of BITS bits and not shuffled."""
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(BITS))
    word, bit = F.shiftright(place, 6).cast("int"), F.pmod(place, F.lit(64)).cast("int")
    ids = ids.select(F.col("doc_id").cast("long").alias("doc_id"), word.alias("word"), bit.alias("bit"))
    bits = materialize(ids.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")), "ngram-bits")
    marked = docs.withColumns({"word": word, "bit": bit}).join(F.broadcast(bits), "word")  # at most BITS / 64 rows
    return marked.filter(F.expr("shiftright(bits, bit) & 1L") == 1).select(*docs.columns).join(ids, "doc_id", "left_semi")


def _sets_of(nodes: DataFrame, of_node: DataFrame, docs: DataFrame, n: int, name: str) -> DataFrame:
    """node, n_shingles, entries (the whole set), signature of ``nodes``, from the text of one document of each. Where rows are repeated
    a node may come twice."""
    ids = of_node.join(nodes, "node", "left_semi").select("doc_id")
    return materialize(sketches(_some(docs, ids), n, None).select("node", "n_shingles", "entries", "signature"), name)


def _labelled(entries: DataFrame, labels: DataFrame) -> DataFrame:
    return entries.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def bucket_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links of nodes with one member of each bucket: all members of one of the BUCKETS first n-grams are compared with the
    smallest, then, where they are not connected yet, with the largest, then with one at random as long as that connects one of
    twenty."""
    keys = sets.select("node", F.explode(F.slice("entries", 1, BUCKETS)).alias("key"))
    found = None
    for r in itertools.count():
        take = (F.min, F.max)[r] if r < 2 else lambda hub, r=r: F.min_by(hub, F.xxhash64("node", F.lit(r)))
        labels = None if found is None else _labels(found)
        marked = keys.withColumn("label", F.col("node")) if labels is None else _labelled(keys, labels)
        hubs = marked.groupBy("key").agg(take(F.struct("node", "label")).alias("hub"), F.min("label").alias("_l"), F.max("label").alias("_h"))
        hubs = materialize(hubs.filter("_l < _h").select("key", "hub"), "ngram-hubs")
        pairs = marked.join(hubs, "key").filter("label <> hub.label")
        pairs = materialize(pairs.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct(), "ngram-hub-pairs")
        new = materialize(linked(pairs, sets, percent), "ngram-hub-links")
        found = new if found is None else found.unionByName(new)
        last = r and 20 * new.count() <= pairs.count()
        for done in (hubs, pairs, *([labels] if labels else [])):
            release(done)
        if last:
            return found


def _by_gram(entries: DataFrame) -> DataFrame:
    """gram, k (entries), kk (sum of the squares of its labels' entries)."""
    each = entries.groupBy("gram", "label").agg(F.count("*").cast("double").alias("k"))
    return each.groupBy("gram").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("kk"))


def _alike(rare: DataFrame, percent: int, *on: str) -> DataFrame:
    """Pairs of nodes of different labels that agree in ``on`` and that sizes, places and signatures leave."""
    names = {"node": "", "label": "l", "n": "n", "nth": "i", "signature": "s"}
    x, y = (rare.select(*on, *[F.col(k).alias(f"{v}{c}") for k, v in names.items()]) for c in "ab")
    # What may still be shared from this n-gram on, in the common order, must reach the overlap; what differs must stay under it.
    least = _least_overlap("na", "nb", percent)
    reach = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib")) + 1 >= least
    alike = _differences("sa", "sb") <= F.col("na") + F.col("nb") - 2 * least
    return x.join(y, [*on]).filter("a < b and la <> lb").filter(_sizes("na", "nb", percent) & reach & alike).select("a", "b").distinct()


def rare_links(sets: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """``found`` with links among nodes with their whole sets: they share an n-gram among the first of each, rarest first.

    Where that would list many pairs, the holders of an n-gram are dealt out at random into groups of DEALT first, twice as
    large each time, whose pairs are compared, as long as that connects more; what is connected makes no pairs.
    """
    # A column counts once for each label: what only one label holds comes first, and makes no pair.
    labels = _labels(found)
    grams = _labelled(sets, labels).select("node", "label", F.col("n_shingles").alias("n"), F.explode("entries").alias("gram"))
    per_label = grams.groupBy("gram", "label").agg(F.lit(1).alias("_one"))
    shared = materialize(per_label.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1"), "ngram-shared")
    grams = materialize(grams.join(shared, "gram"), "ngram-dense-entries")
    # Of a node's n-grams those that are not shared are first in the order.
    alone = F.col("n") - F.count("*").over(Window.partitionBy("node"))
    nth = alone + F.row_number().over(Window.partitionBy("node").orderBy("df", "gram"))
    rare = materialize(grams.withColumn("nth", nth).filter(F.col("nth") <= _head(F.col("n"), percent)), "ngram-rare")
    # The signatures come last, to the few entries that are left.
    unsigned, rare = rare, materialize(rare.join(sets.select("node", "signature"), "node"), "ngram-rare-signed")
    for done in (labels, shared, grams, unsigned):
        release(done)
    nodes = rare.select("node").distinct().count()
    for r in itertools.count():
        columns = materialize(_by_gram(rare), "ngram-rare-columns")
        entries, pairs = columns.agg(F.sum("k"), F.sum((F.col("k") * F.col("k") - F.col("kk")) / 2)).first()
        if not entries or pairs <= COMMON * entries:
            break
        group = F.pmod(F.xxhash64("node", F.lit(r)), F.ceil(F.col("k") / (DEALT << r)))
        dealt = rare.join(columns.select("gram", "k"), "gram").withColumn("group", group)
        pairs = materialize(_alike(dealt, percent, "gram", "group"), "ngram-dealt-pairs")
        new = materialize(linked(pairs, sets, percent), "ngram-dealt-links")
        found = found.unionByName(new)
        release(pairs)
        release(columns)
        if 100 * new.count() < nodes:
            break
        labels = _labels(found)
        before, rare = rare, materialize(_labelled(rare.drop("label"), labels), "ngram-rare-signed")
        release(labels)
        release(before)
    pairs = materialize(_alike(rare, percent, "gram"), "ngram-rare-pairs")
    release(rare)
    of, few = _partners(pairs)
    release(of)
    if few:
        return found.unionByName(materialize(linked(pairs, sets, percent), "ngram-rare-links"))
    return connected(pairs, sets, percent, found)


def _ends(common: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Of nodes that have common entries (node, n, pos): where the head ends once these are passed over (positions count from
    0), and whether the node is dense, that is, whether what is written of it ends first."""
    at = common.groupBy("node").agg(F.first("n").alias("n"), F.array_sort(F.collect_list("pos")).alias("_at"))  # a node's own n-grams
    passed = F.aggregate("_at", _head(F.col("n"), percent), lambda e, p: F.when(p < e, e + 1).otherwise(e))
    ends = at.select("node", passed.alias("_end")).join(sizes, "node")
    return ends.select("node", "_end", (F.col("_end") > F.col("_written")).alias("dense"))


def jaccard_links(nodes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) between ``nodes`` (node, doc_id, n, entries), enough of them to connect all that is linked."""
    of_node = nodes.select("node", "doc_id")
    sizes = nodes.select("node", F.size("entries").alias("_written"))
    entries = nodes.select("node", "n", F.posexplode("entries").alias("pos", "gram"))
    counts = entries.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1")
    shared = materialize(counts.select("gram", (F.col("df") > COMMON).alias("frequent")), "ngram-columns")
    held = materialize(entries.join(shared, "gram"), "ngram-entries")
    # Members of large groups of near copies hold frequent n-grams; most are connected by comparison with one member.
    frequent_nodes = materialize(_ends(held.filter("frequent"), sizes, percent).filter("dense").select("node"), "ngram-frequent-nodes")
    frequent_sets = _sets_of(frequent_nodes, of_node, docs, n, "ngram-frequent-sets")
    found = bucket_links(frequent_sets, percent)
    labels = _labels(found)
    # Columns by the pairs of different labels that they would make: common are those with more than COMMON for each entry.
    frequent = _labelled(held.filter("frequent").select("gram", "node"), labels)
    common = materialize(_by_gram(frequent).filter((F.col("k") * F.col("k") - F.col("kk")) / 2 > COMMON * F.col("k")).select("gram"), "ngram-common")
    ends = _ends(held.filter("frequent").join(common, "gram"), sizes, percent)
    ends = materialize(ends, "ngram-ends")
    heads = held.join(common, "gram", "left_anti").join(ends, "node", "left")
    heads = heads.filter(F.col("pos") < F.coalesce("_end", _head(F.col("n"), percent))).select("gram", "node", "n", F.coalesce("dense", F.lit(False)).alias("dense"))
    light = materialize(_labelled(heads.filter("not dense").drop("dense"), labels), "ngram-heads")
    release(held)
    pairs = materialize(product(light, light, percent, True), "ngram-pairs")
    dense = materialize(frequent_sets.join(ends.filter("dense").select("node"), "node", "left_semi").dropDuplicates(["node"]), "ngram-dense")
    release(frequent_sets)
    # The whole head of a dense node: its n-grams that are not common, as far as they go.
    rest = dense.select("node", F.col("n_shingles").alias("n"), F.posexplode("entries").alias("pos", "gram")).join(common, "gram", "left_anti")
    nth = F.row_number().over(Window.partitionBy("node").orderBy("pos"))
    rest = rest.withColumn("nth", nth).filter(F.col("nth") <= _head(F.col("n"), percent)).select("gram", "node", "n")
    rest = materialize(_labelled(rest, labels), "ngram-dense-heads")
    light_pairs, pairs = pairs, materialize(pairs.unionByName(product(rest, light, percent, False)), "ngram-all-pairs")
    for done in (labels, common, ends, light, rest, light_pairs):
        release(done)
    free_shuffles(docs.sparkSession)
    used = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), of_node, docs, n, "ngram-sets")
    free_shuffles(docs.sparkSession)
    found = connected(pairs, used, percent, found)
    release(used)
    return found if dense.isEmpty() else rare_links(dense, found, percent)


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles (size of its set), component_id of every row of ``docs``; sets of ``n``-word shingles that share at
    least ``percent`` of their union are linked, and component_id is the smallest doc_id that links reach.

    Equal sets are one node of the product, so copies never make pairs, and links that would join what is joined already
    are not all looked for; no link between components is lost. Sets and n-grams are told apart by 64-bit hashes. Null and
    empty texts have an empty set and link with nothing. Null ids have a null component and link nothing. Rows of one id
    are one document: a link of either is a link of it. An empty table gives an empty result; other columns are ignored.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wide = materialize(sketches(docs, n, percent), "ngram-sketches")
    table = materialize(wide.select("doc_id", "n_shingles", "node"), "ngram-documents")
    live = "n_shingles > 0 and doc_id is not null"
    one = F.min_by(F.struct("doc_id", F.col("n_shingles").alias("n"), "entries"), "doc_id").alias("one")
    nodes = materialize(wide.filter(live).groupBy("node").agg(one).select("node", "one.*"), "ngram-nodes")
    release(wide)
    free_shuffles(docs.sparkSession)
    live, of_node = table.filter(live), nodes.select("node", "doc_id")
    links = jaccard_links(nodes, docs, n, percent)
    # The texts of one id are linked: each with the one of the smallest node.
    several = live.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("_most")).filter("a < _most").select("doc_id", "a")
    own = live.select("doc_id", F.col("node").alias("b")).join(materialize(several, "ngram-several"), "doc_id").filter("a < b").select("a", "b")
    labels = _labels(materialize(links.unionByName(own), "ngram-all-links"))
    named = of_node.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "doc_id")
    least = materialize(named.groupBy("label").agg(F.min("doc_id").alias("component_id")), "ngram-components")
    named = materialize(named.join(least, "label").select("node", "component_id"), "ngram-named")
    # Null ids and empty sets keep what they are.
    node = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("node"))
    out = table.select("doc_id", "n_shingles", node.alias("node")).join(named, "node", "left")
    return out.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
