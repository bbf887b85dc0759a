"""N-gram Jaccard join: candidates by rare n-grams, then a join over prefix trees of whole sets.

Equal sets are one node. A pair at the threshold shares one of the rarest n-grams of both, and behind
the first one that they share both still have enough n-grams for the overlap needed. Nodes that share
one at places and with sizes that allow this are in one cluster. Each cluster is joined by a prefix tree
of its ordered sets: a walk for one set shares the overlap of common prefixes and leaves a subtree
when the n-grams left cannot reach the overlap needed, or when all of it is connected already.
"""

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import functions as F

from tablemart.llm.blocks import Block, TextBlocks, answered, answers_of, asked, bucket_count, pack_sorted
from tablemart.llm.blocks import unpack_sorted, with_answers
from tablemart.llm.components import components
from tablemart.llm.hashing import mix, windows, word_names
from tablemart.llm.tables import blocks_for
from tablemart.operators.ranking import number_rows
from tablemart.storage import via_table

WORDS = 5
PERCENT = 80
#: Nodes of one cluster that a task joins at once; larger clusters are cut.
CLUSTER_ROWS = 2048
#: Rows of a part of a larger cluster; two parts meet in a task.
PART_ROWS = 1024
#: Bytes of sets that one task joins, cluster after cluster.
BIN_BYTES = 32 << 20
PIVOTS = 4
LOWER = bytes(range(256)).lower()
ROWS = "kind int, doc_id long, size long, node long, bucket int, payload binary"


class Sets:
    """The distinct word n-grams of the documents of one block, sorted by document."""

    def __init__(self, block, words):
        names, starts, _ = word_names(b"\n".join(block.texts).translate(LOWER))
        lows = np.cumsum(block.sizes + 1) - block.sizes - 1
        owner = np.searchsorted(lows, starts, side="right") - 1
        count = max(0, len(names) - words + 1)
        whole = owner[:count] == owner[words - 1 : words - 1 + count]
        grams, docs = [windows(names, words)[whole]], [owner[:count][whole]]
        bounds = np.searchsorted(owner, np.arange(len(block.sizes) + 1))
        length = np.diff(bounds)
        for few in range(1, words):
            # Fewer words than an n-gram: the whole sequence is the only member.
            at = np.flatnonzero(length == few)
            if len(at):
                grams.append(windows(names, few)[bounds[at]])
                docs.append(at)
        grams, docs = np.concatenate(grams), np.concatenate(docs)
        order = np.lexsort((grams, docs))
        grams, docs = grams[order], docs[order]
        first = np.ones(len(grams), dtype=bool)
        first[1:] = (grams[1:] != grams[:-1]) | (docs[1:] != docs[:-1])
        self.grams, self.docs = grams[first], docs[first]
        self.bounds = np.searchsorted(self.docs, np.arange(len(block.sizes) + 1))
        self.sizes = np.diff(self.bounds)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.grams ^ np.uint64(0x5851F42D4C957F2D)))])
        total = sums[self.bounds[1:]] - sums[self.bounds[:-1]]
        self.nodes = mix(total + self.sizes.astype(np.uint64)).view(np.int64)


def _keys(sets, buckets):
    bucket = sets.grams % np.uint64(buckets)
    short = bucket << np.uint64(32) | ((sets.grams // np.uint64(buckets)) & np.uint64(0xFFFFFFFF))
    keys, inverse, counts = np.unique(short, return_inverse=True, return_counts=True)
    return keys, inverse, counts, np.searchsorted(keys >> np.uint64(32), np.arange(buckets + 1))


def _ask_frequency(words, buckets):
    def question(block, answers):
        keys, _, _, cuts = _keys(Sets(block, words), buckets)
        for bucket in np.flatnonzero(np.diff(cuts)):
            yield int(bucket), pack_sorted(keys[cuts[bucket] : cuts[bucket + 1]] & np.uint64(0xFFFFFFFF))

    return question


def _frequency(blocks, payloads):
    """Per n-gram the binary magnitude of the number of blocks that hold it."""
    parts = [unpack_sorted(p) for p in payloads]
    _, inverse, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    grade = np.ceil(np.log2(counts)).astype(np.uint8)[inverse]
    packer = zstandard.ZstdCompressor(level=1)
    return [packer.compress(g.tobytes()) for g in np.split(grade, np.cumsum([len(p) for p in parts])[:-1])]


def _candidate_rows(words, percent, buckets):
    """Per document its node; per node of the block that may have a partner its whole set; per bucket
    the rarest n-grams of these nodes that occur anywhere else."""

    def make(batches):
        unpacker, packer = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for r in batch.itertuples():
                answer, block = answers_of(r, "answer0"), Block.unpacked(r.blob)
                sets, rows = Sets(block, words), []
                keys, inverse, counts, cuts = _keys(sets, buckets)
                grade = np.zeros(len(keys), dtype=np.uint8)
                for bucket, data in answer.items():
                    grade[cuts[bucket] : cuts[bucket + 1]] = np.frombuffer(unpacker.decompress(data), np.uint8)
                alone = ((grade == 0) & (counts == 1))[inverse]
                order = np.lexsort((sets.grams, grade[inverse], sets.docs))
                # The order keeps documents in place, so ranks start anew at their bounds.
                rank = np.arange(len(order)) - np.repeat(sets.bounds[:-1], sets.sizes)
                size = np.repeat(sets.sizes, sets.sizes)
                rare = rank < size - -(-size * percent // 100) + 1
                _, first = np.unique(sets.nodes, return_index=True)
                lone = np.ones(len(sets.nodes), dtype=bool)
                lone[first] = False
                rare &= ~alone[order] & ~lone[sets.docs]
                sent, docs = sets.grams[order[rare]], sets.docs[rare]
                # The largest partner that may share this n-gram as the first one: the overlap is at most
                # what is left from here on.
                reach = (100 + percent) * (size[rare] - rank[rare]) // percent - size[rare]
                for n in range(len(sets.nodes)):
                    rows.append((0, int(block.keys[n]) if block.known[n] else None, int(sets.sizes[n]),
                                 int(sets.nodes[n]), None, None))
                for n in np.unique(docs).tolist():
                    grams = sets.grams[sets.bounds[n] : sets.bounds[n + 1]]
                    rows.append((2, None, int(sets.sizes[n]), int(sets.nodes[n]), None, grams.tobytes()))
                bucket = (sent % np.uint64(buckets)).astype(np.int64)
                turn = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[turn], np.arange(buckets + 1))
                for b in np.flatnonzero(np.diff(edges)).tolist():
                    part = turn[edges[b] : edges[b + 1]]
                    table = np.stack([sent[part].view(np.int64), sets.nodes[docs[part]], sets.sizes[docs[part]],
                                      reach[part]])
                    rows.append((1, None, None, None, b, packer.compress(table.tobytes())))
                kinds = ["Int32", "Int64", "Int64", "Int64", "Int32", object]
                columns = [pd.array(c, dtype=kind) for c, kind in zip(zip(*rows), kinds)]
                yield pd.DataFrame(dict(zip(("kind", "doc_id", "size", "node", "bucket", "payload"), columns)))

    return make


def _share(key, rows):
    """Nodes that may share an n-gram as their first one, each linked to the smallest of its run.

    A pair of sizes a <= b is possible if b is within the reach of the smaller one and a within that of
    the larger one. So the smaller one reaches at least its own size; others stay only if such a node no
    larger than their reach reaches them. Runs are cut where no node before reaches the next size.
    """
    unpacker = zstandard.ZstdDecompressor()
    tables = [np.frombuffer(unpacker.decompress(p), np.int64).reshape(4, -1) for p in rows["payload"]]
    grams, nodes, sizes, reach = np.concatenate(tables, axis=1)
    order = np.lexsort((nodes, sizes, grams))
    grams, nodes, sizes, reach = grams[order], nodes[order], sizes[order], reach[order]
    first = np.ones(len(grams), dtype=bool)
    first[1:] = (grams[1:] != grams[:-1]) | (nodes[1:] != nodes[:-1])
    grams, nodes, sizes, reach = grams[first], nodes[first], sizes[first], reach[first]
    # Number of the n-gram and a size in one number, so that searches and maxima stay within an n-gram.
    group = np.cumsum(np.concatenate([[0], grams[1:] != grams[:-1]])) << 32
    farthest = np.maximum.accumulate(group + np.where(reach >= sizes, reach, 0))
    smaller = np.searchsorted(group + sizes, group + np.minimum(reach, sizes), side="right") - 1
    kept = (smaller >= 0) & (farthest[smaller] >= group + sizes)
    group, nodes, sizes, farthest = group[kept], nodes[kept], sizes[kept], farthest[kept]
    head = np.ones(len(group), dtype=bool)
    head[1:] = farthest[:-1] < group[1:] + sizes[1:]
    root = nodes[np.maximum.accumulate(np.where(head, np.arange(len(group)), 0))]
    pairs = np.unique(np.stack([root, nodes])[:, root != nodes], axis=1)
    return pd.DataFrame({"a": pairs[0], "b": pairs[1]})


class PrefixTree:
    """Sets ordered by how common their members are in the cluster, in a tree of shared prefixes.

    Rows are sorted, so every tree node covers a range of rows; it holds the members between its
    parent's depth and its own, the smallest and the largest set below it.
    """

    def __init__(self, sets):
        every, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        place = np.empty(len(every), dtype=np.int64)
        place[np.argsort(-counts, kind="stable")] = np.arange(len(every))
        ranks = np.split(place[inverse], np.cumsum([len(s) for s in sets])[:-1])
        rows = [np.sort(r) for r in ranks]
        self.order = sorted(range(len(rows)), key=lambda n: rows[n].astype(">u4").tobytes())
        self.rows = [rows[n] for n in self.order]
        self.width = len(every)
        self.nodes = []  # [depth before, depth, first row, end row, children]
        self._grow()

    def _common(self, a, b):
        size = min(len(a), len(b))
        apart = np.flatnonzero(a[:size] != b[:size])
        return int(apart[0]) if len(apart) else size

    def _grow(self):
        rows, stack = self.rows, []

        def close(end, depth):
            """End all open nodes deeper than depth; the last one closed may hang below a new one."""
            last = None
            while stack and stack[-1][1] > depth:
                node = stack.pop()
                if last is not None:
                    node[4].append(last)
                    last[0] = node[1]
                node[3] = end
                last = node
            return last

        for n, row in enumerate(rows):
            depth = self._common(rows[n - 1], row) if n else 0
            last = close(n, depth)
            if last is not None:
                if not stack or stack[-1][1] < depth:
                    stack.append([0, depth, last[2], 0, []])
                last[0] = depth
                stack[-1][4].append(last)
            elif not stack:
                stack.append([0, 0, 0, 0, []])
            if len(row) > depth:
                stack.append([depth, len(row), n, 0, []])
        self.root = close(len(rows), -1)
        self.root[0] = 0
        sizes = np.array([len(r) for r in rows])
        todo = [self.root]
        while todo:
            node = todo.pop()
            part = sizes[node[2] : node[3]]
            node += [rows[node[2]][node[0] : node[1]], int(part.min()), int(part.max())]
            todo += node[4]

    def links(self, row, percent, label):
        """Rows linked to `row` that have another label; labels are read as they are now."""
        own, has = self.rows[row], np.zeros(self.width, dtype=bool)
        has[own] = True
        size, todo = len(own), [(self.root, 0)]
        while todo:
            node, overlap = todo.pop()
            before, depth, low, high, children, members, least, most = node
            if (label[low:high] == label[row]).all():
                continue
            overlap += int(has[members].sum())
            # Members up to the last one of this node are behind both sets.
            last = members[-1] if len(members) else -1
            rest = size - int(np.searchsorted(own, last, side="right")) if last >= 0 else size
            reach = overlap + min(rest, most - depth)
            if (100 + percent) * reach < percent * (size + max(least, depth)):
                continue
            todo += [(child, overlap) for child in children]
            for n in range(low, high):
                if len(self.rows[n]) != depth:
                    break
                if label[n] != label[row] and (100 + percent) * overlap >= percent * (size + depth):
                    yield n


def _join(percent):
    def join(key, rows):
        """Links (a, b) that connect nodes of a cluster which are not connected yet; only rows that ask
        look for partners."""
        out = []
        for _, part in rows.groupby("cluster"):
            part = part.sort_values("asks", ascending=False, kind="stable").drop_duplicates("node")
            if len(part) < 2:
                continue
            tree = PrefixTree([np.frombuffer(p, np.uint64) for p in part["payload"]])
            nodes = part["node"].to_numpy()[tree.order]
            label = np.unique(part["label"].to_numpy()[tree.order], return_inverse=True)[1]
            for row in np.flatnonzero(part["asks"].to_numpy()[tree.order]):
                for other in tree.links(row, percent, label):
                    if label[other] != label[row]:
                        out.append((nodes[row], nodes[other]))
                        label[label == label[other]] = label[row]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return join


def _links(sets, percent):
    return sets.groupBy("bin").applyInPandas(_join(percent), "a long, b long")


def _parts(rows, name):
    """Rows of large clusters in parts of PART_ROWS by size."""
    placed = via_table(number_rows(rows, ("cluster", "size", "node"), "place", 1), name)
    first = placed.groupBy("cluster").agg(F.min("place").alias("first"))
    return placed.join(first, "cluster").withColumn(name, F.floor((F.col("place") - F.col("first")) / PART_ROWS)).drop(
        "place", "first"
    )


def _met(labelled, percent):
    """node, cluster, label, asks, bin: each part of the open rows with each part of its cluster whose
    sizes allow a link. No bin has more than two parts, whatever the size of the cluster."""
    few = labelled.select("cluster", "node", "size", "label", "main")
    unlinked = few.filter("label <> main")
    opened = via_table(_parts(unlinked, "opened"), "opened-parts")
    every = via_table(_parts(few.join(unlinked.select("cluster").distinct(), "cluster", "left_semi"), "part"), "parts")
    asking = opened.groupBy("cluster", "opened").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    asked_for = every.groupBy("cluster", "part").agg(F.min("size").alias("least"), F.max("size").alias("most"))
    pairs = asking.join(asked_for, "cluster").filter(
        (F.col("least") * percent <= F.col("high") * 100) & (F.col("low") * percent <= F.col("most") * 100)
    ).select("cluster", "opened", "part", F.xxhash64("cluster", "opened", "part").alias("bin"))
    pairs = via_table(pairs, "part-pairs")
    columns = ["node", "cluster", "label", "bin"]
    return opened.join(pairs, ["cluster", "opened"]).select(*columns, F.lit(True).alias("asks")).unionByName(
        every.join(pairs, ["cluster", "part"]).select(*columns, F.lit(False).alias("asks"))
    )


def _node_components(sets, clusters, percent):
    """(node, component_id) over nodes: components of exact links inside the clusters."""
    sizes = clusters.groupBy("component_id").agg(F.count("*").alias("many"))
    placed = clusters.join(sizes, "component_id").select(
        "node", F.col("component_id").alias("cluster"),
        F.ceil(F.col("many") / CLUSTER_ROWS).cast("long").alias("cuts"),
    )
    rows = sets.groupBy("node").agg(F.first("size").alias("size"), F.first("payload").alias("payload")).join(placed, "node")
    rows = rows.withColumn("label", F.col("node")).withColumn("cut", F.pmod(F.xxhash64("node"), F.col("cuts")))
    rows = via_table(rows.withColumn("asks", F.lit(True)), "cluster-sets")
    small = max(1024, blocks_for(rows.agg(F.sum("size") * 8).first()[0], BIN_BYTES))
    bins = F.when(F.col("cuts") == 1, F.pmod(F.xxhash64("cluster"), F.lit(small))).otherwise(
        F.xxhash64("cluster", "cut")
    )
    # Large clusters: each cut meets the same few pivots, which connects most of it at once.
    large = rows.filter("cuts > 1")
    pivots = large.groupBy("cluster", "cuts").agg(
        F.slice(F.array_sort(F.collect_set(F.when(F.pmod(F.xxhash64("node", F.lit(1)), F.col("cuts")) == 0,
                F.col("node")))), 1, PIVOTS).alias("pivots")
    ).select("cluster", F.explode("pivots").alias("node"))
    spread = large.join(pivots, ["cluster", "node"]).withColumn(
        "cut", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1))
    )
    first = via_table(_links(rows.unionByName(spread).withColumn("bin", bins), percent), "links")
    found = via_table(components(first), "linked")
    if large.isEmpty():
        return found
    # What the pivots did not reach meets every part of its cluster; connected pairs are skipped.
    label = F.coalesce(F.col("component_id"), F.col("node"))
    labelled = large.select("cluster", "node", "size").join(found, "node", "left").withColumn("label", label).drop(
        "component_id"
    )
    biggest = labelled.groupBy("cluster", "label").agg(F.count("*").alias("n")).groupBy("cluster").agg(
        F.max_by("label", F.struct("n", "label")).alias("main")
    )
    labelled = via_table(labelled.join(biggest, "cluster"), "labelled")
    if labelled.filter("label <> main").isEmpty():
        return found
    met = _met(labelled, percent).join(large.select("node", "payload"), "node")
    second = _links(met, percent)
    known = found.select(F.col("node").alias("a"), F.col("component_id").alias("b"))
    return via_table(components(known.unionByName(second)), "linked")


def ngram_components(documents, words=WORDS, percent=PERCENT):
    """doc_id, n_shingles, component_id of every document.

    A document's set: distinct runs of `words` words, A-Z in lower case, words being runs without the
    six separators; with fewer words the whole sequence is the only member, with none the set is
    empty. Two documents link when 100 * intersection >= percent * union; component_id is the
    smallest doc_id reachable. Null and empty texts have empty sets and link with nothing. Rows without
    doc_id keep a null component unless they link to others, then they have theirs; rows of a repeated
    doc_id are compared each for itself. An empty table gives no rows; other columns are not looked at.

    N-grams are 64-bit names. Their frequency comes from all blocks of the corpus, one grade per
    n-gram going back; only n-grams that occur elsewhere are sent on, as few as the threshold needs.
    """
    blocks, buckets = TextBlocks(documents), bucket_count(documents)
    blocks.pin(buckets)
    grades = answered(asked(blocks, _ask_frequency(words, buckets)), _frequency, "frequency")
    rows = via_table(
        with_answers(blocks, grades).mapInPandas(_candidate_rows(words, percent, buckets), ROWS), "sets"
    )
    shared = rows.filter("kind = 1").select("bucket", "payload").groupBy("bucket").applyInPandas(
        _share, "a long, b long"
    )
    clusters = components(via_table(shared, "shared"))
    linked = _node_components(rows.filter("kind = 2").select("node", "size", "payload"), via_table(clusters, "clusters"), percent)
    docs = rows.filter("kind = 0").select("doc_id", F.col("size").alias("n_shingles"), "node")
    docs = docs.join(linked, "node", "left").withColumn("group", F.coalesce("component_id", "node"))
    least = docs.filter("n_shingles > 0").groupBy("group").agg(F.min("doc_id").alias("least"))
    return docs.drop("component_id").join(least, "group", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )
