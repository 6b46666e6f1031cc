"""N-gram Jaccard join: T-occurrence search over inverted lists.

Documents with equal shingle sets are one node.  Shingles are put in one
global order, rarest first; two sets with the required overlap share a shingle
among each one's first ``n - T + 1`` (its short lists), so only those are
dealt by shingle into inverted lists.  Candidates of a list are then searched
by DivideSkip: short lists are merged by a heap, the long ones are probed by
binary search, and pairs that reach the overlap ``T`` are links.

The result is the components of all links.  To find them without listing every
pair of a large group, the search runs twice: first each node against the
head of the lists it is in (one link per node joins most groups), then
every pair of a list that the first round has left in different components.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import checkpoint, partitions, small_batches
from logsift.llm.words import NON_SPACE, U64, cut_rows, gram_hashes, mix, text_bytes, word_hashes, word_spans

#: Bits of the shared map of shingles that occur twice or more: 16 for each
#: shingle, and so many (16 MB) at most.
FILTER_BITS = 27
#: A shingle of more documents is heavy; so many heavy ones are shared at most.
HEAVY = 100
MAX_HEAVY = 1_000_000
_TOKEN = 40  # bits of a shingle's hash that order and count it


def shingles(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, and the rows' offsets.  A
    text of fewer than ``k`` words is one shingle; one without words has none."""
    data, offsets = text_bytes(column, lower=True)
    starts, ends, bounds = word_spans(data, offsets, NON_SPACE)
    h = word_hashes(data, starts, ends)
    sizes = np.diff(bounds)
    grams = gram_hashes(h, k)
    row = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(h)) + k <= bounds[1:][row]
    rows, values = [row[inside]], [grams[np.flatnonzero(inside)]]
    for r in np.flatnonzero((sizes > 0) & (sizes < k)):
        rows.append(np.array([r]))
        values.append(mix(gram_hashes(h[bounds[r] : bounds[r + 1]], int(sizes[r])) + U64(sizes[r])))
    rows, values = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    rows, values = rows[new], values[new]
    return values, np.searchsorted(rows, np.arange(len(column) + 1))


def _signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each whole set (order-free sum of mixed hashes)."""
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(mix(values))])
    return mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(U64)).view(np.int64)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _nodes(src: DataFrame, k: int) -> DataFrame:
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_rows(batches, "text"):
            values, bounds = shingles(batch.column("text"), k)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(bounds)), pa.array(_signatures(values, bounds))],
                                             names=["doc_id", "n_shingles", "node"])

    return src.mapInArrow(run, f"doc_id {kind}, n_shingles long, node long")


def _map_bits(total: int, most: int) -> int:
    """Bits, as a power of 2, of the map for ``total`` shingles."""
    return min(most, total.bit_length() + 4)


def _frequencies(src: DataFrame, k: int, bits: int, heavy: int, buckets: int, flush: int = 1_500_000) -> DataFrame:
    """Count every shingle of every document.  Tasks add up their shingles and
    send the sorted hashes as byte planes of their differences, with the
    counts, dealt by leading bits; a shingle of all documents is one entry a
    task.  Each bucket gives its slice of the map of repeated shingles, and its
    heavy ones."""
    lead = buckets.bit_length() - 1

    def packed(tokens: np.ndarray) -> pa.RecordBatch:
        tokens, n = np.unique(tokens, return_counts=True)
        n = n.astype("<u4")
        edges = np.searchsorted(tokens, np.arange(buckets + 1, dtype=U64) << U64(_TOKEN - lead))
        ids = [b for b in range(buckets) if edges[b] < edges[b + 1]]
        blobs = []
        for b in ids:
            own = tokens[edges[b] : edges[b + 1]]
            step = np.diff(own, prepend=U64(0))
            planes = [step.view(np.uint8).reshape(-1, 8)[:, :5].T, n[edges[b] : edges[b + 1]].view(np.uint8).reshape(-1, 4).T]
            blobs.append(np.ascontiguousarray(np.concatenate(planes)).tobytes())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in cut_rows(batches, "text"):
            values, _ = shingles(batch.column("text"), k)
            held.append(values >> U64(64 - _TOKEN))
            total += len(values)
            if total >= flush:
                yield packed(np.concatenate(held))
                held, total = [], 0
        if total:
            yield packed(np.concatenate(held))

    def count(group: pa.Table) -> pa.Table:
        parts, times = [], []
        for blob in group.column("blob").to_pylist():
            planes = np.frombuffer(blob, np.uint8).reshape(9, -1).T
            step = np.zeros((len(planes), 8), np.uint8)
            step[:, :5] = planes[:, :5]
            parts.append(np.cumsum(step.view("<u8").ravel()))
            times.append(np.ascontiguousarray(planes[:, 5:]).view("<u4").ravel())
        tokens, back = np.unique(np.concatenate(parts), return_inverse=True)
        n = np.bincount(back, weights=np.concatenate(times), minlength=len(tokens)).astype(np.int64)
        size = 1 << (bits - lead)
        at = (tokens[n > 1] >> U64(_TOKEN - bits)) & U64(size - 1)
        marks = np.zeros(size, bool)
        marks[at] = True
        top = n > heavy
        return pa.table({"bucket": pa.array([group.column("bucket")[0].as_py()], pa.int32()),
                         "marks": pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary()),
                         "tokens": pa.array([tokens[top].astype(np.int64).tolist()], pa.list_(pa.int64())),
                         "counts": pa.array([n[top].tolist()], pa.list_(pa.int64()))})

    sent = src.select("text").mapInArrow(send, "bucket int, blob binary")
    return sent.groupBy("bucket").applyInArrow(count, "bucket int, marks binary, tokens array<long>, counts array<long>")


def _postings(src: DataFrame, k: int, percent: int, shared, bits: int) -> DataFrame:
    """Short lists: the first ``n - T + 1`` shingles of each node in the global
    order (once-only ones, then by hash, then heavy ones by count), with the
    place ``pos`` in that order.  Once-only shingles take their places but need
    no list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, tokens, counts = shared.value
        marks = np.frombuffer(marks, np.uint8)
        for batch in cut_rows(batches, "text"):
            values, bounds = shingles(batch.column("text"), k)
            sizes = np.diff(bounds)
            row = np.repeat(np.arange(len(sizes)), sizes)
            token = values >> U64(64 - _TOKEN)
            at = (token >> U64(_TOKEN - bits)).astype(np.int64)
            level = (marks[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(np.int64)
            if len(tokens):
                place = np.minimum(np.searchsorted(tokens, token), len(tokens) - 1)
                level = np.where(tokens[place] == token, counts[place] + 1, level)
            order = np.lexsort((values, level, row))
            need = sizes - (percent * sizes + 99) // 100 + 1
            rank = np.arange(len(values)) - bounds[:-1][row]  # rows keep their places in the order
            on = (rank < need[row]) & (level[order] > 0)
            picked = order[on]
            node = _signatures(values, bounds)
            once = np.bincount(row[level == 0], minlength=len(sizes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[picked].view(np.int64)), pa.array(node[row[picked]]), pa.array(sizes[row[picked]]), pa.array(once[row[picked]]),
                 pa.array(rank[on])],
                names=["token", "node", "n", "once", "pos"])

    return src.select("text").mapInArrow(run, "token long, node long, n long, once long, pos long").distinct()


def _lists(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[np.ndarray]]:
    """Whole inverted lists of a partition that is sorted by token."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        cols = [batch.column(c).to_numpy() for c in columns]
        cut = np.concatenate([[0], np.flatnonzero(np.diff(cols[0])) + 1, [len(cols[0])]])
        for a, b in zip(cut, cut[1:]):
            if a == b:
                continue
            part = [c[a:b] for c in cols]
            if held and held[0][0][0] != part[0][0]:
                yield [np.concatenate(x) for x in zip(*held)]
                held = []
            held.append(part)
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def _pairs_schema(a: list, b: list) -> pa.RecordBatch:
    empty = [np.zeros(0, np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a or empty)), pa.array(np.concatenate(b or empty))], names=["a", "b"])


def divide_skip(query: np.ndarray, sets: list[np.ndarray], need: list[int], weight: float = 0.01) -> list[int]:
    """Positions in ``sets`` that share at least ``need[i]`` elements with the
    sorted ``query``: T-occurrence search over the query's inverted lists."""
    lists: dict[int, list[int]] = {}
    for k, own in enumerate(sets):
        at = np.minimum(np.searchsorted(query, own), len(query) - 1)
        for p in at[query[at] == own].tolist():
            lists.setdefault(p, []).append(k)
    least = min(need)
    ranked = sorted(lists.values(), key=len)
    if len(ranked) < least:
        return []
    n_long = min(least - 1, int(least / (weight * np.log2(max(2, len(ranked[-1]))) + 1)))
    short, long = ranked[: len(ranked) - n_long], ranked[len(ranked) - n_long :]
    out = []
    for k, group in groupby(heapq.merge(*short)):
        count = sum(1 for _ in group)
        if count < need[k] - len(long):
            continue
        for own in long:
            p = bisect_left(own, k)
            count += p < len(own) and own[p] == k
        if count >= need[k]:
            out.append(k)
    return out


def partners(size: np.ndarray, pos: np.ndarray, label: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Pairs of one list, each from its smaller set, that differ in ``label``
    and can still link by way of this list.  Sets that share ``T`` shingles have
    their first common one at most ``n - T`` places into each of them, so a
    linked pair passes in that shingle's list."""
    by_size = np.argsort(size, kind="stable")
    n, p, own = size[by_size], pos[by_size], label[by_size]
    for i in np.flatnonzero(p <= n - (2 * percent * n + 99 + percent) // (100 + percent)).tolist():
        stop = int(np.searchsorted(n, 100 * n[i] // percent, side="right"))  # partners end where sizes differ too much
        m = n[i + 1 : stop]
        need = (percent * (n[i] + m) + 99 + percent) // (100 + percent)
        other = np.flatnonzero((own[i + 1 : stop] != own[i]) & (p[i] <= n[i] - need) & (p[i + 1 : stop] <= m - need)) + i + 1
        if len(other):
            yield int(by_size[i]), by_size[other]


def _verify(pairs: DataFrame, src: DataFrame, rep: DataFrame, k: int, percent: int, bits: int = 25) -> DataFrame:
    """The links among candidate pairs ``(a, b)``, written to the shared folder:
    both texts are joined on and searched.  A bit map of fixed size spares the shuffle most other texts."""
    spark = src.sparkSession
    involved = pairs.select("a").union(pairs.select(F.col("b"))).distinct().withColumnRenamed("a", "node")
    wanted = rep.join(involved, "node")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.unique(b.column("node").to_numpy().view(U64) >> U64(64 - bits)).astype(np.int64) for b in batches]
        if seen:
            at = np.unique(np.concatenate(seen))
            for part in np.split(at, np.flatnonzero(np.diff(at >> 15)) + 1):  # 4 KB slices
                marks = np.zeros(1 << 15, bool)
                marks[part & 32767] = True
                yield pa.RecordBatch.from_arrays([pa.array([int(part[0] >> 15)], pa.int32()), pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())],
                                                 names=["slice", "marks"])

    whole = np.zeros(1 << (bits - 3), np.uint8)
    for r in involved.mapInArrow(mark, "slice int, marks binary").toLocalIterator():
        whole[r["slice"] << 12 : (r["slice"] + 1) << 12] |= np.frombuffer(r["marks"], np.uint8)
    shared = spark.sparkContext.broadcast(whole)  # 2 ** bits / 8 bytes
    kind = src.schema["doc_id"].dataType.simpleString()

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_rows(batches, "text"):
            values, bounds = shingles(batch.column("text"), k)
            node = _signatures(values, bounds)
            at = (node.view(U64) >> U64(64 - bits)).astype(np.int64)
            on = (shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool) & (np.diff(bounds) > 0)
            rows = pa.array(np.flatnonzero(on))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), pa.array(node[on]), batch.column("text").take(rows)],
                                             names=["doc_id", "node", "text"])

    texts = src.mapInArrow(pick, f"doc_id {kind}, node long, text string").alias("t")
    w = wanted.select("node", "rep").alias("w")  # one document stands for each node
    texts = (texts.join(w, (F.col("t.node") == F.col("w.node")) & F.col("t.doc_id").eqNullSafe(F.col("w.rep")), "left_semi")
             .dropDuplicates(["node"]).select("node", "text"))
    one = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    both = one.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "ta", "tb")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_rows(batches, "tb", 4 << 20):
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            own, ob = shingles(batch.column("tb"), k)
            _, first, back = np.unique(a, return_index=True, return_inverse=True)
            qa, qb = shingles(batch.column("ta").take(pa.array(first)), k)
            left, right = [], []
            order = np.argsort(back, kind="stable")
            cuts = np.searchsorted(back[order], np.arange(len(first) + 1))
            for g in range(len(first)):
                rows = order[cuts[g] : cuts[g + 1]]
                query = qa[qb[g] : qb[g + 1]]
                sets = [own[ob[r] : ob[r + 1]] for r in rows]
                need = [-(-percent * (len(query) + len(s)) // (100 + percent)) for s in sets]
                hits = rows[divide_skip(query, sets, need)]
                left.append(a[hits])
                right.append(b[hits])
            yield _pairs_schema(left, right)

    links = checkpoint(both.mapInArrow(search, "a long, b long"))
    shared.destroy()  # the links are written
    return links


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` (least node of its component) for every node of the
    edges ``(a, b)``: least neighbours, then pointer jumping, with the labels
    written to the shared folder in each round."""
    both = checkpoint(edges.union(edges.select("b", "a")).distinct())
    labels = checkpoint(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        # written, as it is both sides of the next join: the driver would hold the plan of all above twice
        new = checkpoint(labels.join(near, labels["node"] == near["a"]).select("node", F.least("label", "near").alias("new"), "label"))
        up = new.select(F.col("node").alias("up"), F.col("new").alias("above"))
        new = new.join(up, new["new"] == up["up"], "left").select("node", F.least("new", F.coalesce("above", "new")).alias("new"), "label")
        new = checkpoint(new)
        changed = new.filter("new <> label").limit(1).count()
        labels = new.select("node", F.col("new").alias("label"))
        if not changed:
            return labels


def join(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", bits: int = FILTER_BITS,
         heavy: int = HEAVY, max_heavy: int = MAX_HEAVY) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``class_id`` (least ``doc_id`` of
    the rows with the same set) and ``component_id`` (least ``doc_id``
    reachable by links, itself included).

    Words are split at ASCII white space after folding A-Z.  Null text, empty
    text and text without words have no shingles and link with nothing: their
    ids are their own.  Repeated rows and equal texts are linked.  A null id
    takes part but never names a component.  Sets are compared by 64-bit
    hashes.  Empty tables give no rows; other columns are ignored.
    """
    spark = small_batches(docs.sparkSession)
    src = _source(docs, id_col, text_col)
    n = partitions(spark)
    buckets = max(256, 1 << (2 * n - 1).bit_length())
    nodes = checkpoint(_nodes(src, k))  # narrow
    bits = max(_map_bits(nodes.agg(F.sum("n_shingles")).first()[0] or 0, bits), buckets.bit_length() + 5)
    rep = nodes.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("rep"))

    counted = checkpoint(_frequencies(src, k, bits, heavy, buckets))
    marks = bytearray(1 << (bits - 3))
    step = len(marks) // buckets
    for r in counted.select("bucket", "marks").coalesce(4).toLocalIterator():  # 2 ** bits / 8 bytes in all, a job for each quarter
        marks[r["bucket"] * step : (r["bucket"] + 1) * step] = r["marks"]
    top = counted.select(F.explode(F.arrays_zip("tokens", "counts")).alias("x")).select("x.*").orderBy(F.desc("counts"), "tokens").limit(max_heavy).collect()
    tokens = np.array(sorted((r["tokens"], r["counts"]) for r in top), np.int64).reshape(-1, 2)
    shared = spark.sparkContext.broadcast((marks, tokens[:, 0].astype(U64), np.ascontiguousarray(tokens[:, 1])))
    del marks

    def shared_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["token", "node", "n", "once", "pos"]
        out, rows = [], 0
        for x in _lists(batches, names):
            if len(x[0]) > 1:
                out.append(x)
                rows += len(x[0])
            if rows >= 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=names)
                out, rows = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=names)

    # the node with the fewest shingles of its own heads a list: among altered
    # copies that is the text they were made from, which links with most
    order = lambda df: df.repartition(n, "token").sortWithinPartitions("token", "once", "n", "node")
    lists = checkpoint(order(_postings(src, k, percent, shared, bits)).mapInArrow(shared_lists, "token long, node long, n long, once long, pos long"))
    shared.destroy()  # the lists are written

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for _, node, size in _lists(batches, ["token", "node", "n"]):
            near = (100 * size[0] >= percent * size[1:]) & (100 * size[1:] >= percent * size[0])
            a.append(np.full(int(near.sum()), node[0]))
            b.append(node[1:][near])
            if len(a) >= 5000:
                yield _pairs_schema(a, b)
                a, b = [], []
        yield _pairs_schema(a, b)

    met = order(lists).mapInArrow(heads, "a long, b long").groupBy("a", "b").agg(F.count(F.lit(1)).alias("met"))
    first = checkpoint(met.groupBy("b").agg(F.max_by("a", F.struct("met", "a")).alias("a")).select("a", "b"))
    links = _verify(first, src, rep, k, percent)
    labels = components(links)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, held = [], [], 0
        for _, node, size, pos, label in _lists(batches, ["token", "node", "n", "pos", "label"]):
            if (label == label[0]).all():
                continue
            for i, other in partners(size, pos, label, percent):
                a.append(np.minimum(node[i], node[other]))
                b.append(np.maximum(node[i], node[other]))
                held += len(other)
                if held >= 50_000:
                    both = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
                    yield _pairs_schema([both[:, 0]], [both[:, 1]])
                    a, b, held = [], [], 0
        yield _pairs_schema(a, b)

    named = lists.join(labels, "node", "left").select("token", "node", "n", "once", "pos", F.coalesce("label", "node").alias("label"))
    rest = order(named).mapInArrow(across, "a long, b long").distinct()
    tested = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = checkpoint(rest.join(tested, ["a", "b"], "left_anti"))
    more = _verify(rest, src, rep, k, percent)
    labels = components(links.union(more)) if more.limit(1).count() else labels

    full = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    classes = nodes.groupBy("node").agg(F.min("doc_id").alias("class_id"))
    least = full.filter("n_shingles > 0").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    own = F.col("n_shingles") == 0
    out = full.join(classes, "node").join(least, "label", "left")
    return out.select("doc_id", "n_shingles", F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
