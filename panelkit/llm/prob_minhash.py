"""Near duplicates by ProbMinHash over weighted word shingles.

Every shingle of a text sends exponential arrivals, at a rate of its weight, to random registers; a register keeps the
first. A shingle stops as soon as its next arrival is later than every register's. Two texts agree in a register with
the probability Jaccard similarity of their weighted shingles. Bands of registers give candidates, signatures rule out
what cannot reach the threshold, and shingles verify the rest exactly.

Texts with equal weighted shingles are one node from the start, so a group of copies costs one row. In a bucket every
member is compared with one pivot, not with each other; components of those links are found by spreading least ids. Then
members are compared with their bucket's plainest node, and last, members outside their bucket's main component with
members of other components. Shingles that only one node has bound the similarity of any pair from above, so that no link
between components is missed and yet no bucket gives all its pairs.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import lean, mix64, prepare, row_blocks, utf8, written
from panelkit.llm.shingles import WORDS, shingles
from panelkit.operators.spread import split_join

SIMILARITY = 0.8
#: A pair of similarity 0.8 shares none of 32 bands of 4 registers with a probability of 5e-8.
BANDS, ROWS = 32, 4
#: Standard errors that an estimate may lie below the threshold before a candidate is ruled out.
ERRORS = 6
SCANNED = 2 << 20
#: Nodes that hang together by buckets: up to SMALL are compared pair by pair, more in blocks of about BLOCK.
SMALL, BLOCK = 32, 512
_STEP, _OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xA0761D6478BD642F)


def signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, registers: int = BANDS * ROWS) -> np.ndarray:
    """One row of registers for each of n texts: the shingle that arrived first. Texts without shingles have zeros."""
    first = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, np.uint64)
    time = np.zeros(len(text))
    active = np.arange(len(text))
    table = first.reshape(n, registers)
    worst = np.full(n, np.inf)
    step = 0
    with np.errstate(over="ignore"):
        while len(active):
            step += 1
            x = mix64(shingle[active] + _STEP * np.uint64(step))
            time[active] -= np.log(((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight[active]
            now = time[active]
            own = text[active]
            at = own * registers + (mix64(x ^ _OTHER) % np.uint64(registers)).astype(np.int64)
            better = now < first[at]
            at, now = at[better], now[better]
            np.minimum.at(first, at, now)
            won = first[at] == now
            winner[at[won]] = shingle[active[better][won]]
            still = own[np.concatenate([[True], own[1:] != own[:-1]])]
            worst[still] = table[still].max(axis=1)
            active = active[time[active] < worst[own]]
    return winner.reshape(n, registers)


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Probability Jaccard of two weighted shingle sets: the chance that the first arrival is the same."""
    if not len(a) or not len(b):
        return 0.0
    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    if (wa == 1).all() and (wb == 1).all():
        return len(both) / (len(a) + len(b) - len(both))
    x, y = wa[i].astype(float), wb[j].astype(float)
    rest_a, rest_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    order = np.argsort(y / x, kind="stable")
    x, y = x[order], y[order]
    ratio = y / x
    upto = np.searchsorted(ratio, ratio, "right")
    sum_x = np.concatenate([[0], np.cumsum(x)])[upto]
    sum_y = y.sum() - np.concatenate([[0], np.cumsum(y)])[upto]
    return float((1 / ((rest_a + sum_x) / x + (rest_b + sum_y) / y)).sum())


def _signed(words: int, bands: int, rows: int):
    def out(batches):
        for batch in batches:
            body, offsets = utf8(batch.column(1))
            for a, b in row_blocks(offsets, SCANNED):
                text, shingle, weight = shingles(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words)
                n = b - a
                registers = signatures(text, shingle, weight, n, bands * rows)
                has = np.zeros(n, bool)
                has[text] = True
                weighted = mix64(shingle ^ mix64(weight.astype(np.uint64) * _STEP))
                key1, key2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                np.add.at(key1, text, weighted)
                np.add.at(key2, text, mix64(weighted ^ _OTHER))
                folded = np.zeros((n, bands), np.uint64)
                for r in range(rows):
                    folded = mix64(folded * _STEP + registers.reshape(n, bands, rows)[:, :, r])
                folded = mix64(folded + np.arange(1, bands + 1, dtype=np.uint64) * _OTHER)
                short = mix64(registers).astype(np.uint16)
                keep = np.flatnonzero(has)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n).take(pa.array(keep)), pa.array(key1[keep].view(np.int64)), pa.array(key2[keep].view(np.int64)),
                     pa.array([short[i].tobytes() for i in keep.tolist()], pa.binary()), pa.array(list(folded[keep].view(np.int64)), pa.list_(pa.int64())),
                     pa.array(np.bincount(text, weight, n)[keep].astype(np.int64))],
                    ["id", "key1", "key2", "signature", "bands", "total"])

    return out


def _shingle_rows(words: int):
    def out(batches):
        for batch in batches:
            body, offsets = utf8(batch.column(1))
            for a, b in row_blocks(offsets, SCANNED):
                text, shingle, weight = shingles(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text + a)), pa.array(shingle.view(np.int64)), pa.array(weight)], ["node", "shingle", "weight"])

    return out


def _verified(words: int, least: float):
    """Pairs whose texts reach the similarity."""
    def out(batches):
        for batch in batches:
            sides = []
            for c in (2, 3):
                body, offsets = utf8(batch.column(c))
                per_text = [None] * batch.num_rows
                for a, b in row_blocks(offsets, SCANNED):
                    text, shingle, weight = shingles(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words)
                    cut = np.searchsorted(text, np.arange(b - a + 1))
                    for i in range(b - a):
                        per_text[a + i] = shingle[cut[i] : cut[i + 1]], weight[cut[i] : cut[i + 1]]
                sides.append(per_text)
            ok = [similarity(*x, *y) >= least - 1e-12 for x, y in zip(*sides, strict=True)]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return out


def _block_links(words: int, least: float, slack: float, bound: float, registers: int, bands: int):
    """Links between two blocks of nodes (or within one) that join components: each pair is looked at here, and only links
    leave the task. Nodes already joined by an earlier link need no further one."""
    def out(t: pa.Table) -> pa.Table:
        node, label, odds, own = (t[c].to_numpy() for c in ("node", "label", "odds", "own"))
        order = np.argsort(own, kind="stable")
        t = t.take(pa.array(order))
        node, label, odds, own = node[order], label[order], odds[order], own[order]
        marks = np.frombuffer(b"".join(t["signature"].to_pylist()), np.uint16).reshape(len(node), registers)
        held = np.array(t["bands"].to_pylist(), np.int64).reshape(len(node), bands)
        body, offsets = utf8(t["text"])
        known: dict[int, tuple] = {}

        def set_of(i: int):
            if i not in known:
                _, shingle, weight = shingles(body[offsets[i] : offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]), words)
                known[i] = shingle, weight
            return known[i]

        parent = {x: x for x in label.tolist()}

        def root(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        i, j = t["i"][0].as_py(), t["j"][0].as_py()
        first = int((own == i).sum()) if i != j else len(node)
        found = [], []
        for x in range(first):
            y = np.arange(x + 1 if i == j else first, len(node))
            y = y[(label[y] != label[x]) & (odds[y] + odds[x] <= slack)]
            y = y[(held[y] == held[x]).any(axis=1)]
            y = y[(marks[y] == marks[x]).mean(axis=1) >= bound]
            for k in y.tolist():
                p, q = root(int(label[x])), root(int(label[k]))
                if p != q and similarity(*set_of(x), *set_of(k)) >= least - 1e-12:
                    parent[p] = q
                    found[0].append(int(node[x]))
                    found[1].append(int(node[k]))
        return pa.table([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64())], ["a", "b"])

    return out


def components(edges: DataFrame) -> DataFrame:
    """id and label (the least id of its component) of all ends of edges (a, b): least labels spread along edges, and
    labels of labels are followed, until nothing changes. Only counts reach the driver."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label")))
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        spread = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("label").alias("far"))
        new = written(spread.join(jump, "next").select("id", F.least("next", "far").alias("label"), (F.least("next", "far") != F.col("label")).alias("changed")))
        labels = new.drop("changed")
        if not new.where("changed").limit(1).count():
            return labels


def near_duplicates(docs: DataFrame, words: int = WORDS, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """doc_id and class_id (the least doc_id of its class), one row for each row of docs.

    A class is a connected component of links: pairs of texts with a probability Jaccard similarity of at least `least`
    over weighted shingles. A text with fewer words than a shingle has one shingle; a text without words (null or empty
    too) is linked to none. Rows of one doc_id are one document. A row without doc_id has no class. Other columns are not
    read. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    known = docs.where("id is not null")
    signed = written(known.mapInArrow(lean(_signed(words, bands, rows)), "id long, key1 long, key2 long, signature binary, bands array<long>, total long"))
    nodes = written(signed.groupBy("key1", "key2").agg(F.min("id").alias("node"), F.first("signature").alias("signature"), F.first("bands").alias("bands"), F.first("total").alias("total")))
    member = signed.select("id", "key1", "key2").join(nodes.select("key1", "key2", "node"), ["key1", "key2"]).select("id", "node")
    marks = nodes.select("node", "signature")

    buckets = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    pivots = buckets.groupBy("bucket").agg(F.min_by("node", F.xxhash64("node", F.col("band") % 2)).alias("pivot"), F.count("*").alias("n")).where("n > 1").drop("n")
    shared = written(split_join(buckets, pivots, ["bucket"]).select("bucket", "node", "pivot"))

    def classes(labels: DataFrame | None) -> DataFrame:
        own = F.col("node").alias("label")
        facts = member.select("id", own) if labels is None else member.join(
            labels.withColumnRenamed("id", "node"), "node", "left").select("id", F.coalesce("label", "node").alias("label"))
        per_id = facts.groupBy("id").agg(F.min("label").alias("label"))
        return docs.select("id").join(per_id, "id", "left").select(F.col("id").alias("doc_id"), F.coalesce("label", "id").alias("class_id"))

    if shared.isEmpty():
        return classes(None)

    registers = bands * rows
    bound = max(0.0, least - ERRORS * (least * (1 - least) / registers) ** 0.5)
    slack = 1 / least - 1 + 1e-9

    def alike(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint16).reshape(len(c), registers) for c in (a, b))
        return pa.array((x == y).mean(axis=1) >= bound)

    ends = shared.select(F.col("node").alias("id")).distinct()
    texts = written(known.join(ends, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text")))

    def verified(pairs: DataFrame) -> DataFrame:
        """Those of the candidate pairs (a, b) that are links."""
        close = pairs.join(marks.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a").join(
            marks.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b").where(F.arrow_udf(lean(alike), "boolean")("sa", "sb"))
        both = close.select("a", "b").join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(
            texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")
        return written(both.mapInArrow(lean(_verified(words, least)), "a long, b long"))

    def pairs_of(frame: DataFrame, x: str, y: str) -> DataFrame:
        return frame.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()

    def mixed(labels: DataFrame) -> DataFrame:
        """Members of the buckets that hold several components, and each bucket's main one."""
        placed = shared.join(labels.select(F.col("id").alias("node"), "label"), "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
        sizes = placed.groupBy("bucket", "label").agg(F.count("*").alias("n"))
        main = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("labels")).where("labels > 1").drop("labels")
        return written(split_join(placed, main, ["bucket"]))

    # every member with its bucket's pivot: first with one pivot for each node, one that many nodes share, then with those
    # that are still in another component
    members = shared.where("node != pivot")
    tried = written(pairs_of(members.groupBy("node").agg(F.min_by("pivot", F.xxhash64("pivot")).alias("pivot")), "node", "pivot"))
    links = verified(tried)
    placed = components(links)
    apart = pairs_of(members, "node", "pivot").join(tried, ["a", "b"], "left_anti")
    for end in ("a", "b"):
        apart = apart.join(placed.select(F.col("id").alias(end), F.col("label").alias(f"label_{end}")), end, "left")
    apart = written(apart.where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b"))
    links = links.union(verified(apart))
    tried = tried.union(apart)
    labels = components(links)

    # A node's odds: weight of the shingles that no other node of these buckets has, by the weight of the rest. The
    # similarity of two nodes is at most 1 / (1 + odds + odds), whatever they share, so most pairs need no look.
    open_ = mixed(labels)
    if open_.isEmpty():
        return classes(labels)
    several = open_.select(F.col("node").alias("id")).distinct()
    sparse = texts.join(several, "id").mapInArrow(lean(_shingle_rows(words)), "node long, shingle long, weight long")
    rare = sparse.groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node"), F.sum("weight").alias("weight")).where("n = 1")
    own = rare.groupBy("node").agg(F.sum("weight").alias("own"))
    total = nodes.select("node", "total")
    odds = several.select(F.col("id").alias("node")).join(total, "node").join(own, "node", "left").select("node", "total", F.coalesce("own", F.lit(0)).alias("own"))
    odds = written(odds.where("own < total").select("node", (F.col("own") / (F.col("total") - F.col("own"))).alias("odds")).where(F.col("odds") <= slack))

    # members outside the main component with the bucket's plainest node
    able = written(open_.join(odds, "node"))
    plainest = able.groupBy("bucket").agg(F.min_by(F.struct(F.col("node").alias("p"), F.col("label").alias("lp"), F.col("odds").alias("op")), F.struct("odds", "node")).alias("q")).select("bucket", "q.*")
    second = split_join(able, plainest, ["bucket"]).where((F.col("label") != F.col("lp")) & (F.col("odds") + F.col("op") <= slack))
    second = written(pairs_of(second, "node", "p").join(tried, ["a", "b"], "left_anti"))
    links = links.union(verified(second))
    labels = components(links)

    # what is left: pairs across components that the odds allow, pair by pair where few nodes hang together by buckets,
    # block by block where many do
    able = written(mixed(labels).join(odds, "node"))
    if able.isEmpty():
        return classes(labels)
    heads = able.groupBy("bucket").agg(F.min("node").alias("head"))
    clusters = components(split_join(able.select("bucket", "node"), heads, ["bucket"]).select(F.col("head").alias("a"), F.col("node").alias("b")))
    sizes = clusters.groupBy("label").agg(F.count("*").alias("size"))
    clusters = written(clusters.join(sizes, "label").select(F.col("id").alias("node"), F.col("label").alias("cluster"), "size"))
    near = able.join(clusters.where(F.col("size") <= small), "node")
    outside = near.where("label != main").select("bucket", F.col("node").alias("x"), F.col("label").alias("lx"), F.col("odds").alias("ox"))
    across = outside.join(near, "bucket").where((F.col("lx") != F.col("label")) & (F.col("ox") + F.col("odds") <= slack) & ((F.col("label") == F.col("main")) | (F.col("x") < F.col("node"))))
    third = pairs_of(across, "x", "node").join(tried, ["a", "b"], "left_anti").join(second, ["a", "b"], "left_anti")
    links = links.union(verified(written(third)))

    crowd = clusters.where(F.col("size") > small).withColumn("blocks", F.ceil(F.col("size") / block).cast("int")).withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    crowd = crowd.join(able.groupBy("node").agg(F.first("label").alias("label"), F.first("odds").alias("odds")), "node").join(nodes.select("node", "signature", "bands"), "node")
    crowd = crowd.join(texts.withColumnRenamed("id", "node"), "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    crowd = crowd.select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "label", "odds", "signature", "bands", "text")
    links = links.union(written(crowd.groupBy("cluster", "i", "j").applyInArrow(lean(_block_links(words, least, slack, bound, registers, bands)), "a long, b long")))
    labels = components(links)

    return classes(labels)
