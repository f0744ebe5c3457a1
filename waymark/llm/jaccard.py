"""Operator 3, n-gram Jaccard join as a metric-space join.

A document is the set of its word shingles; the distance 1 - intersection / union is a metric, and documents link when their similarity reaches
a threshold, here written as least / 100. Documents of equal sets are one node from the start.

1. Outer regions. Shingles are landmarks in one global order, those that few documents have first. If two sets link, at most
   k = n - ceil(n least / 100) shingles of the larger are missing from the other, so a set is replicated to the cells of its first
   k + 1 landmarks and linked sets meet in a cell. In a cell, pairs that the triangle inequality rules out are not joined: two sets
   are at least as many shingles apart as their distances to the empty set differ (their sizes), and as there are classes of
   shingles of which one has an odd and the other an even number. What is left joins cells to regions (connected
   components): a set lies in one region only, and regions are closed under linking.
2. Voronoi regions. A region too large for one task is cut: a few of its sets are pivots, and every set goes to the region of its
   nearest pivot, and by the triangle inequality also to that of every pivot at most twice the threshold distance further away, where
   a linked set could have gone. This recurs; a region in which that wouldn't halve the work (its sets are about equally far from one another)
   is cut into blocks of which every two meet in a task.
3. Inside a task, sets are compared exactly. Each set is a pivot in its turn: its distances to all others are one vector
   operation; others of unsuitable size, or outside the window |d(p,x) - d(p,y)| <= threshold of an earlier pivot p, need no
   comparison. Every link is found, and counted once however often its sets meet: in the region whose pivot is
   nearest to the set of the lesser name (its home), of blocks in the one task that holds both.

Tasks return each set's local root and number of links, so what they return grows with the sets, not the pairs; the roots are
then joined to components. Where links aren't asked for, sets already connected aren't compared. The order of landmarks is a matter of speed only: a third of the shingles is counted, and at most `heavy` of the most frequent of those go last.

Cases: null and empty texts and texts without words have an empty set, size 0, and link with nothing; fewer words than a
shingle make one shingle; equal documents and rows that repeat an id link by their sets; a component's id is the least id that is not null;
texts of any length are taken whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from waymark.llm.common import LOWER, Words, forget, let_go, mix, slices, stored
from waymark.llm.components import components
from waymark.llm.repeats import keyed

#: Parts of the shingles that are counted for the order.
COUNTED = np.uint64(3)


#: Odd factors of the words of a shingle, by place, and what stands for a word after the end of a text that is shorter than a shingle.
PLACES = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
NO_WORD = np.uint64(0x8EBC6AF09C88C6E3)


def shingles(batch: list, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text as sorted names, one text after the other, and where each text's begin. A shingle's name is a mixed sum of its words' hashes, each times the factor of its place."""
    words = Words(batch, LOWER)
    word, _ = words.names()
    count = np.where(words.count == 0, 0, np.maximum(1, words.count - k + 1))
    doc = np.repeat(np.arange(len(batch)), count)
    at = words.first[:-1][doc] + np.arange(len(doc)) - (np.cumsum(count) - count)[doc]
    stop = words.first[1:][doc]
    with np.errstate(over="ignore"):
        name = word[at] * PLACES[0]
        for j in range(1, k):
            inside = at + j < stop
            name += np.where(inside, word[np.where(inside, at + j, at)], NO_WORD) * PLACES[j % len(PLACES)]
    name = mix(name)
    order = np.lexsort((name, doc))
    name, doc = name[order], doc[order]
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
    name, doc = name[new], doc[new]
    return name, np.searchsorted(doc, np.arange(len(batch) + 1))


def node_of(name: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two names of each set, of 64 bits: sums of two hashes of its shingles."""
    out = []
    for salt in (np.uint64(0x9E6C63D0876A9A47), np.uint64(0xC2B2AE3D27D4EB4F)):
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(name ^ salt))])
            out.append(mix(sums[cut[1:]] - sums[cut[:-1]] + np.diff(cut).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def told_apart(node: np.ndarray, second: np.ndarray, clashes: np.ndarray) -> np.ndarray:
    """The first name, or the second where the first is one of several sets': so 128 bits tell sets apart."""
    return np.where(np.isin(node, clashes), second, node) if len(clashes) else node


def missing(n: np.ndarray, least: int) -> np.ndarray:
    """Shingles that a set of size n may have and a linked set lack."""
    return n - -(-n * least // 100)


#: Classes of shingles in a sketch of sets below so many shingles, and of larger ones: a fifth of the set's size, so that sets without likeness differ in more classes than linked ones in shingles.
CLASSES = ((3500, 1024), (14_000, 4096), (1 << 62, 16_384))
BASE = CLASSES[0][1] // 8


def sketches(name: np.ndarray, cut: np.ndarray) -> list[bytes]:
    """A bit for each class of shingles: whether the set has an odd number of them. Two sets differ in at least as many shingles as their sketches differ in bits."""
    out, value = [], (mix(name) >> np.uint64(40)).astype(np.int64)
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        classes = next(c for n, c in CLASSES if hi - lo < n)
        out.append(np.packbits((np.bincount(value[lo:hi] % classes, minlength=classes) & 1).astype(np.uint8)).tobytes())
    return out


def fold(sketch: bytes, size: int) -> np.ndarray:
    """The sketch of fewer classes: those that are equal modulo the smaller number are one."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint8).reshape(-1, size), axis=0)


def _near_enough(n1, n2: np.ndarray, bits1: np.ndarray, bits2: np.ndarray, full1, full2: np.ndarray, least: int) -> np.ndarray:
    """False only for sets that can't link: by their sizes, or as they differ in more shingles than linked sets of these sizes do. Of linked sets, union - intersection is at most (100 - least) / (100 + least) of the sum of sizes. Folded sketches are compared first, whole ones of large sets after."""
    most = (100 - least) * (n1 + n2) // (100 + least)
    ok = (100 * np.minimum(n1, n2) >= least * np.maximum(n1, n2)) & (np.bitwise_count(bits1 ^ bits2).sum(-1, dtype=np.int64) <= most)
    for i in np.flatnonzero(ok):
        x, y = full1[i] if isinstance(full1, np.ndarray) else full1, full2[i]
        if (size := min(len(x), len(y))) > BASE:
            ok[i] = np.bitwise_count(fold(x, size) ^ fold(y, size)).sum(dtype=np.int64) <= most[i]
    return ok


#: Sets of a cell up to which a task compares sketches; larger cells link all their sets, and the regions are cut.
CELL = 4096


def _compatible(least: int):
    """Of rows sorted by landmark, links between sets of a cell that may be similar: not all of them, but as many as keep connected what they connect. A set is labelled by one it is connected to, and sets of equal labels need no link."""

    def cells(rows: list[np.ndarray], whole: bool):
        mark, node, n, bits, full = rows
        edge = np.concatenate([[0], np.flatnonzero(mark[1:] != mark[:-1]) + 1, [len(mark)]]) if len(mark) else np.zeros(1, np.int64)
        last = len(mark) if whole else edge[-2] if len(edge) > 1 else 0  # the last cell may go on in the next batch
        size = np.diff(edge[edge <= last])
        a, b = [], []
        label = np.arange(last)
        small = np.repeat(size <= 32, size)
        for k in range(1, min(32, int(size.max(initial=0)))):
            i = np.flatnonzero((mark[: last - k] == mark[k:last]) & small[: last - k])
            i = i[label[i] != label[i + k]]
            i = i[_near_enough(n[i], n[i + k], bits[i], bits[i + k], full[i], full[i + k], least)]
            label[i + k] = label[i]
            a.append(node[i]), b.append(node[i + k])
        for lo, m in zip(edge[:-1][: len(size)][size > 32], size[size > 32], strict=True):
            hi = lo + m
            for i in range(lo, hi - 1):
                j = np.arange(i + 1, hi)
                j = j[label[j] != label[i]]
                j = j[_near_enough(n[i], n[j], bits[i], bits[j], full[i], full[j], least)]
                label[j] = label[i]
                a.append(np.repeat(node[i], len(j))), b.append(node[j])
        pairs = (np.concatenate([*a, np.zeros(0, np.int64)]), np.concatenate([*b, np.zeros(0, np.int64)]))
        return pairs, [r[last:] for r in rows]

    def batch_of(pairs) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(p) for p in pairs], names=["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            raw = batch.column(3).to_pylist()
            full = np.empty(len(raw), object)
            full[:] = raw
            folded = np.array([fold(x, BASE) for x in raw], np.uint8).reshape(-1, BASE)
            fresh = [*[batch.column(i).to_numpy() for i in range(3)], folded, full]
            pairs, held = cells(fresh if held is None else [np.concatenate(x) for x in zip(held, fresh, strict=True)], False)
            yield batch_of(pairs)
        if held is not None:
            yield batch_of(cells(held, True)[0])

    return run


def _sets(shingle: int):
    def run(batches):
        for b in batches:
            for lo, n in slices(b.column(3)):
                name, cut = shingles(b.column(3).slice(lo, n).to_pylist(), shingle)
                node, second = node_of(name, cut)
                yield pa.RecordBatch.from_arrays([*[b.column(i).slice(lo, n) for i in range(3)], pa.array(node), pa.array(second), pa.array(np.diff(cut).astype(np.int64)), pa.array(list(sketches(name, cut)), pa.binary())], names=["k1", "k2", "doc_id", "node", "second", "n", "sketch"])

    return run


def _counted(shingle: int):
    def run(batches):
        for b in batches:
            for lo, n in slices(b.column(0)):
                name, _ = shingles(b.column(0).slice(lo, n).to_pylist(), shingle)
                yield pa.RecordBatch.from_arrays([pa.array(name[name % COUNTED == 0].view(np.int64))], names=["landmark"])

    return run


def landmarks(name: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """Rank of shingles in the global order: counted and not heavy, then not counted, then heavy; by name within."""
    at = np.minimum(np.searchsorted(heavy, name), max(0, len(heavy) - 1))
    last = heavy[at] == name if len(heavy) else np.zeros(len(name), bool)
    group = np.where(last, 2, np.where(name % COUNTED == 0, 0, 1)).astype(np.uint64)
    return group << np.uint64(62) | mix(name) >> np.uint64(2)


def _cells(shingle: int, least: int, shared):
    def run(batches):
        heavy, clashes = shared.value
        for b in batches:
            for lo, n in slices(b.column(0)):
                name, cut = shingles(b.column(0).slice(lo, n).to_pylist(), shingle)
                node, size = told_apart(*node_of(name, cut), clashes), np.diff(cut)
                doc = np.repeat(np.arange(n), size)
                order = np.lexsort((landmarks(name, heavy), doc))
                place = np.arange(len(name)) - cut[:-1][doc]
                # a set that may lack nothing links with equal sets only, unless a larger one may lack something
                near = (place <= missing(size, least)[doc]) & (missing(size + 1, least)[doc] > 0)
                yield pa.RecordBatch.from_arrays([pa.array(name[order][near].view(np.int64)), pa.array(node[doc[near]])], names=["landmark", "node"])

    return run


def _linked(inner: np.ndarray, a, b: np.ndarray, least: int) -> np.ndarray:
    return 100 * inner >= least * (a + b - inner)


def join_region(nodes: np.ndarray, sets: list[np.ndarray], least: int, windows: int = 8, copies: np.ndarray | None = None, home: np.ndarray | None = None, side: np.ndarray | None = None, count: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Local root (number of the set) and number of links found of each set of a region. Exact. nodes are in ascending order; a link counts as many times as the other set has copies.

    home: sets whose links to later ones are to be found here; side: sets of one side, unless -1, are compared elsewhere. Without count, sets already connected aren't compared."""
    m = len(sets)
    size = np.array([len(s) for s in sets])
    copies = np.ones(m, np.int64) if copies is None else copies
    home = np.ones(m, bool) if home is None else home
    side = np.full(m, -1) if side is None else side
    cut = np.concatenate([[0], np.cumsum(size)])
    code = np.unique(np.concatenate(sets), return_inverse=True)[1] if m else np.zeros(0, int)
    mark = np.zeros(code.max(initial=0) + 1, np.int32)
    root, links = np.arange(m), np.zeros(m, np.int64)
    reach = 1 - least / 100 + 1e-9
    seen: list[np.ndarray] = []
    for p in np.flatnonzero(home[:-1]):
        rest = np.arange(p + 1, m)
        small, large = np.minimum(size[p], size[rest]), np.maximum(size[p], size[rest])
        ok = (100 * small >= least * large) & ((side[p] < 0) | (side[rest] != side[p]))
        if not count:
            ok &= root[rest] != root[p]
        for d in seen:
            ok &= np.abs(d[rest] - d[p]) <= reach
        rest = rest[ok]
        if not len(rest):
            continue
        mark[code[cut[p] : cut[p + 1]]] = 1
        if len(seen) < windows:  # a pivot's distances to all others, for windows of the others
            inner = np.add.reduceat(mark[code], cut[:-1]).astype(np.int64)
            seen.append(1 - inner / (size + size[p] - inner))
            inner = inner[rest]
        elif 2 * len(rest) > m - p:  # most of the later ones: in one stretch
            inner = np.add.reduceat(mark[code[cut[p] :]], cut[p:-1] - cut[p]).astype(np.int64)[rest - p]
        else:
            part = np.concatenate([code[cut[r] : cut[r + 1]] for r in rest])
            inner = np.add.reduceat(mark[part], np.concatenate([[0], np.cumsum(size[rest])[:-1]])).astype(np.int64)
        mark[code[cut[p] : cut[p + 1]]] = 0
        hit = rest[_linked(inner, size[p], size[rest], least)]
        if len(hit):
            links[p] += copies[hit].sum()
            links[hit] += copies[p]
            joined = np.unique(root[hit])
            if len(joined) > 1 or joined[0] != root[p]:
                root[np.isin(root, joined)] = root[p]
    return root, links


def _in_task(least: int, count: bool):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        # sets of equal node may come twice (rows of equal id and text): one of each is enough
        nodes = table.column("node").to_numpy()
        _, first = np.unique(nodes, return_index=True)
        column = table.column("shingles").combine_chunks()
        values, cut = column.flatten().to_numpy(), column.offsets.to_numpy()
        values, cut = values, cut - cut[0]
        sets = [values[cut[i] : cut[i + 1]] for i in first]
        copies, home, side = (table.column(c).to_numpy()[first] for c in ("copies", "home", "side"))
        own = nodes[first]
        root, links = join_region(own, sets, least, copies=copies, home=home.astype(bool), side=side, count=count)
        told = (root != np.arange(len(first))) | (links > 0)
        return pa.table({"a": pa.array(own[told]), "b": pa.array(own[root[told]]), "links": pa.array(links[told])})

    return run


#: Columns of the sets of regions: copies is the number of rows of a set, home and side as in join_region.
MEMBER = {"region": pa.int64(), "node": pa.int64(), "n": pa.int64(), "shingles": pa.list_(pa.int64()), "copies": pa.int64(), "home": pa.bool_(), "side": pa.int64()}


def _to_pivots(least: int):
    """Of rows sorted by region and pile, each pile led by the candidates for pivots of its region: members of the pivots' cells. A region that no pivots halve the work of stays as it is, with side STUCK."""
    reach = 2 * (1 - least / 100) + 1e-9

    def distances(values: np.ndarray, cut: np.ndarray, p: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(p, values), len(p) - 1)
        inner = np.add.reduceat((p[at] == values).astype(np.int64), cut[:-1])
        return 1 - inner / (np.diff(cut) + len(p) - inner)

    def chosen_pivots(candidates: list[tuple[int, np.ndarray]]) -> list[int]:
        """Candidates that are further from each other than twice the window. None, if cells of these, judged by where the candidates would go, are more than half the work of the region."""
        own = np.concatenate([p for _, p in candidates])
        ends = np.concatenate([[0], np.cumsum([len(p) for _, p in candidates])])
        apart = np.array([distances(own, ends, p) for _, p in candidates])
        kept: list[int] = []
        for i in np.argsort([node for node, _ in candidates], kind="stable").tolist():
            if (apart[i, kept] > 2 * reach).all():
                kept.append(i)
        np.fill_diagonal(apart, np.inf)  # a pivot is judged by the cells of the others, as a set that is none would be
        goes = apart[kept] <= apart[kept].min(0) + reach
        return kept if (goes.mean(1) ** 2).sum() <= 0.5 else []

    def cells(table: pa.Table, candidates: list[tuple[int, np.ndarray]]) -> pa.Table:
        column = table.column("shingles").combine_chunks()
        cut = column.offsets.to_numpy()
        values, cut = column.flatten().to_numpy(), cut - cut[0]
        chosen = chosen_pivots(candidates)
        if not chosen:
            return table.set_column(table.schema.get_field_index("side"), "side", pa.array(np.full(len(table), STUCK)))
        pivots = [candidates[i] for i in chosen]
        d = np.array([distances(values, cut, p) for _, p in pivots])
        nodes = np.array([node for node, _ in pivots])
        pivot, row = np.nonzero(d <= d.min(0) + reach)
        nearest = d.argmin(0)
        out = table.take(pa.array(row))
        region = mix(out.column("region").to_numpy().view(np.uint64) ^ mix(nodes[pivot].view(np.uint64))).view(np.int64)
        home = out.column("home").to_numpy(zero_copy_only=False) & (nearest[row] == pivot)
        return out.set_column(0, "region", pa.array(region)).set_column(5, "home", pa.array(home))

    def run(batches):
        pile, pivots = None, []
        for batch in batches:
            mark = np.stack([batch.column(i).to_numpy() for i in (0, len(MEMBER))])
            edge = np.concatenate([[0], np.flatnonzero((mark[:, 1:] != mark[:, :-1]).any(0)) + 1, [batch.num_rows]])
            for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                part = pa.Table.from_batches([batch.slice(lo, hi - lo)])
                if pile != (here := tuple(mark[:, lo].tolist())):
                    pile, pivots = here, []
                leads = part.column("leads").to_numpy(zero_copy_only=False)
                k = int(leads.sum())  # candidates come first
                pivots += [(node, np.sort(np.array(p, np.int64))) for node, p in zip(part.column("node").slice(0, k).to_pylist(), part.column("shingles").slice(0, k).to_pylist(), strict=True)]
                if k < len(part):
                    yield from cells(part.slice(k).select(list(MEMBER)), pivots).to_batches()

    return run


#: A side of sets whose region pivots don't cut. Members of a pile.
STUCK, PILE = -2, 1000


#: Shingles of all sets that a task holds at once.
HELD = 4_000_000
#: Sets in large regions up to which their keys are broadcast.
FEW = 500_000


def _too_large(members: DataFrame, work: int) -> DataFrame:
    """Regions whose sets times shingles exceed work, or that hold more shingles than a task's memory is for: region, m, total, over (by how much)."""
    size = members.groupBy("region").agg(F.count("*").alias("m"), F.sum("n").alias("total"))
    over = F.greatest(F.col("m").cast("double") * F.col("total") / work, F.pow(F.col("total") / min(HELD, work), F.lit(2.0)))
    return size.withColumn("over", over).where("over > 1 and m > 1")


def cut_regions(members: DataFrame, least: int, work: int, rounds: int = 3, pivots: int = 16) -> DataFrame:
    """members (columns MEMBER) with regions cut so that sets times shingles of each is at most work: by pivots, then into blocks. A large region is dealt over piles, to each of which its pivots go, so no task holds a region."""
    done, blocked = [], []
    for k in range(rounds + 1):
        size = stored(_too_large(members, work), f"jaccard-large{k}")
        if size.isEmpty():
            break
        done.append(members.join(size, "region", "left_anti"))
        large = members.join(size, "region")
        if k == rounds:
            blocked.append(large)
            members = members.where("false")
            break
        stuck = large.where(F.col("side") == STUCK)
        blocked.append(stuck)
        dealt = large.where(F.col("side") != STUCK).withColumn("piles", F.ceil(F.col("m") / PILE))
        chosen = dealt.where(F.pmod(F.xxhash64("node", F.lit(k)), F.col("m")) < 2 * pivots)
        leads = chosen.withColumn("pile", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("piles") - 1)))
        rows = dealt.withColumn("pile", F.pmod(F.xxhash64("node", F.lit("pile")), F.col("piles")))
        has = chosen.select("region").distinct()
        whole = rows.join(has, "region", "left_anti").select(*MEMBER)  # no pivot by chance: stays for the next round
        both = leads.select(*MEMBER, "pile", F.lit(True).alias("leads")).unionByName(rows.join(has, "region", "left_semi").select(*MEMBER, "pile", F.lit(False).alias("leads")))
        fresh = both.repartition("region", "pile").sortWithinPartitions("region", "pile", F.desc("leads")).mapInArrow(_to_pivots(least), members.schema)
        members = stored(fresh.unionByName(whole), f"jaccard-cut{k}")
    for large in blocked:
        met = large.withColumn("blocks", 2 * F.ceil(F.sqrt("over"))).withColumn("own", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")))
        met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        side = F.when(F.col("own") == F.col("other"), F.lit(-1)).otherwise(F.col("own")).cast("bigint").alias("side")
        members = members.unionByName(met.select(F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other")).alias("region"), "node", "n", "shingles", "copies", "home", side))
    for part in done:
        members = members.unionByName(part.select(*members.columns).withColumn("side", F.greatest("side", F.lit(-1).cast("bigint"))))
    return members


def _least_count(counts: DataFrame, heavy: int) -> int:
    """The least count that at most `heavy` landmarks reach. From the number of landmarks by count in steps of a sixteenth of a power of two, which is a short list at any size of corpus."""
    step = F.floor(F.log2("count") * 16)
    tally = sorted(((r["step"], r["n"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, total = 1 << 62, 0
    for at, n in tally:
        total += n
        if total > heavy:
            break
        least = int(np.ceil(2 ** (at / 16)))
    return least


def jaccard_components(docs: DataFrame, shingle: int = 3, least: int = 90, heavy: int = 131_072, work: int = 400_000_000, id_col: str = "doc_id", text_col: str = "text", links: bool = True) -> DataFrame:
    """k1, k2 (keys of rows as from keyed()), doc_id, n_shingles, node (the set), root (a node that stands for its component), component_id (least doc_id that is reachable by links), and, unless links is false, n_links (the other rows that the row links with). work: sets times shingles that one task compares."""
    spark = docs.sparkSession
    base = keyed(docs, id_col, text_col)
    fields = StructType.fromDDL("k1 long, k2 int, doc_id int, node long, second long, n long, sketch binary").fields
    fields[2] = base.schema["doc_id"]
    sets = every = stored(base.mapInArrow(_sets(shingle), StructType(fields)), "jaccard-sets")
    # names of two sets that are one by chance: at 10^10 sets 3 are expected
    clashes = sets.groupBy("node").agg(F.min("second").alias("a"), F.max("second").alias("z")).where("a <> z").select("node").toPandas()["node"].to_numpy(np.int64)
    sets = sets.withColumn("node", F.when(F.col("node").isin(clashes.tolist()), F.col("second")).otherwise(F.col("node"))) if len(clashes) else sets
    sets = sets.drop("second")
    known = base.where("text is not null").select("text")
    counts = stored(known.mapInArrow(_counted(shingle), "landmark long").groupBy("landmark").count().where("count > 7"), "jaccard-counts")
    often = counts.where(F.col("count") >= _least_count(counts, heavy)).select("landmark").toPandas()
    shared = spark.sparkContext.broadcast((np.sort(often["landmark"].to_numpy(np.int64).view(np.uint64)), clashes))  # at most `heavy` numbers
    let_go(spark)
    cells = stored(known.mapInArrow(_cells(shingle, least, shared), "landmark long, node long"), "jaccard-cells")
    meet = cells.groupBy("landmark").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").select("landmark")
    shared_cells = stored(cells.join(meet, "landmark", "left_semi").distinct(), "jaccard-shared")
    forget(counts, cells)
    let_go(spark)
    hot = shared_cells.groupBy("landmark").agg(F.count("*").alias("m"), F.min("node").alias("a")).where(F.col("m") > CELL).select("landmark", "a")
    sketched = sets.groupBy("node").agg(F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch"))
    small = shared_cells.join(hot, "landmark", "left_anti").join(sketched, "node").select("landmark", "node", "n", "sketch").repartition("landmark").sortWithinPartitions("landmark", "n", "node")
    near = small.mapInArrow(_compatible(least), "a long, b long").unionByName(shared_cells.join(hot, "landmark").where("node <> a").select("a", F.col("node").alias("b")))
    near = stored(near.distinct(), "jaccard-near")
    let_go(spark)
    forget(shared_cells)
    regions = stored(components(near, "jaccard-regions"), "jaccard-regions")
    forget(near)
    let_go(spark)
    one = sets.groupBy("node").agg(F.min(F.struct("k1", "k2", "n")).alias("one"), F.count("*").alias("copies"))
    members = regions.join(one, "node").select("one.k1", "one.k2", "node", "one.n", F.col("root").alias("region"), "copies")

    def filled(batches):
        for b in batches:
            for lo, n in slices(b.column(3)):
                name, cut = shingles(b.column(3).slice(lo, n).to_pylist(), shingle)
                own = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(name.view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, n), b.column(1).slice(lo, n), b.column(2).slice(lo, n), own, b.column(4).slice(lo, n), pa.array(np.ones(n, bool)), pa.array(np.full(n, -1))], names=list(MEMBER))

    # the sizes of regions are known before any set travels: only the sets of regions that are too large are stored, to be cut
    large = stored(_too_large(members, work), "jaccard-large")
    fill = lambda part: base.join(part, ["k1", "k2"]).select("region", "node", "n", "text", "copies").mapInArrow(filled, "region long, node long, n long, shingles array<long>, copies long, home boolean, side long")
    if large.isEmpty():
        ready = fill(members)
    else:
        part = members.join(large.select("region"), "region", "left_semi")
        if large.agg(F.sum("m")).first()[0] <= FEW:  # their keys, some 50 bytes each, go to the texts, so that these don't travel once more
            part = F.broadcast(part)
        cut = cut_regions(stored(fill(part), "jaccard-members"), least, work)
        ready = fill(members.join(large.select("region"), "region", "left_anti")).unionByName(cut)
    # rows that agree in id and text share a key and give a set twice, which the task sees to
    linked = stored(ready.groupBy("region").applyInArrow(_in_task(least, links), "a long, b long, links long"), "jaccard-links")
    let_go(spark)
    found = components(linked.where("a <> b").select("a", "b"), "jaccard-components")
    if links:  # nodes of which more than the name is to be told; copies of a set link with one another
        copied = sets.where("n > 0").groupBy("node").agg((F.count("*") - 1).alias("links")).where("links > 0")
        total = linked.select(F.col("a").alias("node"), "links").unionByName(copied).groupBy("node").agg(F.sum("links").alias("n_links"))
        found = total.join(found, "node", "full")
    rooted = stored(sets.drop("sketch").join(found, "node", "left").withColumn("root", F.coalesce("root", "node")), "jaccard-rooted")
    forget(every, regions, linked)
    first = stored(rooted.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("first")), "jaccard-first")
    # sets without shingles stay apart, whatever their number
    more = [F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")] if links else []
    return rooted.join(first, "root", "left").select("k1", "k2", "doc_id", F.col("n").alias("n_shingles"), "node", "root", F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("doc_id")).alias("component_id"), *more)


def keep_one(docs: DataFrame, shingle: int = 3, least: int = 90, id_col: str = "doc_id") -> DataFrame:
    """docs with one row of each component: that of the least id, of equal ids of the least keys. Rows without shingles all stay. All columns stay."""
    found = jaccard_components(docs, shingle, least, id_col=id_col, links=False)
    # one row per component by aggregates with partial sums, of few columns
    one = F.min(F.struct("doc_id", "k1", "k2")).alias("one")
    keep = found.where("n_shingles > 0").groupBy("root", "node").agg(one).groupBy("root").agg(F.min("one").alias("one")).select("one.k1", "one.k2")
    empty = found.where("n_shingles = 0").select("k1", "k2").distinct()
    rows = keyed(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("id"), F.col("text").alias("t")), "id", "t", "row")
    first = rows.join(keep, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])  # rows that agree in id and text
    return first.unionByName(rows.join(empty, ["k1", "k2"], "left_semi")).select("row.*")
