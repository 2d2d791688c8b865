"""Approximate nearest neighbours by inner product: NN-descent graphs of shards, searched greedily from many queries at once.

Equal vectors are one node.  The graph is by distance after the vectors were made
equally long by one more component, so that nearness by inner product is nearness
on the graph.  Nodes are dealt into blocks of like vectors, of bounded size, and
numbered in them, so that a number tells the block.  Blocks exchange rows that
hold arrays, one for each pair of blocks that have something to tell each other;
a node's share of them is bounded by the parameters, whatever the number of nodes.
Vectors travel as 8-bit steps from the centre of their block; results are scored
from the original ones.

A shard is a bounded share of the nodes, drawn by a hash, with a graph of its own, so
that the graph is as good among many nodes as among few, and a search meets a
shard's vectors and lists in one task.  Every query is searched in every shard, and the
nearest of all are merged: searching grows with queries times shards.

A graph starts from leaves of random projection trees, in which all are compared.  In each round
every node tells those that it lists, vectors go to where they are neighbours, and a
node's neighbours, on either side, are joined with each other; what is nearer than
what they have is offered to them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import dropped, written
from .words import U, mix


@dataclass(frozen=True)
class Params:
    degree: int = 32  # neighbours of a node
    reverse: int = 32  # nodes that have it as neighbour, in a round and in the search
    shard: int = 65536  # nodes of a shard, about
    block: int = 1024  # nodes of a block
    cell: int = 8192  # nodes of a cell, which is cut into leaves
    leaf: int = 8192  # nodes of a leaf, among which the graph starts
    dealings: int = 4  # of nodes to leaves
    sample: int = 2048  # vectors that the driver draws planes from
    rounds: int = 8
    stop: float = 0.02  # ends the rounds when fewer of all neighbours are new
    offers: int = 8  # that a block makes to a node in a round
    entries: int = 2048  # nodes of a shard that a query's search may start from,
    longest: int = 64  # and so many of the longest
    beam: int = 256  # half of it, if there are several shards
    expand: int = 48  # nodes of a query that are expanded in a round
    search_rounds: int = 10
    query_block: int = 4096  # queries of a part at most,
    parts: int = 12  # which are so many at least, if that leaves 256 in each
    apart: int = 256  # at most so many vectors are scored beside the graph,
    longer: float = 1e6  # those so many times longer than the longest in it


#: Bits of a node's number in its block, and of a part's number in its cell.
BITS = 20
INDEX = (1 << BITS) - 1

# what a row of MESSAGE is
STATE, REQUEST, REVERSE, OFFER, VECTORS = range(5)
MESSAGE = "dest bigint, kind int, codes binary, nodes array<bigint>, scales array<float>, centre array<float>, bounds array<float>, ends array<int>, links array<bigint>, sims array<float>, fresh array<boolean>"
ARRAYS = {"nodes": pa.int64(), "scales": pa.float32(), "centre": pa.float32(), "bounds": pa.float32(), "ends": pa.int32(), "links": pa.int64(), "sims": pa.float32(), "fresh": pa.bool_()}


def told(rows: list[dict]) -> pa.Table:
    """Rows of MESSAGE; arrays that are left out are null."""
    return pa.table({"dest": pa.array([r["dest"] for r in rows], pa.int64()), "kind": pa.array([r["kind"] for r in rows], pa.int32()), "codes": pa.array([r.get("codes") for r in rows], pa.binary()), **{c: pa.array([r.get(c) for r in rows], pa.list_(kind)) for c, kind in ARRAYS.items()}})


def heard(table: pa.Table | pa.RecordBatch) -> list[dict]:
    """The rows of MESSAGE, their arrays as NumPy's."""
    out = [{"dest": d, "kind": k, "codes": c} for d, k, c in zip(*(table.column(n).to_pylist() for n in ("dest", "kind", "codes")), strict=True)]
    for c in ARRAYS:
        column = table.column(c)
        for row, x in zip(out, column, strict=True):
            if x.is_valid:
                row[c] = x.values.to_numpy(zero_copy_only=False)
    return out


def of_kind(rows: list[dict], kind: int) -> list[dict]:
    return [r for r in rows if r["kind"] == kind]


def joined(rows: list[dict], column: str, kind: type) -> np.ndarray:
    return np.concatenate([r[column] for r in rows]).astype(kind, copy=False) if rows else np.zeros(0, kind)


def parts(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each distinct key with its places."""
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    values, first = np.unique(keys[order], return_index=True)
    yield from zip(values.tolist(), np.split(order, first[1:]), strict=True)


def leading(groups: np.ndarray, most: int) -> np.ndarray:
    """Mask over sorted groups: the first `most` of each."""
    return np.arange(len(groups)) - np.searchsorted(groups, groups) < most


def norms(x: np.ndarray) -> np.ndarray:
    return np.square(x.astype(np.float64)).sum(-1)


def nearness(dots: np.ndarray, a: np.ndarray, b: np.ndarray, top: float) -> np.ndarray:
    """Minus half the squared distance of vectors whose squared lengths a and b were made up to top; written so that long vectors don't drown short ones."""
    if min(a.min(initial=top), b.min(initial=top)) >= top * (1 - 1e-7):  # equally long to float32's last place, as normalised vectors are
        return np.minimum(dots - np.float32(top), 0).astype(np.float32, copy=False)
    return np.minimum(dots - (top * (a + b) - a * b) / (top + np.sqrt(np.maximum(top - a, 0) * np.maximum(top - b, 0))), 0).astype(np.float32)


def usable(c: Column) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return c.isNotNull() & (F.size(c) > 0) & ~bad & F.exists(c, lambda x: x != 0)


def planes_for(n: int, most: int) -> int:
    """How many planes cut n vectors into cells of about `most`."""
    return max(0, math.ceil(math.log2(max(n, 1) / most)))


def dealt(vectors: DataFrame, sample: np.ndarray, n: int, most: int, seed: int) -> DataFrame:
    """vectors(g, ...) with the column p: cells of like vectors of a shard g, of about n, cut by random planes, in parts of about `most` rows at most.

    A plane lies between two vectors of the sample, in its middle.  A cell that
    is too full for all that, as of vectors that hardly differ, is dealt by a hash.
    """
    bits = planes_for(n, most)
    rng = np.random.default_rng(seed)
    at = rng.integers(0, max(len(sample), 1), (2, bits))
    planes = (sample[at[0]] - sample[at[1]]).astype(np.float32) if len(sample) else np.zeros((0, 1), np.float32)
    flat = np.abs(planes).sum(1) == 0
    planes[flat] = rng.normal(size=(int(flat.sum()), planes.shape[1]))
    middle = np.median(sample @ planes.T, 0) if len(sample) else np.zeros(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(batch.schema.get_field_index("vec")).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            cell = ((x @ planes.T > middle) << np.arange(bits)).sum(1) if bits else np.zeros(batch.num_rows, np.int64)
            cell = cell.astype(np.int64) | batch.column("g").to_numpy().astype(np.int64) << bits
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "p"])

    celled = vectors.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema) + ", p bigint")
    full = celled.groupBy("p").agg(F.ceil(F.count("*") / most).alias("_parts"))
    part = F.pmod(F.xxhash64("id", F.lit(seed)), F.col("_parts"))
    return celled.join(full, "p").withColumn("p", F.col("p") * (1 << BITS) + part).drop("_parts")


def coded(x: np.ndarray) -> dict:
    """Vectors as steps from their median, which a few long ones don't move, each with a scale of its own, so that like vectors stay apart."""
    centre = np.median(x, 0).astype(np.float32)
    rest = x - centre
    scales = np.abs(rest).max(1) / 127
    scales[scales == 0] = 1
    return {"codes": np.rint(rest / scales[:, None]).astype(np.int8).tobytes(), "scales": scales.astype(np.float32), "centre": centre}


def codes_of(row: dict) -> np.ndarray:
    return np.frombuffer(row["codes"], np.int8).reshape(len(row["scales"]), -1)


def decoded(row: dict) -> np.ndarray:
    return codes_of(row) * row["scales"][:, None] + row["centre"]


def some(row: dict, at: np.ndarray) -> dict:
    """The vectors of a row at some places."""
    return {"codes": codes_of(row)[at].tobytes(), "scales": row["scales"][at], "centre": row["centre"]}


def packed(vectors: DataFrame, p: Params) -> DataFrame:
    """A STATE row for each block of vectors(p, node, vec): vectors by node, and no neighbours yet."""

    def run(key: tuple, part: pa.Table) -> pa.Table:
        order = np.argsort(part["node"].to_numpy())
        n = len(order)
        x = part["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)[order]
        return told([{"dest": key[0].as_py(), "kind": STATE, **coded(x), "links": np.full(n * p.degree, -1), "sims": np.full(n * p.degree, -np.inf, np.float32), "fresh": np.zeros(n * p.degree, bool)}])

    return vectors.select("p", "node", "vec").groupBy("p").applyInArrow(run, MESSAGE)


def opened(row: dict, degree: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(links, sims, fresh) of a STATE row, a row a node."""
    return tuple(row[c].reshape(-1, degree) for c in ("links", "sims", "fresh"))


def offered(u: np.ndarray, v: np.ndarray, s: np.ndarray) -> list[dict]:
    """OFFER rows: v to u, as near as s."""
    return [{"dest": to, "kind": OFFER, "ends": (u[k] & INDEX).astype(np.int32), "links": v[k], "sims": s[k]} for to, k in parts(u >> BITS)]


def started(vectors: DataFrame, p: Params, top: float, seed: int) -> DataFrame:
    """OFFER rows: the nearest of each node of vectors(p, node, vec) in its leaf of a tree of random planes through the cell p."""

    def run(key: tuple, part: pa.Table) -> pa.Table:
        ids = part["node"].to_numpy()
        x = part["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        length, rng = norms(x), np.random.default_rng([seed, key[0].as_py()])
        stack, found = [np.arange(len(ids))], []
        while stack:
            at = stack.pop()
            if len(at) > p.leaf:
                a, b = x[rng.choice(at, 2, replace=False)]
                half = np.argpartition(x[at] @ (a - b), len(at) // 2)
                stack += [at[half[: len(at) // 2]], at[half[len(at) // 2 :]]]
                continue
            most = min(p.degree, len(at) - 1)
            for a in range(0, len(at), 256):  # all of a leaf with all of it, in strips that stay small
                mine = at[a : a + 256]
                s = nearness(x[mine] @ x[at].T, length[mine][:, None], length[at], top)
                s[np.arange(len(mine)), np.arange(a, a + len(mine))] = -np.inf
                near = np.argpartition(s, min(len(at) - most, len(at) - 1), axis=1)[:, len(at) - most :]
                found.append((np.repeat(ids[mine], most), ids[at][near].ravel(), np.take_along_axis(s, near, 1).ravel()))
        u, v, s = (np.concatenate(c) for c in zip(*found, strict=True))
        return told(offered(u, v, s))

    return vectors.select("p", "node", "vec").groupBy("p").applyInArrow(run, MESSAGE)


def merged(state: DataFrame, offers: DataFrame, p: Params) -> DataFrame:
    """STATE rows with the nearest of what each node has and is offered; fresh tells those that were only offered."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = heard(table)
        own, came = of_kind(rows, STATE)[0], of_kind(rows, OFFER)
        links, sims, _ = opened(own, p.degree)
        n = len(links)
        u = np.append(np.repeat(np.arange(n), p.degree), joined(came, "ends", np.int64))
        v, s = np.append(links.ravel(), joined(came, "links", np.int64)), np.append(sims.ravel(), joined(came, "sims", np.float32))
        new = np.arange(len(u)) >= links.size
        order = np.lexsort((new, v, u))
        order = order[v[order] >= 0]
        once = np.ones(len(order), bool)
        once[1:] = (u[order][1:] != u[order][:-1]) | (v[order][1:] != v[order][:-1])
        order = order[once]
        order = order[np.lexsort((v[order], -s[order], u[order]))]
        order = order[leading(u[order], p.degree)]
        slot = np.arange(len(order)) - np.searchsorted(u[order], u[order])
        to = u[order] * p.degree + slot
        links, sims, fresh = np.full(n * p.degree, -1), np.full(n * p.degree, -np.inf, np.float32), np.zeros(n * p.degree, bool)
        links[to], sims[to], fresh[to] = v[order], s[order], new[order]
        return told([own | {"links": links, "sims": sims, "fresh": fresh}])

    return state.unionByName(offers).groupBy("dest").applyInArrow(run, MESSAGE)


def requests(state: DataFrame, p: Params) -> DataFrame:
    """REQUEST rows: which nodes of a block list which of another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in heard(batch):
                links, _, fresh = opened(row, p.degree)
                who, slot = np.nonzero(links >= 0)
                to, out = links[who, slot], []
                for dest, k in parts(to >> BITS):
                    nodes, at = np.unique(who[k], return_inverse=True)
                    out.append({"dest": dest, "kind": REQUEST, "nodes": row["dest"] << BITS | nodes, "ends": at.astype(np.int32), "links": to[k], "fresh": fresh[who[k], slot[k]]})
                yield from told(out).to_batches()

    return state.mapInArrow(run, MESSAGE)


def thinned(asked: list[dict], most: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node's place in the block, who lists it, fresh) of REQUEST rows: at most `most` of each node, new ones first, else by a hash."""
    who = np.concatenate([r["nodes"][r["ends"]] for r in asked]) if asked else np.zeros(0, np.int64)
    to, fresh = joined(asked, "links", np.int64) & INDEX, joined(asked, "fresh", bool)
    order = np.lexsort((mix(who.astype(U) ^ U(seed << 40) ^ to.astype(U) << U(50)), ~fresh, to))
    order = order[leading(to[order], most)]
    return to[order], who[order], fresh[order]


def answers(state: DataFrame, asked: DataFrame, p: Params, seed: int) -> DataFrame:
    """A REVERSE row for each block, of who lists its nodes, and VECTORS rows to where a node lists one of the block's, or is listed by one."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = heard(table)
        asked, here, own = of_kind(rows, REQUEST), key[0].as_py(), of_kind(rows, STATE)[0]
        links, sims, _ = opened(own, p.degree)
        to, who, fresh = thinned(asked, p.reverse, seed)
        out = [{"dest": here, "kind": REVERSE, "ends": to.astype(np.int32), "links": who, "fresh": fresh}]
        lister, slot = np.nonzero(links >= 0)
        dest = np.concatenate([links[lister, slot] >> BITS, *(np.full(len(r["links"]), int(r["nodes"][0]) >> BITS) for r in asked)])
        node = np.concatenate([lister, *(r["links"] & INDEX for r in asked)])
        for block, k in parts(dest):
            nodes = np.unique(node[k])
            out.append({"dest": block, "kind": VECTORS, "nodes": here << BITS | nodes, "bounds": sims[nodes].min(1), **some(own, nodes)})
        return told(out)

    return state.unionByName(asked).groupBy("dest").applyInArrow(run, MESSAGE)


def offers(state: DataFrame, answered: DataFrame, p: Params, top: float) -> DataFrame:
    """OFFER rows: each node's neighbours, on either side, joined with each other, where one of a pair is new and near enough."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = heard(table)
        known, back = of_kind(rows, VECTORS), of_kind(rows, REVERSE)
        if not known:
            return told([])
        links, _, fresh = opened(of_kind(rows, STATE)[0], p.degree)
        ids, at = np.unique(joined(known, "nodes", np.int64), return_index=True)
        x, least = np.concatenate([decoded(r) for r in known])[at], joined(known, "bounds", np.float32)[at]
        length, n = norms(x), len(links)
        who = np.where(links >= 0, np.searchsorted(ids, links), -1)
        turned, new = np.full((n, p.reverse), -1), np.zeros((n, p.reverse), bool)
        to = joined(back, "ends", np.int64)
        slot = np.arange(len(to)) - np.searchsorted(to, to)
        turned[to, slot], new[to, slot] = np.searchsorted(ids, joined(back, "links", np.int64)), joined(back, "fresh", bool)
        who, fresh = np.hstack([who, turned]), np.hstack([fresh, new])
        # one key holds a node, the distance and another node, so that sorting puts the nearest first
        width = U(max(1, len(ids).bit_length()))
        precise = U(min(31, 64 - 2 * int(width)))
        kept, size = [], 0

        def squeeze() -> None:
            nonlocal kept, size
            keys = np.unique(np.concatenate(kept))
            kept, size = [keys[leading(keys >> (width + precise), p.offers)]], 0

        for a in range(0, n, 64):
            m = who[a : a + 64]
            y, there = x[m], m >= 0
            s = nearness(y @ y.transpose(0, 2, 1), length[m][:, :, None], length[m][:, None, :], top)
            new = fresh[a : a + 64] & there
            ok = (new[:, :, None] | new[:, None, :]) & there[:, :, None] & there[:, None, :] & (m[:, :, None] != m[:, None, :]) & (s > least[m][:, :, None])
            b, i, j = np.nonzero(ok)
            far = (0 - s[b, i, j]).view(np.uint32).astype(U) >> (U(31) - precise)
            kept.append(m[b, i].astype(U) << (width + precise) | far << width | m[b, j].astype(U))
            size += len(b)
            if size > 2_000_000:
                squeeze()
        if kept:
            squeeze()
        keys = kept[0] if kept else np.zeros(0, U)
        u, v = ids[(keys >> (width + precise)).astype(np.int64)], ids[(keys & ((U(1) << width) - U(1))).astype(np.int64)]
        s = -(((keys >> width) & ((U(1) << precise) - U(1))) << (U(31) - precise)).astype(np.uint32).view(np.float32)
        return told(offered(u, v, s))

    return state.unionByName(answered).groupBy("dest").applyInArrow(run, MESSAGE)


def build(vectors: DataFrame, sample: np.ndarray, n: int, top: float, p: Params) -> DataFrame:
    """The neighbour graphs of the shards g of vectors(g, p, node, id, vec), of about n each, as STATE rows."""

    def next_of(old: DataFrame, new: DataFrame) -> DataFrame:
        out = written(new)
        dropped(old)
        return out

    state = written(packed(vectors, p))
    for seed in range(1, p.dealings + 1):
        cells = dealt(vectors.drop("p"), sample, n, p.cell, seed)
        state = next_of(state, merged(state, started(cells, p, top, seed), p))
    state = next_of(state, state.withColumn("fresh", F.transform("links", lambda x: x >= 0)))
    for seed in range(p.rounds):
        state = next_of(state, merged(state, offers(state, answers(state, requests(state, p), p, seed), p, top), p))
        came, total = state.agg(F.sum(F.size(F.filter("fresh", lambda x: x))), F.sum(F.size("fresh"))).first()
        if came < p.stop * total:
            break
    return state


def lists(state: DataFrame, p: Params) -> DataFrame:
    """A STATE row for each block, of its vectors, with the neighbours of each node on either side in links, and their numbers in ends."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = heard(table)
        own = of_kind(rows, STATE)[0]
        links, _, _ = opened(own, p.degree)
        to, who, _ = thinned(of_kind(rows, REQUEST), p.reverse, 0)
        u, v = np.append(np.repeat(np.arange(len(links)), p.degree), to), np.append(links.ravel(), who)
        order = np.lexsort((v, u))
        order = order[v[order] >= 0]
        once = np.ones(len(order), bool)
        once[1:] = (u[order][1:] != u[order][:-1]) | (v[order][1:] != v[order][:-1])
        order = order[once]
        return told([{c: own[c] for c in ("dest", "kind", "codes", "scales", "centre")} | {"links": v[order], "ends": np.bincount(u[order], minlength=len(links)).astype(np.int32)}])

    return state.unionByName(requests(state, p)).groupBy("dest").applyInArrow(run, MESSAGE)


FOUND = "id bigint, node bigint, sim float"


def search(queries: DataFrame, state: DataFrame, shards: int, bits: int, parts: int, most: int, p: Params) -> DataFrame:
    """FOUND rows: of each of queries(id, own, vec) and each shard the `most` nearest nodes that a greedy search of the shard's graph ends with.

    own is the query's own node, or null.  Each of the `parts` of the queries meets
    each shard once.  A search starts from the nearest of the shard's entries; a
    round expands the query's `expand` nearest nodes that it hasn't expanded,
    until none of the beam is left or search_rounds are over.  The graph's table is deleted.
    """
    near = written(lists(state, p))
    dropped(state)
    beam = p.beam if shards == 1 else max(p.beam // 2, most)

    def run(key: tuple, mine: pa.Table, table: pa.Table) -> pa.Table:
        rows = sorted(heard(table), key=lambda r: r["dest"])
        if not rows or not mine.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "sim": pa.array([], pa.float32())})
        ids = np.concatenate([r["dest"] << BITS | np.arange(len(r["scales"])) for r in rows])
        x, ends, n = np.concatenate([decoded(r) for r in rows]), joined(rows, "ends", np.int64), len(ids)
        # a row of neighbours for each node, filled up with the place n, which counts as seen
        beside = np.full((n, max(ends.max(), 1)), n, np.int32)
        beside[np.arange(beside.shape[1]) < ends[:, None]] = np.searchsorted(ids, joined(rows, "links", np.int64))
        drawn = np.random.default_rng(key[0].as_py()).permutation(n)[: p.entries]
        entries = np.union1d(drawn, np.argsort(-norms(x), kind="stable")[: p.longest])
        vec = mine["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(mine.num_rows, -1)
        own = np.array([-1 if o is None else o for o in mine["own"].to_pylist()])
        at = np.minimum(np.searchsorted(ids, own), n - 1)
        at = np.where(ids[at] == own, at, -1)
        out = []
        for a in range(0, len(vec), 256):
            first = vec[a : a + 256] @ x[entries].T
            for q, o, s in zip(vec[a : a + 256], at[a : a + 256].tolist(), first, strict=True):
                seen = np.zeros(n + 1, bool)
                seen[entries] = seen[n] = True
                cand, sims = entries, s
                if o >= 0 and not seen[o]:
                    seen[o], cand, sims = True, np.append(cand, o), np.append(sims, x[o] @ q)
                done = np.zeros(len(cand), bool)
                for turn in range(p.search_rounds + 1):
                    keep = np.argpartition(-sims, beam)[:beam] if len(sims) > beam else np.arange(len(sims))
                    keep = keep[np.lexsort((cand[keep], -sims[keep]))]
                    cand, sims, done = cand[keep], sims[keep], done[keep]
                    go = np.flatnonzero(~done)[: p.expand]
                    if not len(go) or turn == p.search_rounds:
                        break
                    done[go] = True
                    new = beside[cand[go]].ravel()
                    new = np.unique(new[~seen[new]])
                    seen[new] = True
                    cand, sims, done = np.append(cand, new), np.append(sims, x[new] @ q), np.append(done, np.zeros(len(new), bool))
                out.append((ids[cand[:most]], sims[:most]))
        names = np.repeat(mine["id"].to_numpy(), [len(c) for c, _ in out])
        return pa.table({"id": names, "node": np.concatenate([c for c, _ in out]), "sim": np.concatenate([c for _, c in out]).astype(np.float32)})

    each = lambda name, n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    asked = queries.select(each("g", shards), F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), "id", "own", "vec")
    there = near.select(F.shiftright("dest", BITS + bits).cast("int").alias("g"), each("part", parts), *near.columns)
    found = asked.groupBy("g", "part").cogroup(there.groupBy("g", "part")).applyInArrow(run, FOUND)
    out = written(found)
    dropped(near)
    return out


def beside(queries: DataFrame, ids: np.ndarray, x: np.ndarray, most: int) -> DataFrame:
    """(id, node): of each of queries(id, raw) the `most` of the few vectors x, named ids, with the largest inner product; all pairs are scored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = batch.column("raw").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for a in range(0, len(q), 256):
                part = q[a : a + 256]
                # by each side's own size: products of very long vectors are beyond doubles
                score = (part / np.abs(part).max(1, keepdims=True)) @ x.T
                near = np.argsort(-score, axis=1, kind="stable")[:, :most]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("id").to_numpy()[a : a + 256], near.shape[1])), pa.array(ids[near].ravel())], ["id", "node"])

    return queries.select("id", "raw").mapInArrow(run, "id bigint, node bigint")


def nearest(base: DataFrame, queries: DataFrame, k: int = 20, params: Params | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id_col, score): up to k rows of base with the largest inner product with each query, as found.

    queries has id_col and vector_col too; a query's row of the same id is not
    among its results.  score is the inner product in double precision, summed
    from the first component to the last; ties go to the smaller id.  Rows whose
    id or vector is null, or whose vector is zero or holds null or non-finite
    components, take no part; of vectors of several lengths the shorter ones count
    as filled up with zeros.  Of repeated ids each vector counts.  Vectors far
    longer than all others, at most `apart` of them, are scored against every
    query beside the graph; a query's own length doesn't matter.
    """
    p = params or Params()
    tidy = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("raw")).where(F.col("id").isNotNull() & usable(F.col("raw")))
    base, asked = written(tidy(base)), written(tidy(queries).distinct())
    size = F.max(F.size("raw"))
    wide = max(base.agg(size).first()[0] or 0, asked.agg(size).first()[0] or 0)
    filled = lambda df: df.withColumn("raw", F.concat("raw", F.array_repeat(F.lit(0.0), F.lit(wide) - F.size("raw"))))
    base, asked = filled(base), filled(asked)
    size = F.array_max(F.transform("raw", F.abs))
    node = written(base.groupBy("raw").agg(F.min("id").alias("id")).select("id", "raw", size.alias("size")))
    # a few vectors far longer than all others would leave these no bits: they don't go into the graph
    first = node.orderBy(F.desc("size"), "id").limit(p.apart + 1).select("id", "size", "raw").collect()  # `apart` bounds it
    if not first:
        return asked.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias(id_col), F.lit(0.0).alias("score")).limit(0)
    largest = next((r["size"] for r, before in zip(first[:0:-1], first[-2::-1], strict=True) if before["size"] > p.longer * r["size"]), first[0]["size"])
    long = [r for r in first if r["size"] > largest]
    scaled = lambda by: F.transform("raw", lambda x: (x / by).cast("float")).alias("vec")
    node = node.where(F.col("size") <= largest).select("id", "raw", scaled(F.lit(largest)))
    length = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    n, top = node.agg(F.count("*"), F.max(length)).first()
    drawn = node.orderBy(F.xxhash64("raw"), "id").limit(p.sample).select("vec").toArrow()["vec"].combine_chunks()  # `sample` bounds it
    sample = drawn.flatten().to_numpy(zero_copy_only=False).reshape(len(drawn), -1)
    place = F.row_number().over(Window.partitionBy("p").orderBy(F.xxhash64("raw"), "id")) - 1
    shards = max(1, math.ceil(n / p.shard))
    each = math.ceil(n / shards)
    node = node.withColumn("g", F.pmod(F.xxhash64("raw"), F.lit(shards)).cast("int"))
    node = written(dealt(node, sample, each, p.block, 0).withColumn("node", F.col("p") * (1 << BITS) + place))
    state = build(node.select("g", "p", "node", "id", "vec"), sample, each, top, p)
    # a query's scale doesn't change its order
    own = asked.join(node.select("raw", F.col("node").alias("own")), "raw", "left").withColumn("query_id", F.col("id")).withColumn("id", F.monotonically_increasing_id())
    query = written(own.select("id", "query_id", "own", "raw", scaled(size)))
    count = query.count()
    most = 4 * (k + 1)  # vectors close to the last place may change places in double precision; the rest of the beam can't
    parts = max(1, math.ceil(count / p.query_block), min(p.parts, count // 256))
    hits = search(query.select("id", "own", "vec"), state, shards, planes_for(each, p.block), parts, most, p)
    if shards > 1:
        nearest_of = Window.partitionBy("id").orderBy(F.desc("sim"), "node")
        hits = hits.withColumn("_r", F.row_number().over(nearest_of)).where(F.col("_r") <= most)
    near = hits.select("id", "node")
    node = node.select("raw", "node")
    if long:
        x = np.array([r["raw"] for r in long])
        names = -1 - np.arange(len(long))
        near = near.unionByName(beside(query, names, x / np.abs(x).max(), most))
        named = asked.sparkSession.createDataFrame([(r["raw"], int(i)) for r, i in zip(long, names, strict=True)], "raw array<double>, node bigint")
        node = node.unionByName(named)
    dot = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    scored = near.join(query.select("id", "query_id", F.col("raw").alias("a")), "id").join(node.select("node", F.col("raw").alias("b")), "node").select("id", "query_id", "node", dot.alias("score"))
    best = Window.partitionBy("id").orderBy(F.desc("score"), "node")
    scored = scored.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= most).drop("_r")
    # of a node's rows the k + 1 least ids are enough for every query
    least = Window.partitionBy("raw").orderBy("id")
    rows = base.select("raw", "id").distinct().withColumn("_r", F.row_number().over(least)).where(F.col("_r") <= k + 1)
    member = rows.join(node.select("raw", "node"), "raw").select("node", F.col("id").alias(id_col))
    full = scored.join(member, "node").where(F.col("query_id") != F.col(id_col))
    place = Window.partitionBy("id").orderBy(F.desc("score"), id_col)
    return full.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", id_col, "score")
