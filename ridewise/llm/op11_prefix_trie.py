"""Prefix trie of conversations as balanced parentheses, a shard at a time.

A conversation is the sequence of its turns, each a 16-byte token (the digest
of role and text); a path is their concatenation. Equal conversations are one
path with its members counted. Paths are sorted and dealt to tasks by range; a
task cuts its stream into shards of a bounded number of levels. A shard is
encoded as one balanced-parentheses sequence: a node opens when a path first
needs it and closes when the next path leaves it. Blocks of the excess (opens
minus closes) keep their least value, so findclose skips blocks; a node's
subtree is what lies before its close. Rank of open parentheses gives the
subtree's size, rank of leaf pairs ``()`` its leaves, and cumulative arrays in
order of opening give members and savings.

Only the nodes of a shard's first and last path (its spines) can also lie in
other shards. All others are done and go out. The spines, with what hangs off
them added up in their nodes, are the paths of the next round, where equal ones
of neighbouring shards merge; a round shrinks its input by about a shard's size
over twice a path's length. The last round is one shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridewise.llm.common import stage

TOKEN = 16
#: Levels of paths that a shard takes, unless single paths are long: then so many of the longest.
SHARD_LEVELS, LONGEST_PATHS = 1 << 14, 8
#: Levels that decide which range a path falls in (equal ones may share a task, whose shards stay bounded).
RANGE_LEVELS = 64
#: Parentheses in one block of the excess.
BLOCK = 64
#: Members of one path whose ids are joined before they meet: those of one block of this many ids.
ID_BLOCK = 1024
NO_ENDS = hashlib.sha256(b"").hexdigest()
_NONE = np.iinfo(np.int64).max


class Parentheses:
    """A balanced-parentheses sequence (1 opens, 0 closes) of one tree."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits.astype(bool)
        self.excess = np.cumsum(np.where(self.bits, 1, -1))
        self.opens = np.flatnonzero(self.bits)
        self.rank = np.cumsum(self.bits)
        pairs = np.zeros(len(bits), bool)
        pairs[:-1] = self.bits[:-1] & ~self.bits[1:]
        self.leaf_rank = np.cumsum(pairs)
        padded = np.full(ceil(len(bits) / BLOCK) * BLOCK, np.iinfo(np.int64).max)
        padded[:len(bits)] = self.excess
        self.least = padded.reshape(-1, BLOCK).min(axis=1)

    def findclose(self) -> np.ndarray:
        """Where each open parenthesis, in order, closes: the next place whose excess is one less than its own."""
        target = self.excess[self.opens] - 1
        close = np.full(len(self.opens), -1)
        at, open_ = self.opens + 1, np.arange(len(self.opens))

        def scan(at, open_):
            """Steps to the end of the block; those that did not meet their target stay."""
            while len(open_):
                hit = self.excess[at] == target[open_]
                close[open_[hit]] = at[hit]
                at, open_ = at[~hit] + 1, open_[~hit]
                out = at % BLOCK == 0
                yield at[out], open_[out]
                at, open_ = at[~out], open_[~out]

        def next_block(pairs):
            found = list(pairs)
            return (np.concatenate([a for a, _ in found]), np.concatenate([o for _, o in found])) if found else (at[:0], open_[:0])

        edge = at % BLOCK == 0
        left = [(at[edge], open_[edge]), next_block(scan(at[~edge], open_[~edge]))]
        at, open_ = np.concatenate([a for a, _ in left]), np.concatenate([o for _, o in left])
        block = at // BLOCK
        while (skip := self.least[block] > target[open_]).any():     # whole blocks above the target are passed over
            block = block + skip
        list(scan(block * BLOCK, open_))
        return close


class Shard:
    """A trie of sorted paths; nodes are numbered in order of opening, the root is 0."""

    def __init__(self):
        self.bits, self.stack, self.path = [1], [0], b""
        self.parent, self.depth, self.chars = [-1], [0], [0]
        self.hashes = [hashlib.blake2b(digest_size=TOKEN)]          # of the open nodes' paths
        self.key = [self.hashes[0].digest()]
        # what belongs to a node beside the nodes below it: members, least id, and done leaves, children, savings
        self.n, self.low, self.leaves, self.kids, self.saved, self.ends = [0], [_NONE], [0], [0], [0], [None]
        self.first: list[int] | None = None
        self.levels = 1

    def add(self, path: bytes, chars, n, low, leaves, kids, saved, ends) -> None:
        """A path that is not before the last one; lists hold a value a level, root first (chars: without the root)."""
        depth, keep, most = len(path) // TOKEN, 0, min(len(path), len(self.path))
        if path[:most] == self.path[:most]:
            keep = most // TOKEN
        else:
            lo, hi = 0, most // TOKEN                 # equal up to lo, not up to hi
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if path[:mid * TOKEN] == self.path[:mid * TOKEN] else (lo, mid)
            keep = lo
        while len(self.stack) > keep + 1:
            self.stack.pop()
            self.hashes.pop()
            self.bits.append(0)
        for d in range(keep, depth):
            node = len(self.parent)
            self.parent.append(self.stack[-1])
            self.depth.append(d + 1)
            self.chars.append(chars[d])
            for values, start in ((self.n, 0), (self.low, _NONE), (self.leaves, 0), (self.kids, 0), (self.saved, 0), (self.ends, None)):
                values.append(start)
            self.stack.append(node)
            self.hashes.append(self.hashes[-1].copy())
            self.hashes[-1].update(path[d * TOKEN:(d + 1) * TOKEN])
            self.key.append(self.hashes[-1].digest())
            self.bits.append(1)
        for d, node in enumerate(self.stack):
            if n[d] or kids[d]:
                self.n[node] += n[d]
                self.low[node] = min(self.low[node], low[d])
                self.leaves[node] += leaves[d]
                self.kids[node] += kids[d]
                self.saved[node] += saved[d]
            if ends[d] is not None:
                self.ends[node] = ends[d]
        self.path, self.levels = path, self.levels + depth - keep
        if self.first is None:
            self.first, self.first_path = list(self.stack), path

    def close(self, whole: bool, keyed: bool) -> tuple[list[tuple], list[tuple]]:
        """(rows of done nodes, paths of the next round); of a whole tree all nodes are done."""
        spine = list(self.stack)
        tree = Parentheses(np.array(self.bits + [0] * len(self.stack)))
        close = tree.findclose()
        parent, depth, chars = (np.array(v) for v in (self.parent, self.depth, self.chars))
        size = tree.rank[close] - np.arange(len(parent))
        last = np.arange(len(parent)) + size

        def below(values):
            total = np.concatenate([[0], np.cumsum(values)])
            return total[last] - total[:-1]

        n = below(np.array(self.n))
        kids_done = np.array(self.kids)
        is_pair = size == 1
        # a node that has only done children is a leaf pair here, but no leaf
        leaves = tree.leaf_rank[close] - tree.leaf_rank[tree.opens] + is_pair + below(np.array(self.leaves) - (is_pair & (kids_done > 0)))
        saved = below((n - 1) * chars + np.array(self.saved))
        kids = np.bincount(parent[1:], minlength=len(parent)) + kids_done
        low = list(self.low)
        for v in range(len(low) - 1, 0, -1):
            if low[v] < low[self.parent[v]]:
                low[self.parent[v]] = low[v]

        on_spine = np.zeros(len(parent), bool)
        if not whole:
            on_spine[self.first] = on_spine[spine] = True
        rows = []
        for v in np.flatnonzero(~on_spine).tolist():
            p = self.parent[v]
            waits = p >= 0 and bool(on_spine[p])
            rows.append((low[v], int(depth[v]), None if waits or p < 0 else low[p], self.key[p] if waits else None,
                         self.key[v] if keyed else None, int(n[v]), int(kids[v]), int(leaves[v]), int(saved[v]), self.ends[v] or NO_ENDS))
        nexts = []
        if not whole:
            inner = {v: [self.n[v], self.low[v], self.leaves[v], self.kids[v], self.saved[v]] for v in {*self.first, *spine}}
            hang = np.flatnonzero(~on_spine & np.where(parent >= 0, on_spine[parent], False))
            for v in hang.tolist():
                into = inner[self.parent[v]]
                into[0] += int(n[v])
                into[1] = min(into[1], low[v])
                into[2] += int(leaves[v])
                into[3] += 1
                into[4] += int(saved[v])
            told: set[int] = set()
            for nodes, of in ((self.first, self.first_path), (spine, self.path)):
                if told.issuperset(nodes):
                    continue                               # one path is both spines, or the first begins the last
                own = [inner[v] if v not in told else [0, _NONE, 0, 0, 0] for v in nodes]
                ends = [self.ends[v] if v not in told else None for v in nodes]
                told |= set(nodes)
                nexts.append((of, [int(chars[v]) for v in nodes[1:]], *([o[i] for o in own] for i in range(5)), ends))
        return rows, nexts


_LEVELS = {"chars": "array<int>", "n": "array<long>", "low": "array<long>", "leaves": "array<long>", "kids": "array<long>",
           "saved": "array<long>", "ends": "array<string>"}
_PATH = {"path": "binary"} | _LEVELS
_NODE = {"conv_id": "long", "depth": "int", "parent_conv_id": "long", "parent_key": "binary", "key": "binary", "n_convs": "long",
         "n_children": "long", "n_leaves": "long", "saved_tokens": "long", "ends_sha256": "string"}


def _shards(limit: int, whole: bool, keyed: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Sorted paths to done nodes (path null) and paths of the next round."""
    names, width = [*_NODE, *_PATH], len(_NODE)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def closed(shard):
            rows, nexts = shard.close(whole, keyed)
            out = [(*r, *[None] * len(_PATH)) for r in rows] + [(*[None] * width, *r) for r in nexts]
            return pd.DataFrame(out, columns=names, dtype=object)

        shard = Shard()
        for frame in frames:
            for path, *levels in zip(*(frame[c] for c in _PATH)):
                shard.add(bytes(path), *([*v] for v in levels))
                if shard.levels >= limit and not whole:
                    yield closed(shard)
                    shard = Shard()
        if shard.first is not None:
            yield closed(shard)

    return run


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, token, chars) of rows (conv_id, turn, role, text); others are ignored.

    pos counts a conversation's turns from 1, by turn (null first), role and
    token. token is the hexadecimal digest (16 bytes of SHA-256) of role and
    text, chars the text's code points; texts are not shuffled. A null role or
    text is empty; rows without conv_id belong to no conversation and go.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    token = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * TOKEN)
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
                                                     token.alias("token"), F.length(text).alias("chars"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "token"))
    return rows.select("conv_id", place.alias("pos"), "token", "chars")


def _members(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row a path from its blocks of ids, in order of ids."""
    path, names = None, ["path", "chars", "n", "low", "ends"]
    for frame in frames:
        out = []
        for p, chars, n, low, ids in zip(*(frame[c] for c in ("path", "chars", "n", "low", "ids"))):
            if p != path:
                if path is not None:
                    out.append((path, length, members, least, digest.hexdigest()))
                path, length, members, least, digest = p, chars, 0, int(low), hashlib.sha256()
            digest.update(("," if members else "").encode() + ids.encode())
            members += int(n)
        yield pd.DataFrame(out, columns=names)
    if path is not None:
        yield pd.DataFrame([(path, length, members, least, digest.hexdigest())], columns=names)


def paths(turns: DataFrame) -> DataFrame:
    """Distinct paths of rows (conv_id, pos, token, chars) with their members as values by level.

    A row without token only says that the conversation is there. A
    conversation is one row of 20 bytes a turn; those of one path meet as
    joined blocks of ids, since the digest of the ids needs them in order.
    """
    turn = F.when(F.col("token").isNotNull(), F.struct("pos", "token", "chars"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    whole = whole.select("conv_id", F.unhex(F.array_join("t.token", "")).alias("path"), F.col("t.chars").alias("chars"))
    blocks = whole.groupBy("path", F.floor(F.col("conv_id") / F.lit(ID_BLOCK)).alias("block")).agg(
        F.any_value("chars").alias("chars"), F.count("*").alias("n"), F.min("conv_id").alias("low"),
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    met = blocks.repartition("path").sortWithinPartitions("path", "block").mapInPandas(
        _members, "path binary, chars array<int>, n long, low long, ends string")
    depth = F.size("chars")

    def at_end(value, other):
        return F.concat(F.array_repeat(other, depth), F.array(value))

    zero = F.lit(0).cast("long")
    nothing = at_end(zero, zero)
    return met.select("path", "chars", at_end(F.col("n"), zero).alias("n"), at_end(F.col("low"), F.lit(_NONE)).alias("low"),
                      nothing.alias("leaves"), nothing.alias("kids"), nothing.alias("saved"),
                      at_end(F.col("ends"), F.lit(None).cast("string")).alias("ends"))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of rows (conv_id, pos, token, chars): one row a node, columns of ``_NODE`` but the keys.

    conv_id is the smallest member; n_leaves and saved_tokens count the whole
    subtree; ends_sha256 is of the ids of conversations that end at the node,
    ascending, comma-joined. Conversations without turns are members of the
    root; no rows, no nodes. Two different turns count as one only if 16 bytes
    of their SHA-256 agree.
    """
    schema = ", ".join(f"{n} {t}" for n, t in (_NODE | _PATH).items())
    items, rounds = stage(paths(turns), "trie-paths"), []
    while True:
        total, longest = items.agg(F.sum(F.size("n")), F.max(F.size("n"))).first()
        limit = max(SHARD_LEVELS, LONGEST_PATHS * (longest or 0))
        whole = (total or 0) <= limit
        dealt = items.coalesce(1) if whole else items.repartitionByRange(ceil(total / limit), F.substring("path", 1, RANGE_LEVELS * TOKEN))
        out = stage(dealt.sortWithinPartitions("path").mapInPandas(_shards(limit, whole, bool(rounds)), schema), "trie-shards")
        rounds.append(out.where("path is null").select(*_NODE))
        if whole:
            break
        items = out.where("path is not null").select(*_PATH)
    nodes = rounds[0]
    for more in rounds[1:]:
        nodes = nodes.unionByName(more)
    columns = [c for c in _NODE if c not in ("parent_key", "key")]
    if len(rounds) == 1:
        return nodes.select(columns)
    # children of spine nodes learn their parent's least member, which only later rounds know
    spines = nodes.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("known"))
    waiting = nodes.where("parent_key is not null").join(spines, "parent_key", "left").withColumn("parent_conv_id", F.col("known"))
    return nodes.where("parent_key is null").select(columns).unionByName(waiting.select(columns))
